"""Log-bilinear language model, trained by noise-contrastive estimation.

What is learned from: every training text, through two tables that Spark
counts over the whole corpus. (1) How often each word occurs. (2) How often each
class triple (two classes before, one class) occurs. The classes are the most
frequent words, the end of text, and one class for each hash of a rare word's ending;
their number is fixed, so the triple table is at most CLASSES^3 rows however large the
corpus is, and the model is trained on all of it.

The model scores a class by its bias plus the product of its vector with the sum
of two position-specific context vectors. Noise-contrastive estimation tells
observed triples from classes drawn by their frequency; shards of contexts train
side by side and their parameters are averaged. For scoring, batched matrix
products over the distinct contexts of a slice give normalised class
log-probabilities; a rare word adds the smoothed share it has in its class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import (LOWER, SPACE, cut_lineage, mix, span_hashes, text_bytes, text_slices, word_spans)

CLASSES = 256
#: Classes: 0 end (and start) of text, then HEAD words, then endings of rare words.
HEAD = 191
TAIL = CLASSES - 1 - HEAD
#: Words whose counts travel to the scoring tasks; counts of the others come by a join.
DIRECT = 1 << 17
DIM = 24
NOISE = 8
SHARDS = 8
ROUNDS = 4


def _tokens(array: pa.Array):
    """Bytes, word spans, row of each word, hash of each word, ending class."""
    data, off = text_bytes(array)
    data = LOWER[data]
    start, end, row = word_spans(SPACE[data], off)
    last = data[end - 1].astype(np.uint64)
    before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    tail = (mix(last * np.uint64(256) + before) % np.uint64(TAIL)).astype(np.int64) + 1 + HEAD
    return data, start, end, row, span_hashes(data, start, end), tail


def count_words(docs: DataFrame) -> DataFrame:
    """word, tail (its class as a rare word), n: occurrences in all texts."""
    def scan(batches):
        for batch in batches:
            for part in text_slices(batch):
                data, start, end, _, h, tail = _tokens(part.column("text"))
                _, first, n = np.unique(h, return_index=True, return_counts=True)
                raw = data.tobytes()
                words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[first].tolist(), end[first].tolist())]
                yield pa.record_batch({"word": pa.array(words, pa.string()), "tail": pa.array(tail[first], pa.int32()),
                                       "n": pa.array(n, pa.int64())})

    return (docs.select("text").mapInArrow(scan, "word string, tail int, n long")
            .groupBy("word", "tail").agg(F.sum("n").alias("n")))


def _span_hash(words: list[str]) -> np.ndarray:
    data, off = text_bytes(pa.array(words, pa.string()))
    return span_hashes(data, off[:-1], off[1:])


class Vocabulary:
    """The frequent words with counts (fixed size), and the totals."""

    def __init__(self, words: list[str], counts: list[int], total: int, distinct: int, ends: int,
                 tail_tokens: np.ndarray, tail_words: np.ndarray):
        h = _span_hash(words)
        order = np.argsort(h)
        self.hash, self.count = h[order], np.array(counts, np.int64)[order]
        number = np.zeros(len(words), np.int64)
        number[:HEAD] = np.arange(1, min(HEAD, len(words)) + 1)
        self.head = number[order]
        self.ends = ends
        self.tokens, self.words = total + ends, distinct + (ends > 0)
        # Mass of a rare word in its class: (count + 1) / (tokens + words + 1).
        self.tail_log = np.log10(tail_tokens + tail_words + 1.0)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, head class) of each hash, 0 where it is not held."""
        if not len(self.hash):
            return np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        i = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        hit = self.hash[i] == h
        return np.where(hit, self.count[i], 0), np.where(hit, self.head[i], 0)


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    # At most DIRECT words: all above a frequency, found from a histogram of at most a thousand steps.
    step = F.floor(F.log2("n") * 16).cast("int")
    held, least = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r.s):
        held += r["count"]
        if held > DIRECT:
            break
        least = r.s
    top = counts.where(step >= (1 << 30 if least is None else least)).select("word", "n").toPandas()
    top = top.sort_values(["n", "word"], ascending=[False, True])
    words, n = top["word"].tolist(), top["n"].tolist()
    rare = counts.where(~F.col("word").isin(words[:HEAD])) if words else counts
    by_class = rare.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("w")).collect()
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class:
        tokens[r.tail], kinds[r.tail] = r.n, r.w
    all_ = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("w")).first()
    return Vocabulary(words, n, all_.n, all_.w, ends, tokens, kinds)


def _classes(v: Vocabulary, part: pa.RecordBatch):
    """Per token, ends of text included: class and the two classes before it;
    the row of each; and the words' counts and hashes."""
    data, start, end, row, h, tail = _tokens(part.column("text"))
    count, head = v.find(h)
    cls = np.where(head > 0, head, tail)
    n = part.num_rows
    size = np.bincount(row, minlength=n)[:n]
    place = np.arange(len(row)) + row
    of = np.repeat(np.arange(n), size + 1)
    all_ = np.zeros(len(row) + n, np.int64)
    all_[place] = cls
    one, two = np.r_[0, all_[:-1]][:len(all_)], np.r_[0, 0, all_[:-2]][:len(all_)]
    first = np.cumsum(size + 1) - size - 1
    two[np.minimum(first + 1, len(all_) - 1)[size > 0]] = 0
    two[first] = 0
    return all_, one, two, of, size, (data, start, end, row, count, head, cls)


def count_triples(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """ctx (two classes), cls, n over all texts; at most CLASSES^3 rows. Each
    task sums its own in an array of that size."""
    def scan(batches):
        seen = np.zeros(CLASSES ** 3, np.int32)
        for batch in batches:
            for part in text_slices(batch):
                c, one, two, *_ = _classes(v, part)
                got, n = np.unique((two * CLASSES + one) * CLASSES + c, return_counts=True)
                seen[got] += n.astype(np.int32)
        at = np.flatnonzero(seen)
        for a in range(0, len(at), 100_000):
            i = at[a:a + 100_000]
            yield pa.record_batch({"ctx": pa.array(i // CLASSES, pa.int32()), "cls": pa.array(i % CLASSES, pa.int32()),
                                   "n": pa.array(seen[i], pa.int64())})

    return (docs.select("text").mapInArrow(scan, "ctx int, cls int, n long")
            .groupBy("ctx", "cls").agg(F.sum("n").alias("n")))


Params = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def start_params(noise: np.ndarray) -> Params:
    """Context vectors of the class before and the one before that, target
    vectors, biases (at first the log frequencies)."""
    rng = np.random.default_rng(5)
    return (rng.normal(0, 0.1, (CLASSES, DIM)), rng.normal(0, 0.1, (CLASSES, DIM)),
            rng.normal(0, 0.1, (CLASSES, DIM)), np.log(noise))


def train_shard(params: Params, noise: np.ndarray, ctx: np.ndarray, cls: np.ndarray, n: np.ndarray, seed: int,
                epochs: int = 5, batch: int = 256, rate: float = 0.2) -> Params:
    """Noise-contrastive estimation on the triples of some contexts, by
    Adagrad on batches of contexts: of every context the observed classes count
    as often as they occurred, and NOISE times as many draws of the noise are taken
    at their expectation over all classes."""
    one, two, out, bias = (p.copy() for p in params)
    square = [np.full(p.shape, 1e-3) for p in (one, two, out, bias)]
    order = np.argsort(ctx, kind="stable")
    ctx, cls, n = ctx[order], cls[order], n[order]
    first = np.flatnonzero(np.r_[True, np.diff(ctx) != 0])
    edge = np.r_[first, len(ctx)]
    rng = np.random.default_rng(seed)
    shift = np.log(NOISE * noise)
    for _ in range(epochs):
        pick = rng.permutation(len(first))
        for a in range(0, len(pick), batch):
            g = pick[a:a + batch]
            size = edge[g + 1] - edge[g]
            at = np.repeat(edge[g] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            seen = np.zeros((len(g), CLASSES))
            # Square roots keep the most frequent contexts from drowning the rest.
            seen[np.repeat(np.arange(len(g)), size), cls[at]] = n[at]
            total = seen.sum(1, keepdims=True)
            weight = np.sqrt(total) / total
            c2, c1 = ctx[first[g]] // CLASSES, ctx[first[g]] % CLASSES
            phi = one[c1] + two[c2]
            p = 1.0 / (1.0 + np.exp(-(phi @ out.T + bias - shift)))
            grad = (seen * (1.0 - p) - NOISE * total * noise * p) * weight / len(g)
            d_phi, d_out = grad @ out, grad.T @ phi
            d_one, d_two = np.zeros_like(one), np.zeros_like(two)
            np.add.at(d_one, c1, d_phi)
            np.add.at(d_two, c2, d_phi)
            for p_, s, d in zip((one, two, out, bias), square, (d_one, d_two, d_out, grad.sum(0))):
                s += d * d
                p_ += rate * d / np.sqrt(s)
    return one, two, out, bias


def train(triples: DataFrame) -> Params:
    """Parameters averaged over shards of contexts, ROUNDS times. What reaches
    the driver is the class frequencies and SHARDS parameter sets."""
    by_class = triples.groupBy("cls").agg(F.sum("n").alias("n")).collect()
    freq = np.ones(CLASSES)
    for r in by_class:
        freq[r.cls] += r.n
    noise = freq / freq.sum()
    params = start_params(noise)
    if not by_class:
        return params

    def round_of(params: Params, step: int):
        def shard(table: pa.Table) -> pa.Table:
            ctx, cls, n = (table.column(c).to_numpy() for c in ("ctx", "cls", "n"))
            new = train_shard(params, noise, ctx, cls, n, seed=step)
            return pa.table({"n": pa.array([int(n.sum())], pa.int64()),
                             "p": pa.array([np.concatenate([p.ravel() for p in new]).tobytes()], pa.binary())})
        return shard

    dealt = triples.withColumn("shard", F.pmod(F.hash("ctx"), F.lit(SHARDS)))
    for step in range(ROUNDS):
        done = (dealt.groupBy("shard").applyInArrow(round_of(params, step), "n long, p binary")
                .orderBy("n").collect())
        share = np.array([r.n for r in done], float)
        flat = np.average([np.frombuffer(r.p) for r in done], axis=0, weights=share)
        cut = np.cumsum([p.size for p in params])[:-1]
        params = tuple(x.reshape(p.shape) for x, p in zip(np.split(flat, cut), params))
    return params


def class_log10(params: Params, cls: np.ndarray, one: np.ndarray, two: np.ndarray, step: int = 4096) -> np.ndarray:
    """log10 probability of each class in its context, normalised over all
    classes; each distinct context is multiplied out once."""
    w_one, w_two, out, bias = params
    ctx = two * CLASSES + one
    used, where = np.unique(ctx, return_inverse=True)
    order = np.argsort(where, kind="stable")
    edge = np.searchsorted(where[order], np.arange(0, len(used) + step, step))
    result = np.empty(len(cls))
    for k in range(0, len(used), step):
        c = used[k:k + step]
        s = (w_one[c % CLASSES] + w_two[c // CLASSES]) @ out.T + bias
        top = s.max(1, keepdims=True)
        s -= top + np.log(np.exp(s - top).sum(1, keepdims=True))
        i = order[edge[k // step]:edge[k // step + 1]]
        result[i] = s[where[i] - k, cls[i]]
    return result / np.log(10.0)


def score(docs: DataFrame, v: Vocabulary, params: Params, counts: DataFrame) -> DataFrame:
    """``docs`` (text last) with n_tokens, n_known, train_tokens, base_score
    and score in place of the text. Counts of words outside the vocabulary's
    direct part are joined by word."""
    rest = docs.columns[:-1]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes[:-1]), "row long",
                        "n_tokens long, n_known long, base double, model double, rare array<string>"])

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in text_slices(batch):
                c, one, two, of, size, (data, start, end, row, count, head, cls) = _classes(v, part)
                n = part.num_rows
                p = class_log10(params, c, one, two)
                word_log = np.log10(count + 1.0)
                unseen = count == 0
                model = np.bincount(of, weights=p, minlength=n) + np.bincount(
                    row, weights=np.where(head > 0, 0.0, word_log - v.tail_log[cls]), minlength=n)
                base = np.bincount(row, weights=word_log, minlength=n) + np.log10(v.ends + 1.0)
                raw = data.tobytes()
                at = np.flatnonzero(unseen)
                rare = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[at].tolist(), end[at].tolist())]
                off = np.searchsorted(row[at], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:-1], pa.array(size + 1, pa.int64()),
                    pa.array(np.bincount(row, weights=~unseen, minlength=n).astype(np.int64) + int(v.ends > 0)),
                    pa.array(base), pa.array(model),
                    pa.ListArray.from_arrays(pa.array(off), pa.array(rare, pa.string()))],
                    names=[*rest, "row", "n_tokens", "n_known", "base", "model", "rare"])

    slim = docs.select(*rest, F.monotonically_increasing_id().alias("row"), F.col(docs.columns[-1]).alias("text"))
    part = cut_lineage(slim.mapInArrow(scan, schema))
    # Held counts are of the DIRECT most frequent words; the others are looked up here.
    words = (part.select("row", F.explode("rare").alias("word")).groupBy("row", "word")
             .agg(F.count(F.lit(1)).alias("times")))
    late = (words.join(counts.select("word", F.col("n").alias("c")), "word")
            .groupBy("row").agg(F.sum("times").alias("late_known"),
                                F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("late_log")))
    each = float(np.log10(v.tokens + 1.0 * (v.words + 1)))
    more = F.coalesce("late_log", F.lit(0.0))
    return part.join(late, "row", "left").select(
        *rest, "n_tokens", (F.col("n_known") + F.coalesce("late_known", F.lit(0))).alias("n_known"),
        F.lit(int(v.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("model") + more).alias("score"))


def score_documents(docs: DataFrame, train_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Learn from every text of ``train_docs``, score every text of ``docs``:
    the id, ``keep`` columns, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (add-one unigram) and score (the model), log10.

    Words are runs without ASCII white space, A-Z in lower case. NULL text counts as
    empty: one end. Rows are scored one by one (repeats too). Without training
    texts the model is uniform over its classes. An empty table gives no rows.
    """
    learn = train_docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = cut_lineage(count_words(learn))
    v = vocabulary(counts, learn.count())
    params = train(cut_lineage(count_triples(learn, v)))
    return score(docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("text")), v, params, counts)
