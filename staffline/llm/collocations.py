"""Phrase collocations by direct-address tiling.

Frequent words get ids by frequency rank, over all languages. Pairs of ids fall into tiles
of 1,024 x 1,024 cells; because ids are ranks, most pairs meet in few tiles. A task counts
the tiles that hold many of its pairs in dense arrays (``bincount`` on the cell's address) and
the others as one sorted list of coordinates; Spark adds the counts of all tasks.
Frequent pairs are then ranked anew, and a pair with the word after it is again a pair of
ids: the same count gives phrases of 3, 4 and 5 words.

Ranked ids are limited (``ranked`` for words, ``longer`` for the phrases of each length), since
tasks hold them. Phrases with a part beyond that are counted in the same pass, by the ids of their
words, or by their text where words are beyond it too, after a filter of fixed size has spared those that
cannot be frequent; no phrase is left out, the counts are exact on all three ways.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffline.llm.common import Table, bloom_of, ensure_checkpoint_dir, in_bloom, mix, text_slices
from staffline.operators.reconcile import assign_ids

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: Ids that a task holds for words, and for the phrases of one length.
RANKED, LONGER = 1 << 20, 1 << 21
TILE = 10
#: A tile is counted densely where one of this many cells is met.
DENSE = 8
#: Pairs, phrases as ids of words, and words or phrases as text, that a task holds before it gives out their counts.
PAIRS_HELD, GRAMS_HELD, TEXTS_HELD = 1 << 22, 1 << 20, 400_000
#: The right id of a code.
_RIGHT = (1 << 32) - 1

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[list(b".,;:!?\x0b\x0c\r")] = 10
_FOLD[9] = 32
FOLD = _FOLD.tobytes()
BREAK = b"\n"


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words of the texts in lower case, with a break wherever a piece or a text ends."""
    return list(filter(None, BREAK.join(texts).translate(FOLD).replace(BREAK, b" \n ").split(b" ")))


def by_lang(part: pa.RecordBatch) -> dict[str, list[bytes]]:
    """The texts of a slice by language."""
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(part.column("lang").to_pylist(), pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist()):
        out.setdefault("und" if lang is None else lang, []).append(text)
    return out


def _text_rows(counts: Counter) -> pa.RecordBatch:
    """Rows (lang, phrase, n) of counts by (lang, phrase)."""
    lang, phrase = zip(*counts)
    return pa.record_batch({"lang": pa.array(lang, pa.string()), "phrase": pa.array(phrase, pa.binary()).cast(pa.string()),
                            "n": pa.array(counts.values(), pa.int64())})


def count_words(slim: DataFrame) -> DataFrame:
    """(lang, phrase, n) of every word; the row without a word counts all words of the language."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                c.pop(BREAK, None)
                if c:
                    yield _text_rows(Counter({(lang, w): n for w, n in c.items()} | {(lang, None): c.total()}))
            held.clear()

        for batch in batches:
            for part in text_slices(batch, "text"):
                for lang, texts in by_lang(part).items():
                    held.setdefault(lang, Counter()).update(words_of(texts))
                if sum(map(len, held.values())) > TEXTS_HELD:
                    yield from flush()
        yield from flush()

    return (slim.mapInArrow(scan, "lang string, phrase string, n long")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")))


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (left << 32 | right) and their counts: tiles that hold many pairs by the address
    of the cell, the others as sorted coordinates."""
    side = int(right.max() >> TILE) + 1 if len(right) else 1
    tile = (left >> TILE).astype(np.int64) * side + (right >> TILE)
    dense = np.bincount(tile, minlength=1) >= -(-(1 << 2 * TILE) // DENSE)
    codes, counts = [], []
    mask = (1 << TILE) - 1
    for t in np.flatnonzero(dense).tolist():
        on = tile == t
        n = np.bincount((left[on] & mask) << TILE | (right[on] & mask), minlength=1 << 2 * TILE)
        cell = np.flatnonzero(n)
        codes.append((t // side << TILE | cell >> TILE) << 32 | (t % side << TILE | cell & mask))
        counts.append(n[cell])
    if codes:
        rest = ~dense[tile]
        left, right = left[rest], right[rest]
    del tile
    code, n = np.unique(left.astype(np.int64) << 32 | right, return_counts=True)
    return np.concatenate([*codes, code]), np.concatenate([*counts, n])


def count_grams(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of word ids, and their counts: a column at a time, the rows so far numbered anew."""
    code = grams[:, 0].astype(np.int64)
    for k in range(1, grams.shape[1]):
        if k > 1:
            code = np.unique(code, return_inverse=True)[1]
        code = code << 32 | grams[:, k]
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return grams[first], n


class Ranks:
    """The most frequent phrases of one length, as tasks hold them, in the order of their ids: ``lang`` and
    ``phrase`` of words, and of longer ones the ``code``. ``complete``: every frequent phrase has an id;
    otherwise ``bits`` is a filter that all frequent phrases pass, by the hash of their words' ids if all
    frequent words have one, else by that of their text."""

    def __init__(self, rows: pa.Table, complete: bool, bits: np.ndarray | None):
        self.rows, self.complete, self.bits = rows.combine_chunks(), complete, bits

    @cached_property
    def ids(self) -> dict[str, dict[bytes, int]]:
        out: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(zip(self.rows.column("lang").to_pylist(),
                                             self.rows.column("phrase").cast(pa.binary()).to_pylist())):
            out.setdefault(lang, {})[word] = i
        return out

    @cached_property
    def code(self) -> np.ndarray:
        return self.rows.column("code").to_numpy()

    @cached_property
    def table(self) -> Table:
        return Table(self.code, np.arange(len(self.code), dtype=np.int32), room=2)


def _opened(sent: list) -> list[Ranks]:
    """The ranks that were sent to a worker; its dictionaries and tables are made once for all its tasks."""
    return [x.value.setdefault("ranks", Ranks(**{k: v for k, v in x.value.items() if k != "ranks"})) for x in sent]


def _passes(bits: np.ndarray, lang: str, phrases: list[bytes]) -> np.ndarray:
    import xxhash  # the hash that Spark's xxhash64 gives
    head = lang.encode() + b"\n"
    return in_bloom(bits, np.array([xxhash.xxh64_intdigest(head + p, seed=42) for p in phrases], np.uint64))


def gram_hashes(word: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` word ids that follow one another."""
    n = max(len(word) - size + 1, 0)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = mix(h + word[k:k + n].astype(np.uint64) + np.uint64(1))
    return h


def extend(words: list[bytes], lang: str, levels: list[Ranks]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Occurrences of phrases one word longer than ``levels`` reach: left and right ids, and of those with a part
    that has no id the ids of all words, or the text where words have none."""
    size = len(levels) + 1
    word = np.fromiter(map(levels[0].ids.get(lang, {}).get, words, repeat(-1)), np.int32, len(words))
    left = word
    for k, level in enumerate(levels[1:], 1):
        ok = np.flatnonzero((left[:-1] >= 0) & (word[k:] >= 0))
        found = np.full(max(len(left) - 1, 0), -1, np.int32)
        found[ok] = level.table.get(left[ok].astype(np.int64) << 32 | word[k:][ok])
        left = found
    n = max(len(words) - size + 1, 0)
    head, tail, right = left[:n], left[1:n + 1], word[size - 1:]
    ok = (head >= 0) & (right >= 0)
    grams, texts = np.zeros((0, size), np.int32), []
    if levels[-1].complete:
        ok &= tail >= 0
    elif levels[0].complete:  # breaks have no id
        unknown = np.cumsum(np.r_[0, word < 0])
        at = np.flatnonzero(~ok & (unknown[size:] == unknown[:n]))
        known = in_bloom(levels[-1].bits, gram_hashes(word, size - 1)) | (left >= 0)
        at = at[known[at] & known[at + 1]]
        grams = word[at[:, None] + np.arange(size)]
        ok &= known[1:n + 1]
    else:
        gap = np.cumsum(np.r_[0, [w == BREAK for w in words]])
        at = np.flatnonzero(~ok & (gap[size:] == gap[:n])).tolist()
        before, after = ([b" ".join(words[i + s:i + s + size - 1]) for i in at] for s in (0, 1))
        keep = _passes(levels[-1].bits, lang, before) & _passes(levels[-1].bits, lang, after)
        texts = [b" ".join(words[at[i]:at[i] + size]) for i in np.flatnonzero(keep)]
    return head[ok], right[ok], grams, texts


def _join(words: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*words, pa.scalar(" ", words[0].type))


def _named(levels: list[Ranks], code: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Language and text of phrases one word longer than ``levels`` reach, from their codes."""
    left, right = code >> 32, [code & _RIGHT]
    for level in reversed(levels[1:]):
        right.append(level.code[left] & _RIGHT)
        left = level.code[left] >> 32
    lang, word = (levels[0].rows.column(c).combine_chunks() for c in ("lang", "phrase"))
    return lang.take(pa.array(left)), _join([word.take(pa.array(i)) for i in (left, *reversed(right))])


def count_longer(slim: DataFrame, sent: list, complete: bool) -> DataFrame:
    """(code or lang and phrase, n) of the phrases one word longer than the ranks ``sent`` reach; ``complete``:
    all frequent ones of the last length have ids, so that there are codes only."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _opened(sent)
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        grams: list[np.ndarray] = []
        texts: Counter = Counter()
        held = apart = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, apart
            pairs = np.concatenate(left), np.concatenate(right)
            left.clear(), right.clear()
            code, n = count_pairs(*pairs)
            del pairs
            none = pa.nulls(len(code), pa.string())
            yield pa.record_batch({"code": pa.array(code), "lang": none, "phrase": none, "n": pa.array(n, pa.int64())})
            if apart:
                rows, n = count_grams(np.concatenate(grams))
                lang, word = (levels[0].rows.column(c).combine_chunks() for c in ("lang", "phrase"))
                yield pa.record_batch({"code": pa.nulls(len(rows), pa.int64()), "lang": lang.take(pa.array(rows[:, 0])),
                                       "phrase": _join([word.take(pa.array(c)) for c in rows.T]), "n": pa.array(n, pa.int64())})
            if texts:
                rows = _text_rows(texts)
                yield pa.record_batch({"code": pa.nulls(rows.num_rows, pa.int64()),
                                       **{c: rows.column(c) for c in ("lang", "phrase", "n")}})
            grams.clear(), texts.clear()
            held = apart = 0

        for batch in batches:
            for part in text_slices(batch, "text"):
                for lang, docs in by_lang(part).items():
                    a, b, ids, other = extend(words_of(docs), lang, levels)
                    left.append(a)
                    right.append(b)
                    if len(ids):
                        grams.append(ids)
                    texts.update((lang, p) for p in other)
                    held += len(a)
                    apart += len(ids)
                if held >= PAIRS_HELD or apart >= GRAMS_HELD or len(texts) >= TEXTS_HELD:
                    yield from flush()
        if left:
            yield from flush()

    rows = slim.mapInArrow(scan, "code long, lang string, phrase string, n long")
    keys = ["code"] if complete else ["code", "lang", "phrase"]
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"))


def name_codes(found: DataFrame, sent: list) -> DataFrame:
    """(code, lang, phrase, n) of rows (code, n), named by the ranks ``sent``, whose codes these are."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _opened(sent)
        for batch in batches:
            lang, phrase = _named(levels, batch.column("code").to_numpy())
            yield pa.record_batch({"code": batch.column("code"), "lang": lang, "phrase": phrase, "n": batch.column("n")})

    return found.select("code", "n").mapInArrow(scan, "code long, lang string, phrase string, n long")


def bits_of(phrases: DataFrame, sent: list, complete: bool) -> np.ndarray:
    """A filter that the rows (lang, phrase) pass: by the ids of their words, if ``complete``: all words have one."""
    if not complete:
        return bloom_of(phrases.select(F.xxhash64(F.concat_ws("\n", "lang", "phrase")).alias("h")), "h")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _opened(sent)[0].ids
        for batch in batches:
            word = np.array([[ids[lang][w] for w in p.split(b" ")] for lang, p in
                             zip(batch.column("lang").to_pylist(), batch.column("phrase").cast(pa.binary()).to_pylist())], np.int32)
            if len(word):
                h = gram_hashes(word.ravel(), word.shape[1])[::word.shape[1]]
                yield pa.record_batch({"h": pa.array(h.view(np.int64))})

    return bloom_of(phrases.select("lang", "phrase").mapInArrow(scan, "h long"), "h")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, longest: int = LONGEST, ranked: int = RANKED,
         text_col: str = "text", lang_col: str = "lang", longer: int = LONGER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of each
    language that occur ``min_count`` times, by their lowest 1000 a n / (l r) over all cuts
    into a first part of l and a rest of r occurrences, rounded down.

    Phrases inside a longer one that is as frequent are left out. Languages of NULL count as
    ``und``, texts of NULL as empty; texts are taken whole, repeated rows each by itself. A table
    without frequent words gives no rows. Other columns are ignored. The frequent phrases of each
    length are written to the shared folder, from where the next length starts."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/collocations-{uuid.uuid4().hex}"
    slim = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    count_words(slim).where(F.col("phrase").isNull() | (F.col("n") >= min_count)).write.parquet(f"{folder}/1")
    words = spark.read.parquet(f"{folder}/1")
    total = words.where(F.col("phrase").isNull()).select("lang", F.col("n").alias("total"))
    tables = [words.where(F.col("phrase").isNotNull())]
    sent: list = []
    known: list[bool] = []  # all of a length have ids
    for size in range(2, longest + 1):
        last = tables[-1]
        limit = ranked if size == 2 else longer
        known.append(all(known) and last.count() <= limit)
        by_rank = last.where(F.col("code").isNotNull()) if size > 2 else last
        by_rank = assign_ids(by_rank.withColumn("neg", -F.col("n")), ["neg", "lang", "phrase"], start_after=-1)
        rows = by_rank.where(F.col("id") < limit).select("id", *(["code"] if size > 2 else ["lang", "phrase"]))
        rows = rows.toArrow().sort_by("id").drop_columns("id")  # at most ``limit`` rows
        bits = None if known[-1] else bits_of(last, sent[:1], known[0])
        sent.append(spark.sparkContext.broadcast({"rows": rows, "complete": known[-1], "bits": bits}))
        found = count_longer(slim, sent, known[-1]).where(F.col("n") >= min_count)
        if known[-1]:
            named = name_codes(found, sent)
        else:
            # Written once: rows with a code are named, the others have their names.
            found.write.parquet(f"{folder}/{size}-found")
            found = spark.read.parquet(f"{folder}/{size}-found")
            named = name_codes(found.where(F.col("code").isNotNull()), sent).unionByName(found.where(F.col("code").isNull()))
        named.write.parquet(f"{folder}/{size}")
        tables.append(spark.read.parquet(f"{folder}/{size}"))
    return score_phrases([t.select("lang", "phrase", "n") for t in tables], total, top)


def score_phrases(tables: list[DataFrame], total: DataFrame, top: int) -> DataFrame:
    """The ranked phrases from the frequent phrases (lang, phrase, n) of each length, words first,
    and the number of words of each language."""
    counts, candidates = tables[0], None
    for k, t in enumerate(tables[1:], 1):
        counts = counts.unionByName(t)
        if k + 1 < len(tables):
            # A phrase as frequent as one that holds it is inside one of a word more that is as frequent.
            w = F.split("phrase", " ")
            inside = F.explode(F.array(F.array_join(F.slice(w, 1, k + 1), " "), F.array_join(F.slice(w, 2, k + 1), " ")))
            longer = (tables[k + 1].select("lang", inside.alias("phrase"), "n")
                      .groupBy("lang", "phrase").agg(F.max("n").alias("most")))
            t = (t.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.col("most") < F.col("n"), F.lit(True)))
                 .select("lang", "phrase", "n"))
        candidates = t if candidates is None else candidates.unionByName(t)
    w = F.split("phrase", " ")
    cuts = (candidates.select("lang", "phrase", F.col("n").alias("a"), F.size(w).alias("size"))
            .withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
            .withColumn("left", F.array_join(F.slice(w, F.lit(1), F.col("k")), " "))
            .withColumn("right", F.array_join(F.slice(w, F.col("k") + 1, F.col("size") - F.col("k")), " ")))
    one = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    two = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # The few rows of the languages are copied, so that no language meets in one task.
    salts = 32
    spread = total.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    whole = "decimal(18,0)"
    score = F.expr(f"(CAST(1000 * a AS {whole}) * CAST(total AS {whole})) div (CAST(l AS {whole}) * CAST(r AS {whole}))")
    scored = (cuts.join(one, ["lang", "left"]).join(two, ["lang", "right"])
              .withColumn("salt", F.pmod(F.hash("phrase"), F.lit(salts))).join(spread, ["lang", "salt"])
              .withColumn("score", score)
              .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("total").alias("n"), F.first("salt").alias("salt"),
                                             F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "salt", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    return (part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
