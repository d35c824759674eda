"""Alignment of the tokens of two tokenizers over the same bytes.

``align`` divides and conquers: of the byte offsets where a token of either side ends, a
common one near the middle is located by bisection, and both halves are aligned by
themselves; a stretch without a common end inside is a leaf group, whose tokens are linked
where their bytes overlap. The texts of a slice are divided together, one numpy pass for each
depth of the recursion.

Tokens are made for the stretches between spaces that follow something else than white space:
there both tokenizers end a token (neither the pattern of the one nor any piece of the other
reaches across). A task tokenises each distinct stretch, about a word, once.

Counts of linked id pairs over the whole corpus come from the distinct pairs of blocks of
texts: each block lists its pairs once with their counts, each text holds the numbers of
its pairs in that list. The totals go back to the blocks by a join on the pair, so what is
shuffled is one row for each block and distinct pair, and the numbers.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import LATIN, TAIL, byte_letters, ensure_checkpoint_dir, latin_ids, text_slices, without_gc

#: A block of texts ends once it has this many links.
BLOCK_LINKS = 2_000_000
#: Longer stretches are tokenised each time; what a task holds is dropped when there are as many as this.
STRETCH_BYTES, STRETCHES_HELD = 64, 1_200_000


def common_near(common: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each interval lo:hi of the ends of A the index of a common end near its middle, -1 if there is
    none (the last end of an interval is common and does not count). Ends about the middle are
    looked at in windows that grow while some interval has found none."""
    out = np.full(len(lo), -1, np.int64)
    mid = (lo + hi - 2) // 2
    open_, width = np.flatnonzero(hi - lo > 1), 1
    while len(open_):
        first, last = np.maximum(lo[open_], mid[open_] - width), np.minimum(hi[open_] - 2, mid[open_] + width)
        n = last - first + 1
        at = np.cumsum(n) - n
        i = np.arange(int(n.sum())) - np.repeat(at - first, n)
        far = np.abs(i - np.repeat(mid[open_], n))
        best = np.minimum.reduceat(np.where(common[i], 2 * far + (i > np.repeat(mid[open_], n)),
                                            np.iinfo(np.int64).max), at)
        hit = best < np.iinfo(np.int64).max
        out[open_[hit]] = mid[open_[hit]] + np.where(best[hit] & 1, best[hit] >> 1, -(best[hit] >> 1))
        open_ = open_[~hit & ((first > lo[open_]) | (last < hi[open_] - 2))]
        width *= 4
    return out


def align(a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of the tokens of many texts that stand end to end: ``a`` and ``b`` are the
    ascending ends of both sides, ``cuts`` the indexes in ``a`` where texts end (exclusive, ascending;
    such an end is common). Returns where each group ends in ``a`` and in ``b`` (exclusive).

    Each end of ``a`` is looked for in ``b`` by bisection, once. All texts are divided at once: each
    round splits every open interval at its common end."""
    hi = np.unique(cuts[cuts > 0])
    lo = np.r_[0, hi[:-1]] if len(hi) else hi
    leaf = []
    common = b[np.searchsorted(b, a)] == a if len(hi) else hi
    while len(lo):
        i = common_near(common, lo, hi)
        leaf.append(hi[i < 0])
        on = i >= 0
        lo, hi = np.r_[lo[on], i[on] + 1], np.r_[i[on] + 1, hi[on]]
    end = np.sort(np.concatenate(leaf)) if leaf else hi
    return end, np.searchsorted(b, a[end - 1]) + 1 if len(end) else end


def runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each run, end to end."""
    before = np.cumsum(n) - n
    return np.repeat(start - before, n) + np.arange(int(n.sum()))


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (i, j) of the tokens whose bytes overlap: each end of either side closes
    one overlap, ends of both sides only one. The pairs closed by ends of ``a`` come first;
    the last result says how many these are before each pair of ``b`` (its ``a`` index)."""
    j = np.searchsorted(b, a)
    more = np.ones(len(b), bool)
    more[j[b[j] == a] if len(a) else j] = False
    extra = np.flatnonzero(more)
    i = np.searchsorted(a, b[extra])
    return j, extra, i


class Bytes:
    """The bytes of the tokens of one side, end to end by id."""

    def __init__(self, of: list[bytes]):
        self.raw = np.frombuffer(b"".join(of), np.uint8)
        self.size = np.array([len(x) for x in of], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def give_back(self, ids: np.ndarray, n: np.ndarray, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the tokens of each stretch (``n`` of ``ids`` each) are byte by byte its ``size`` bytes of ``raw``."""
        ends, last = np.r_[0, np.cumsum(self.size[ids])], np.cumsum(n)
        same = ends[last] - ends[last - n] == size
        ids = ids[np.repeat(same, n)]
        odd = np.r_[0, np.cumsum(self.raw[runs(self.start[ids], self.size[ids])] != raw[np.repeat(same, size)])]
        last = np.cumsum(size[same])
        same[same] = odd[last] == odd[last - size[same]]
        return same


class Tokenizers:
    """Both tokenizers with the bytes of their tokens: A byte-level, B of pieces."""

    def __init__(self, spec: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer  # the libraries are loaded where they are used
        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        letter = byte_letters()
        special = {t["id"] for t in json.loads(spec)["added_tokens"]}
        of = {i: b"" if i in special else bytes(letter[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.a_bytes = Bytes([of.get(i, b"") for i in range(max(of) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = Bytes([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                              for i, p in enumerate(pieces)])
        #: No piece reaches from something else into a following space: a space may be cut off.
        self.cuts = not any("▁" in p.lstrip("▁") for i, p in enumerate(pieces)
                            if not self.b.is_control(i) and not self.b.is_unknown(i))

    def stretches(self, text: str) -> list[str]:
        """Parts of the spaced text (" " and the text) between known common ends, each
        without the space that it begins with."""
        if not self.cuts:
            return [text]
        parts = text.split(" ")
        if "" in parts or any(p[-1].isspace() for p in parts):  # more than single spaces: join what must not be cut
            out = [parts[0]]
            for i in range(1, len(parts)):
                # A space after nothing or white space is no cut; neither is one that ends the text.
                if not out[-1] or out[-1][-1].isspace() or (i == len(parts) - 1 and not parts[i]):
                    out[-1] += " " + parts[i]
                else:
                    out.append(parts[i])
            parts = out
        return parts


class Ids:
    """Token ids of numbered stretches by one side, end to end."""

    def __init__(self):
        self.ids, self.edge, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0

    def add(self, ids: np.ndarray, n: np.ndarray) -> None:
        used = int(self.edge[self.n])
        for name, least in (("ids", used + len(ids)), ("edge", self.n + len(n) + 1)):
            if least > len(held := getattr(self, name)):
                setattr(self, name, np.r_[held, np.zeros(max(least, 2 * len(held)) - len(held), held.dtype)])
        self.ids[used:used + len(ids)] = ids
        self.edge[self.n + 1:self.n + 1 + len(n)] = used + np.cumsum(n)
        self.n += len(n)

    def of(self, no: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches ``no`` end to end, and how many of them each stretch has."""
        n = self.edge[no + 1] - self.edge[no]
        return self.ids[runs(self.edge[no], n)].astype(np.int64), n


class Held(dict):
    """Stretch -> its number in ``a`` and ``b``, which have its ids by A and by B, or -1 where they do not
    give its bytes."""

    def __init__(self, tokenizers: Tokenizers):
        super().__init__()
        self.t = tokenizers
        self.a_ids: dict[str, bytes] = {}
        self.a, self.b = Ids(), Ids()

    def learn(self, parts: list[str]) -> None:
        if not parts:
            return
        t = self.t
        by_a, by_b = self.by_a([" " + p for p in parts]), t.b.encode(parts, num_threads=1)
        a, n_a = np.frombuffer(b"".join(by_a), np.uint32), np.fromiter(map(len, by_a), np.int64, len(parts)) >> 2
        n_b = np.fromiter(map(len, by_b), np.int64, len(parts))
        b = np.fromiter(chain.from_iterable(by_b), np.uint32, int(n_b.sum()))
        raw = np.frombuffer((" " + " ".join(parts)).encode(), np.uint8)
        size = np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in parts), np.int64, len(parts)) + 1
        same = t.a_bytes.give_back(a, n_a, raw, size) & t.b_bytes.give_back(b, n_b, raw, size)
        self.update(zip(parts, np.where(same, self.a.n + np.arange(len(parts)), -1).tolist()))
        self.a.add(a, n_a)
        self.b.add(b, n_b)

    def by_a(self, parts: list[str]) -> list[bytes]:
        """Ids of the parts by A; punctuation after a word of plain letters is made by itself."""
        split = []
        for p in parts:
            m = TAIL.fullmatch(p)
            split.append((m[1], m[2]) if m else (p,))
        ids = self.a_ids
        other, model = [], self.t.a.model
        for w in {x for s in split for x in s if x not in ids}:
            if LATIN.fullmatch(w):
                ids[w] = latin_ids(model, w)
            else:
                other.append(w)
        for w, e in zip(other, self.t.a.encode_batch(other, add_special_tokens=False)):
            ids[w] = array("I", e.ids).tobytes()
        out = [b"".join(map(ids.__getitem__, s)) for s in split]
        for w in other:
            if len(w) > STRETCH_BYTES:
                del ids[w]
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """Which texts have tokens, their ids by A and by B end to end, and where each text ends in both."""
        split = [self.t.stretches(x) if x else [] for x in texts]
        new = {p for p in set().union(*split) if p not in self}
        if len(self) + len(new) > STRETCHES_HELD:
            self.clear(), self.a_ids.clear()
            self.a, self.b = Ids(), Ids()
            new = set().union(*split)
        long = [p for p in new if len(p) > STRETCH_BYTES]
        self.learn([p for p in new if len(p) <= STRETCH_BYTES])
        kept = self.a.n
        self.learn(long)
        n = np.fromiter(map(len, split), np.int64, len(split))
        no = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
        odd, last = np.r_[0, np.cumsum(no < 0)], np.cumsum(n)
        on = (n > 0) & (odd[last] == odd[last - n])
        no, last = no[np.repeat(on, n)], np.cumsum(n[on])
        (a, n_a), (b, n_b) = self.a.of(no), self.b.of(no)
        for p in long:
            del self[p]
        self.a.n = self.b.n = kept
        return np.flatnonzero(on), a, b, *(np.r_[0, np.cumsum(x)][last] for x in (n_a, n_b))


@dataclass
class Texts:
    """Aligned texts of a slice, those without tokens left out."""
    no: np.ndarray        # number of each text in the slice
    a: np.ndarray         # ids of A end to end
    b: np.ndarray
    a_cut: np.ndarray     # where texts end in a
    b_cut: np.ndarray
    a_end: np.ndarray     # where groups end in a
    b_end: np.ndarray
    a_byte: np.ndarray    # where tokens end in the bytes
    b_byte: np.ndarray


def align_texts_of(held: Held, texts: list[str | None]) -> Texts:
    no, a, b, a_cut, b_cut = held.encode(texts)
    a_byte, b_byte = np.cumsum(held.t.a_bytes.size[a]), np.cumsum(held.t.b_bytes.size[b])
    return Texts(no, a, b, a_cut, b_cut, *align(a_byte, b_byte, a_cut), a_byte, b_byte)


class Names(dict):
    """A token of A (id << 2) or B (id << 2 | 2), the last of its group (| 1) or not, as it is written."""

    def __missing__(self, code: int) -> bytes:
        self[code] = out = f"{code >> 2}{((',', '|'), (',', ';'))[code >> 1 & 1][code & 1]}".encode()
        return out


def written(x: Texts, name: Names) -> list[bytes]:
    """The groups of each text as `a1,a2|b1;a3|b2,b3`."""
    last_a, last_b = np.zeros(len(x.a), bool), np.zeros(len(x.b), bool)
    last_a[x.a_end - 1] = last_b[x.b_end - 1] = True
    # A token of A stands behind all of B in earlier groups, one of B behind all of A up to its own group.
    g_a, g_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order = np.empty(len(x.a) + len(x.b), np.int64)
    order[np.arange(len(x.a)) + np.r_[0, x.b_end][g_a]] = x.a << 2 | last_a
    order[np.arange(len(x.b)) + x.a_end[g_b]] = x.b << 2 | 2 | last_b
    cut = (x.a_cut + x.b_cut).tolist()
    codes = order.tolist()
    return [b"".join(map(name.__getitem__, codes[i:j]))[:-1] for i, j in zip([0, *cut], cut)]


def _small(x: np.ndarray) -> bytes:
    """Non-negative numbers in the least width that holds them, which comes first."""
    kind = np.min_scalar_type(int(x.max()) if len(x) else 0)
    return bytes([kind.itemsize]) + x.astype(kind).tobytes()


def _back(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64)


#: Rows of documents (doc_id to at, times) and of blocks (pairs, counts) in one table.
_COLUMNS = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, is_doc boolean, "
            "at binary, times binary, pairs array<long>, counts array<long>")


def align_blocks(docs: DataFrame, spec: str, model: bytes, id_col: str, text_col: str,
                 block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row a document, and one row a block of documents with its distinct pairs."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = Held(Tokenizers(spec, model)), Names()
        block = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        names: list[pa.Array] = []
        rows: list[np.ndarray] = []     # n_a, n_b, n_groups, n_links of the texts of a slice
        digests: list[str] = []
        found: list[np.ndarray] = []    # pairs of the links
        owner: list[np.ndarray] = []    # and the text of the block that they stand in
        size = texts = 0

        def take(part: pa.RecordBatch) -> None:
            nonlocal size, texts
            x = align_texts_of(held, part.column("text").to_pylist())
            j, extra, i = links(x.a_byte, x.b_byte)
            # Texts of the links: that of the token whose end closes them.
            of_a, of_b = np.searchsorted(x.a_cut, np.arange(len(x.a)), side="right"), np.searchsorted(x.b_cut, extra, side="right")
            row = np.zeros((part.num_rows, 4), np.int64)
            count = [np.diff(c, prepend=0) for c in (x.a_cut, x.b_cut)]
            n = len(x.no)
            row[x.no] = np.stack([*count, np.bincount(np.searchsorted(x.a_cut, x.a_end - 1, side="right"), minlength=n)[:n],
                                  np.bincount(np.r_[of_a, of_b], minlength=n)[:n]], axis=1)
            digest = [""] * part.num_rows
            for no, text in zip(x.no.tolist(), written(x, name)):
                digest[no] = hashlib.sha256(text).hexdigest()
            names.append(part.column("doc_id"))
            rows.append(row)
            digests.extend(digest)
            found.append(np.r_[x.a << 32 | x.b[j], x.a[i] << 32 | x.b[extra]] if len(x.a) else j)
            owner.append(x.no[np.r_[of_a, of_b]] + texts if n else j)
            size, texts = size + len(found[-1]), texts + part.num_rows

        def flush() -> Iterator[pa.RecordBatch]:
            """Documents of the block with their links as (number, times); its pairs come most frequent
            first, so that numbers and the steps between them are small."""
            nonlocal block, size, texts
            codes = np.concatenate(found)
            pair = np.unique(codes)
            inverse = np.searchsorted(pair, codes)
            count = np.bincount(inverse, minlength=len(pair))
            by_count = np.argsort(-count, kind="stable")
            number = np.empty(len(pair), np.int64)
            number[by_count] = np.arange(len(pair))
            of, n = np.unique(np.concatenate(owner) << 32 | number[inverse], return_counts=True)
            cut = np.searchsorted(of >> 32, np.arange(texts + 1)).tolist()
            of &= (1 << 32) - 1
            at = [_small(np.diff(of[i:j], prepend=0)) for i, j in zip(cut, cut[1:])]
            times = [_small(n[i:j]) for i, j in zip(cut, cut[1:])]
            row = np.concatenate(rows)
            none = pa.nulls(texts, pa.list_(pa.int64()))
            yield pa.record_batch({
                "doc_id": pa.concat_arrays(names), **{c: pa.array(row[:, k]) for k, c in enumerate(
                    ("n_a", "n_b", "n_groups", "n_links"))}, "groups_sha256": pa.array(digests, pa.string()),
                "block": pa.array([block] * texts, pa.int64()), "is_doc": pa.array([True] * texts),
                "at": pa.array(at, pa.binary()), "times": pa.array(times, pa.binary()), "pairs": none, "counts": none})
            if len(pair):
                empty = pa.nulls(1, pa.int64())
                yield pa.record_batch({
                    "doc_id": pa.nulls(1, names[0].type), "n_a": empty, "n_b": empty, "n_groups": empty, "n_links": empty,
                    "groups_sha256": pa.nulls(1, pa.string()), "block": pa.array([block], pa.int64()),
                    "is_doc": pa.array([False]), "at": pa.nulls(1, pa.binary()), "times": pa.nulls(1, pa.binary()),
                    "pairs": pa.array([pair[by_count]], pa.list_(pa.int64())),
                    "counts": pa.array([count[by_count]], pa.list_(pa.int64()))})
            block, size, texts = block + 1, 0, 0
            for x in (names, rows, digests, found, owner):
                x.clear()

        for batch in batches:
            for part in text_slices(batch, "text"):
                take(part)
                if size >= block_links:
                    yield from flush()
        if texts:
            yield from flush()

    return slim.mapInArrow(without_gc(scan), f"doc_id {kind}, {_COLUMNS}")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (A id << 32 | B id), its links corpus-wide, and whether no pair of its B id has more."""
    pairs = (blocks.where(~F.col("is_doc")).select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
             .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count")))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    best = pairs.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return (pairs.withColumn("b", b).join(best, "b")
            .select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def align_texts(docs: DataFrame, spec: str, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                block_links: int = BLOCK_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    ``spec`` is the JSON text of a byte-level tokenizer (A), ``model`` a model of pieces with
    byte fallback (B); both have the size of a vocabulary and travel with the function.
    Special tokens count as plain text. NULL and empty texts, and texts that the tokens of either
    side do not give back byte by byte after a space, have no tokens: zeros and an empty digest.
    Texts are taken whole, whatever their length; repeated rows count each by itself. An
    empty table gives no rows. Other columns are ignored. The aligned blocks are written once to
    the shared folder: the counts of the corpus are needed before any row is complete."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/align-{uuid.uuid4().hex}"
    (align_blocks(docs, spec, model, id_col, text_col, block_links)
     .write.option("compression", "zstd").parquet(path))
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_id"].dataType.simpleString()
    listed = (blocks.where(~F.col("is_doc")).select("block", F.posexplode("pairs").alias("no", "pair"))
              .join(pair_counts(blocks), "pair").select("block", "no", "count", "best"))
    texts = spark.read.parquet(path).where("is_doc").drop("is_doc", "pairs", "counts")

    def add_up(key: tuple, rows: pa.Table, pairs: pa.Table) -> pa.Table:
        """A block's documents with the sums over their links; its pairs are those of at most
        ``block_links`` links and one text."""
        n = pairs.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        no = pairs.column("no").to_numpy()
        count[no] = pairs.column("count").to_numpy()
        best[no] = pc.cast(pairs.column("best"), pa.int64()).to_numpy()
        n_best, total = [], []
        for at, times in zip(rows.column("at").to_pylist(), rows.column("times").to_pylist()):
            no, times = np.cumsum(_back(at)), _back(times)
            n_best.append(int((best[no] * times).sum()))
            total.append(int((count[no] * times).sum()))
        return (rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
                .append_column("n_best", pa.array(n_best, pa.int64()))
                .append_column("count_sum", pa.array(total, pa.int64()))
                .append_column("groups_sha256", rows.column("groups_sha256").cast(pa.string())))

    return texts.groupBy("block").cogroup(listed.groupBy("block")).applyInArrow(
        add_up, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align_text(held: Held, text: str) -> list[tuple[list[int], list[int]]]:
    """Groups (ids of A, ids of B) of one text, for looking at; none where there are no tokens."""
    x = align_texts_of(held, [text])
    return [(x.a[i:j].tolist(), x.b[k:m].tolist()) for i, j, k, m in
            zip(np.r_[0, x.a_end[:-1]], x.a_end, np.r_[0, x.b_end[:-1]], x.b_end)] if len(x.a) else []
