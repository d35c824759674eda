"""Helpers shared by the text operators: Arrow batch sizes, byte views of a
text column, word boundaries and hashes computed with numpy over a whole slice.
"""

from __future__ import annotations

import gc
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffline.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["cut_lineage", "ensure_checkpoint_dir"]

SLICE_BYTES = 2 << 20

# ASCII white space of the word rule [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M = (1 << 64) - 1
_ODD = 0x9E3779B97F4A7C15


class _Local(dict):
    """Arrays made once per process; sent to a worker empty."""

    def __reduce__(self):
        return _Local, ()


_powers = _Local()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = 2000, size: int = 4 << 20) -> None:
    """Bound what one Arrow batch carries to a Python worker, so that a run of
    very long texts does not meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def least_hashes(rows: DataFrame, limit: int) -> list[tuple[str, int]]:
    """(of, h) of the ``limit`` least distinct hashes ``h`` of every ``of``, in order.

    Rows are thinned first: a group of n distinct hashes (counted roughly) keeps those below the
    point under which 4 * limit are expected, and is asked again with a higher point in the rare
    case that fewer than ``limit`` are left. So a group sends a few times ``limit`` rows, however
    many rows and tasks it has.
    """
    spark = rows.sparkSession
    asked = {r.of: min(1.0, 4 * limit / max(1, r.n))
             for r in rows.groupBy("of").agg(F.approx_count_distinct("h").alias("n")).collect()}
    out: list[tuple[str, int]] = []
    while asked:
        points = spark.createDataFrame([(of, int(min((1 << 63) - 1, (share - 0.5) * (1 << 64)))) for of, share in asked.items()],
                                       "of string, point long")
        left = rows.join(F.broadcast(points), "of").where(F.col("h") <= F.col("point")).select("of", "h").distinct()
        found: dict[str, list[int]] = {of: [] for of in asked}
        for r in left.collect():
            found[r.of].append(r.h)
        again = {}
        for of, share in asked.items():
            if len(found[of]) < limit and share < 1.0:
                again[of] = min(1.0, 4 * share)
            else:
                out += [(of, h) for h in sorted(found[of])[:limit]]
        asked = again
    return sorted(out)


def crc_remainder(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (NULL for a NULL id)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % mod


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch with about ``limit`` bytes of text
    each (one row at least: a text is never cut)."""
    n = batch.num_rows
    if not n:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = (np.cumsum(size) - size) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and the n+1 row offsets
    (NULL counts as empty)."""
    array = pc.fill_null(array, "").cast(pa.large_string())
    n = len(array)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64)[array.offset:array.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] \
        else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(sep: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row number of each maximal run outside ``sep`` (a mask
    over the bytes or characters); runs never cross a row boundary."""
    n = len(sep)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~sep
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    first = word.copy()
    first[1:] &= sep[:-1] | cut[1:n]
    last = word.copy()
    last[:-1] &= sep[1:] | cut[1:n]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(kind: str, n: int) -> np.ndarray:
    """1, b, b^2 ... modulo 2^64 for the odd base b or its inverse."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = _ODD if kind == "up" else pow(_ODD, -1, 1 << 64)
        size = n + n // 4
        out = np.full(size, np.uint64(base), np.uint64)
        out[0] = 1
        have = _powers[kind] = np.multiply.accumulate(out)
    return have[:n]


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from prefix sums of a rolling hash."""
    n = len(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * _power("up", n), out=acc[1:])
    return mix((acc[end] - acc[start]) * _power("down", n)[start] + (end - start).astype(np.uint64))


_classes = _Local()


def code_point_class(test: str) -> np.ndarray:
    """For every code point whether ``str.<test>`` holds of it."""
    if test not in _classes:
        _classes[test] = np.fromiter((getattr(chr(i), test)() for i in range(sys.maxunicode + 1)), bool,
                                     sys.maxunicode + 1)
    return _classes[test]


BLOOM_BITS = 1 << 24


def bloom_of(df: DataFrame, column: str) -> np.ndarray:
    """A bit set of fixed size (2^24 bits) of the hashes in a LONG column. It
    only spares rows a shuffle; an exact join always follows, so that a full
    set costs time and never a result."""
    bit = F.pmod(F.col(column), F.lit(BLOOM_BITS))
    words = (df.select(F.shiftright(bit, 6).alias("w"),
                       F.call_function("shiftleft", F.lit(1).cast("long"),
                                       F.pmod(bit, F.lit(64)).cast("int")).alias("v"))
             .groupBy("w").agg(F.bit_or("v").alias("v")).toPandas())
    out = np.zeros(BLOOM_BITS // 64, np.uint64)
    if len(words):
        out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64).view(np.uint64)
    return out


def in_bloom(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.int64) & np.int64(BLOOM_BITS - 1)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def without_gc(scan):
    """``scan`` with the cycle collector off while it runs: it would walk over the millions of
    words that a slice is split into, again and again."""
    def run(batches):
        gc.disable()
        try:
            yield from scan(batches)
        finally:
            gc.enable()
    return run


def byte_letters() -> dict[str, int]:
    """Letter -> byte of the alphabet of byte-level tokenizers: printable bytes stand
    for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for b in range(256):
        if b not in plain:
            out[chr(256 + len(out) - len(plain))] = b
    return out


_LETTER_OF = {b: c for c, b in byte_letters().items()}
#: Words of plain Latin letters, which no normaliser composes and every pattern takes as one token to split.
LATIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Something that ends in an ASCII letter, and punctuation after it: a pattern of letters, digits and others
#: ends a token in between (an apostrophe may begin a contraction and stays out).
TAIL = re.compile(r"(.*[A-Za-z])([!-&(-/:-@\[-`{-~]+)", re.S)


def latin_ids(model, word: str) -> bytes:
    """Ids, as 32-bit numbers, of a word that LATIN matches, straight from the model of a byte-level tokenizer."""
    return array("I", [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(_LETTER_OF))]).tobytes()


class Table:
    """A hash table of non-negative int64 keys and int32 values, looked up and
    filled whole arrays at a time (open addressing, linear probing), with ``room``
    places a key at least."""

    def __init__(self, keys: np.ndarray | None = None, values: np.ndarray | None = None, room: int = 4):
        self.size, self.held, self.room = 1 << 10, 0, room
        self.key, self.value = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int32)
        if keys is not None:
            self.put(keys, values)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(_ODD)
        return (h >> np.uint64(65 - self.size.bit_length())).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys``, -1 for a key that is not held."""
        at = self._at(keys)
        held = self.key[at]
        out = np.where(held == keys, self.value[at], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held != -1))
        where = (at[left] + 1) & (self.size - 1)
        while len(left):
            held, want = self.key[where], keys[left]
            hit = held == want
            out[left[hit]] = self.value[where[hit]]
            on = ~hit & (held != -1)
            left, where = left[on], (where[on] + 1) & (self.size - 1)
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not held yet."""
        if self.room * (self.held + len(keys)) > self.size:
            on = self.key != -1
            keys, values = np.r_[self.key[on], keys], np.r_[self.value[on], values]
            self.size = 1 << (self.room * len(keys) - 1).bit_length()
            self.key, self.value = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int32)
            self.held = 0
        self.held += len(keys)
        at = self._at(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.key[at[left]] == -1]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.key[at[put]], self.value[at[put]] = keys[put], values[put]
            left = left[self.key[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (self.size - 1)
