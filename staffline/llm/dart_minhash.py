"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is the weighted set of its 5-word shingles (weight: how often each
occurs). Every shingle owns a fixed, hashed scatter of darts over the plane of
weight and time; a document catches the darts below its weights, thrown until
every one of ``K`` coordinates has been hit, and each coordinate keeps its
earliest dart. Two documents agree in a coordinate with the probability of
their weighted Jaccard similarity.

Equal texts are merged first. Bands of the signature are joined on equality:
every member of a band links to one centre, not to every other member. Links
are settled by the signature where it is decisive and by the exact weighted
sets where not. Bands that still hold several classes afterwards are compared
exactly inside tasks, in tiles of bounded size, so that no two texts that share
a band go untested; only links that join classes leave a task. Classes are
the connected components of the links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import (LOWER, SPACE, bloom_of, cut_lineage, in_bloom, mix, span_hashes, text_bytes,
                                  text_slices, word_spans)

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
K = BANDS * ROWS
#: Members of a band compared at once, a side.
TILE = 1500
#: Agreeing coordinates beyond which a link, or below which no link, is certain but for about one pair in 10^5
#: at the limit: 4.5 standard deviations of K draws around SIMILARITY.
_SIGMA = (SIMILARITY * (1 - SIMILARITY) / K) ** 0.5
SURE, NEVER = SIMILARITY + 4.5 * _SIGMA, SIMILARITY - 4.5 * _SIGMA


def _chain(x: np.ndarray, y: np.ndarray | int) -> np.ndarray:
    return mix(x * np.uint64(0x9E3779B97F4A7C15) + np.asarray(y, np.uint64))


def _unit(h: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def shingles(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """(row, shingle hash, weight) of all distinct shingles of a text column,
    ordered by row, and a 16-byte key of each row's word sequence (None without words).
    Words are split at ASCII white space, A-Z in lower case; a text of fewer than
    5 words is one shingle."""
    data, off = text_bytes(array)
    data = LOWER[data]
    start, end, row = word_spans(SPACE[data], off)
    word = span_hashes(data, start, end)
    n = len(array)
    at = np.searchsorted(row, np.arange(n + 1))
    keys = [hashlib.blake2b(word[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    size = np.diff(at)
    grams = np.maximum(size - WORDS + 1, (size > 0).astype(np.int64))
    of = np.repeat(np.arange(n), grams)
    first = np.arange(len(of)) - np.repeat(np.cumsum(grams) - grams, grams) + at[of]
    h = np.zeros(len(of), np.uint64)
    for j in range(WORDS):
        i = first + j
        inside = i < at[of + 1]
        h = _chain(h, np.where(inside, word[np.minimum(i, max(len(word) - 1, 0))] if len(word) else 0, np.uint64(0)))
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.flatnonzero(np.r_[True, (np.diff(of) != 0) | (h[1:] != h[:-1])]) if len(of) else np.zeros(0, np.int64)
    return of[new], h[new], np.diff(np.r_[new, len(of)]), keys


def signatures(row: np.ndarray, item: np.ndarray, weight: np.ndarray, rows: int, k: int = K) -> np.ndarray:
    """(rows, k) dart names: at each coordinate the earliest dart that the
    row's weighted set catches. Rows without items stay 0."""
    out = np.zeros((rows, k), np.uint64)
    total = np.bincount(row, weights=weight, minlength=rows)
    todo = np.flatnonzero(total > 0)
    throws = k * (np.log(k) + 3.0)  # darts expected per row in the first throw: few rows miss a coordinate
    while len(todo):
        number = np.full(rows, -1, np.int64)
        number[todo] = np.arange(len(todo))
        mine = number[row] >= 0
        r, x, w = number[row[mine]], item[mine], weight[mine].astype(np.float64)
        until = throws / total[todo]
        cells: list[np.ndarray] = []
        times: list[np.ndarray] = []
        names: list[np.ndarray] = []
        low, strip = 0.0, 0
        while len(r):
            # Region of weights (low, low + width]: its darts come one after the other, each gap exponential.
            width = max(low, 1.0)
            seed = _chain(x, strip)
            on, time, i = np.arange(len(r)), np.zeros(len(r)), 0
            while len(on):
                dart = _chain(seed[on], i)
                time = time - np.log(_unit(dart)) / width
                keep = time <= until[r[on]]
                on, time, dart = on[keep], time[keep], dart[keep]
                caught = low + width * _unit(_chain(dart, 1)) <= w[on]
                place = _chain(dart, 2)
                cells.append(r[on[caught]] * k + (place[caught] % np.uint64(k)).astype(np.int64))
                times.append(time[caught])
                names.append(_chain(dart[caught], 3))
                i += 1
            low, strip = low + width, strip + 1
            more = w > low
            r, x, w = r[more], x[more], w[more]
        cell, time, name = np.concatenate(cells), np.concatenate(times), np.concatenate(names)
        least = np.full(len(todo) * k, np.inf)
        np.minimum.at(least, cell, time)
        got = np.zeros(len(todo) * k, np.uint64)
        first = time == least[cell]
        got[cell[first]] = name[first]
        full = np.isfinite(least).reshape(len(todo), k).all(1)
        out[todo[full]] = got.reshape(len(todo), k)[full]
        todo, throws = todo[~full], throws * 2
    return out


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays in which each item stands as often as it weighs."""
    both = np.sort(np.concatenate([a, b]))
    if not len(both):
        return 0.0
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[ia], cb[ib]).sum())
    return common / (len(both) - common)


def _sketch(docs: DataFrame) -> DataFrame:
    def scan(batches):
        for batch in batches:
            for part in text_slices(batch):
                n = part.num_rows
                row, item, weight, keys = shingles(part.column("text"))
                sig = signatures(row, item, weight, n)
                band = sig.reshape(n, BANDS, ROWS)
                h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
                for j in range(ROWS):
                    h = _chain(h, band[:, :, j])
                small = sig.astype(np.uint16)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "h": part.column("h"), "key": pa.array(keys, pa.binary()),
                    "sig": pa.array([s.tobytes() for s in small], pa.binary()),
                    "bands": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()),
                                                      pa.array(h.ravel().view(np.int64), pa.int64()))})

    return docs.mapInArrow(scan, f"doc_id {dict(docs.dtypes)['doc_id']}, h long, key binary, sig binary, bands array<long>")


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs with the share of coordinates in which their signatures agree."""
    sig = nodes.select("key", "sig")
    both = (pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b"))

    def share(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, K)
                    for c in ("sig_a", "sig_b"))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"),
                                   "share": pa.array((a == b).mean(1), pa.float64())})

    return both.mapInArrow(share, "a binary, b binary, share double")


def _sets(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key, items: the weighted shingle set of each wanted key, once. A bit set
    of fixed size spares the others a shuffle; the join is exact."""
    short = F.conv(F.hex(F.substring("key", 1, 6)), 16, 10).cast("long")
    bits = bloom_of(keys.select(short.alias("k")), "k")

    def scan(batches):
        for batch in batches:
            for part in text_slices(batch):
                row, item, weight, all_keys = shingles(part.column("text"))
                first = np.array([int.from_bytes(k[:6], "big") if k else 0 for k in all_keys], np.uint64)
                rows = np.flatnonzero(in_bloom(bits, first) & np.array([k is not None for k in all_keys]))
                at = np.searchsorted(row, np.arange(part.num_rows + 1))
                sets = [np.sort(np.repeat((item[at[r]:at[r + 1]] >> np.uint64(32)).astype(np.uint32),
                                          weight[at[r]:at[r + 1]])).tobytes() for r in rows]
                yield pa.record_batch({"key": pa.array([all_keys[r] for r in rows], pa.binary()),
                                       "items": pa.array(sets, pa.binary())})

    found = docs.select("text").mapInArrow(scan, "key binary, items binary")
    return found.join(keys, "key", "left_semi").groupBy("key").agg(F.first("items").alias("items"))


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough: by the signature where that is
    decisive, else by the exact weighted sets."""
    judged = cut_lineage(_estimated(pairs, nodes).where(F.col("share") >= NEVER))
    sure = judged.where(F.col("share") >= SURE).select("a", "b")
    open_ = judged.where(F.col("share") < SURE).select("a", "b")
    keys = open_.select(F.col("a").alias("key")).union(open_.select("b")).distinct()
    sets = _sets(docs, cut_lineage(keys))
    both = open_.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")

    def exact(batches):
        for batch in batches:
            near = np.array([weighted_jaccard(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) >= SIMILARITY
                             for x, y in zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist())],
                            bool)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return cut_lineage(sure.unionByName(both.mapInArrow(exact, "a binary, b binary")))


def joining_pairs(items: list[np.ndarray], label: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows that are similar enough and, taken in order, each join two
    classes (``label``) that were apart: at most one less than there are classes.
    All similarities come exactly from blocked products of the rows' item matrices; an
    item that occurs w times in a row is w columns."""
    size = np.array([len(i) for i in items])
    row = np.repeat(np.arange(len(items)), size)
    value = np.concatenate(items).astype(np.uint64) if len(items) else np.zeros(0, np.uint64)
    new = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (value[1:] != value[:-1])]) if len(value) else value
    copy = np.arange(len(value)) - np.repeat(new, np.diff(np.r_[new, len(value)]))
    _, column, count = np.unique(value | copy.astype(np.uint64) << np.uint64(32), return_inverse=True,
                                 return_counts=True)
    shared = count >= 2
    number = np.cumsum(shared) - 1
    on = shared[column]
    row, column = row[on], number[column[on]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(items), len(items)), np.float32)
    width = 2048
    edge = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for k, (a, b) in enumerate(zip(edge, edge[1:])):
        part = np.zeros((len(items), width), np.float32)
        part[row[a:b], column[a:b] - k * width] = 1.0
        common += part @ part.T
    label = label.copy()
    out = []
    for i in range(len(items)):
        alike = common[i] >= SIMILARITY * (size[i] + size - common[i])
        near = np.flatnonzero(alike & (label != label[i]))
        if len(near):
            joined, first = np.unique(label[near], return_index=True)
            out += [(i, int(j)) for j in near[first]]
            label[np.isin(label, joined)] = label[i]
    return out


def _links_across(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between members (band, key, label) of one band that have
    different labels: enough of them to join all that belong together. A band is
    compared inside tasks, tile by tile of at most about TILE members a side, and
    no pair leaves that joins nothing new."""
    members = cut_lineage(members)
    sets = _sets(docs, members.select("key").distinct())
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    tiles = (members.join(sizes, "band")
             .withColumn("parts", F.ceil(F.col("n") / TILE))
             .withColumn("mine", F.pmod(F.xxhash64("key"), F.col("parts")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select("band", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
                     "key", "label"))

    def compare(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_pylist()
        _, label = np.unique(np.array([x.hex() for x in table.column("label").to_pylist()]), return_inverse=True)
        items = [np.frombuffer(x, np.uint32) for x in table.column("items").to_pylist()]
        pairs = joining_pairs(items, label)
        return pa.table({"a": pa.array([max(keys[i], keys[j]) for i, j in pairs], pa.binary()),
                         "b": pa.array([min(keys[i], keys[j]) for i, j in pairs], pa.binary())})

    return (tiles.join(sets, "key").groupBy("band", "low", "high").applyInArrow(compare, "a binary, b binary")
            .distinct())


def components(links: DataFrame) -> DataFrame:
    """key, label: the least key of the connected component of each linked
    key. Labels spread over the links and jump to their own label's label
    until nothing changes; each round is written to the shared folder."""
    ways = cut_lineage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                         .select(F.col("a").alias("key"), "label"))
    while True:
        reached = (ways.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near"))
                   .select(F.col("a").alias("key"), "near"))
        new = (labels.join(reached, "key")
               .select("key", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("far"))
        new = cut_lineage(new.join(jump, "label", "left")
                          .select("key", "old", F.least("label", F.coalesce("far", "label")).alias("label")))
        if new.where(F.col("old") != F.col("label")).isEmpty():
            return new.select("key", "label")
        labels = new.select("key", "label")


def _classified(slim: DataFrame) -> DataFrame:
    """doc_id, h (xxhash64 of the text), label (key of the class, NULL without
    words), class_id, class_size of every row of (doc_id, text)."""
    rows = cut_lineage(_sketch(slim.withColumn("h", F.xxhash64("text"))))
    nodes = cut_lineage(rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"),
        F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    bands = nodes.select("key", F.explode("bands").alias("band"))
    centres = (bands.groupBy("band").agg(F.min("key").alias("b"), F.max("key").alias("last"))
               .where(F.col("b") != F.col("last")).select("band", "b"))
    spokes = cut_lineage(bands.join(centres, "band").where(F.col("key") != F.col("b"))
                         .select(F.col("key").alias("a"), "b").distinct())
    links = _links(spokes, nodes, slim)
    labels = components(links)
    # Bands that hold several classes: members may be alike although neither is like the centre.
    named = bands.join(labels, "key", "left").select("band", "key", F.coalesce("label", "key").alias("label"))
    mixed = (named.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where(F.col("lo") != F.col("hi")).select("band"))
    more = cut_lineage(_links_across(named.join(mixed, "band", "left_semi"), slim))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    classes = (nodes.join(labels, "key", "left")
               .select("key", F.coalesce("label", "key").alias("label"), "least", "size"))
    named = classes.groupBy("label").agg(F.min("least").alias("class_id"), F.sum("size").alias("class_size"))
    by_key = classes.select("key", "label").join(named, "label")
    alone = rows.where(F.col("key").isNull()).select(
        "doc_id", "h", F.lit(None).cast("binary").alias("label"), F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"))
    return (rows.where(F.col("key").isNotNull()).select("doc_id", "h", "key").join(by_key, "key")
            .select("doc_id", "h", "label", "class_id", "class_size").unionByName(alone))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (the least id of its class),
    class_size (documents in the class).

    Texts without words (NULL, empty, white space) are never alike: each is a
    class of its own. Rows that repeat an id or a whole row are documents of their
    own, in one class if their texts are alike; a NULL id names no class that
    has another id. An empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _classified(slim).select("doc_id", "class_id", "class_size")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one of least id (of equal rows
    one; of texts that repeat an id the one of least hash). Texts without words
    all stay. Columns and kept rows stay as they are."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    kept = (_classified(slim).where(F.col("label").isNotNull())
            .groupBy("label", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("label").agg(F.min_by(F.struct("doc_id", "h", "n"), order).alias("k")))
    keys = cut_lineage(kept.select(F.col("k.doc_id").alias("__id"), F.col("k.h").alias("__h"), F.col("k.n").alias("__n")))
    has_words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = docs.where(has_words).withColumn("__hash", F.xxhash64(text_col))
    hit = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h"))
    once = marked.join(keys.where(F.col("__n") == 1), hit, "left_semi")
    several = marked.join(keys.where(F.col("__n") > 1), hit, "left_semi").dropDuplicates([id_col, "__hash"])
    return once.unionByName(several).drop("__hash").unionByName(docs.where(~has_words))
