"""Exact nearest neighbours by a block matrix join.

Queries and rows are dealt into blocks of bounded size; one task holds one
(query block, row block) tile. Vectors are quantised to int8 per vector, the
tile's inner products are taken on the integers, and each product gets a bound
on its quantisation error. Only pairs whose least possible distance does not
exceed the k-th smallest greatest possible distance of their query are computed
again in double precision. Per tile the k nearest of each query leave; heaps
merge them, at most ``FAN_IN`` tiles at a time.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 64
#: The integer products are exact in float32 for so many components at a time (127 * 127 * 1024 < 2^24).
EXACT = 1024

SCHEMA = "query_id long, rank int, vec_id long, score double"


def _usable(col):
    """Not NULL, no NULL or non-finite component, and not all zero."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return col.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(col, lambda x: x != 0)


def _quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes (held as float32 for the matrix product), the scale, the
    norm of the rounded vector and the norm of the rounding error."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = np.finfo(float).tiny
    code = np.clip(np.rint(x / scale[:, None]), -127, 127)
    near = code * scale[:, None]
    return code.astype(np.int8), scale, np.sqrt((near * near).sum(1)), np.sqrt(((x - near) ** 2).sum(1))


def _int_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for j in range(0, a.shape[1], EXACT):
        out += a[:, j:j + EXACT].astype(np.float32) @ b[:, j:j + EXACT].astype(np.float32).T
    return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, components added in order."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        gap = x[:, j] - y[:, j]
        total += gap * gap
    return np.sqrt(total)


def tile_nearest(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int,
                 step: int = 256) -> list[tuple[int, int, float]]:
    """(query id, row id, distance): the k nearest rows of each query in one
    tile, itself left out; equal distances go to the smaller id."""
    out: list[tuple[int, int, float]] = []
    code_c, scale_c, norm_c, err_c = _quantise(c)
    sq_c = (c * c).sum(1)
    full_c = np.sqrt(sq_c)
    for at in range(0, len(q), step):
        ids, x = qid[at:at + step], q[at:at + step]
        code, scale, norm, err = _quantise(x)
        sq = (x * x).sum(1)
        with np.errstate(over="ignore", invalid="ignore"):
            product = _int_products(code, code_c) * scale[:, None] * scale_c[None, :]
            spread = norm[:, None] * err_c[None, :] + err[:, None] * full_c[None, :]
            middle = sq[:, None] + sq_c[None, :] - 2.0 * product
            slack = 2.0 * spread + 1e-12 * (sq[:, None] + sq_c[None, :])
            own = ids[:, None] == cid[None, :]
            # Rows repeated under one id may take several of the k places: repeats are few, so the k-th
            # bound is taken over distinct ids only where ids repeat.
            most = np.where(own, np.inf, middle + slack)
            if len(np.unique(cid)) < len(cid):
                order = np.argsort(cid, kind="stable")
                edge = np.flatnonzero(np.r_[True, np.diff(cid[order]) != 0])
                most = np.minimum.reduceat(most[:, order], edge, axis=1)
            limit = np.partition(most, k - 1, axis=1)[:, k - 1] if most.shape[1] > k else np.full(len(ids), np.inf)
            left = ~(middle - slack > limit[:, None]) & ~own
            rows, cols = np.nonzero(left)
            dist = _distances(x[rows], c[cols])
        edge = np.searchsorted(rows, np.arange(len(ids) + 1))
        for i, query in enumerate(ids.tolist()):
            a, b = edge[i], edge[i + 1]
            out.extend((query, v, d) for d, v in smallest(zip(dist[a:b].tolist(), cid[cols[a:b]].tolist()), k))
    return out


def smallest(pairs, k: int) -> list[tuple[float, int]]:
    """The k least (distance, id) of distinct ids, by a bounded heap."""
    heap: list[tuple[float, int]] = []
    held: set[int] = set()
    for d, v in pairs:
        if v in held:
            # The same row met again: keep its smaller distance.
            old = next(h for h in heap if h[1] == -v)
            if -old[0] > d:
                heap[heap.index(old)] = (-d, -v)
                heapq.heapify(heap)
        elif len(heap) < k:
            heapq.heappush(heap, (-d, -v))
            held.add(v)
        elif (-d, -v) > heap[0]:
            gone = heapq.heapreplace(heap, (-d, -v))
            held.discard(-gone[1])
            held.add(v)
    return sorted((-d, -v) for d, v in heap)


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
                       vec_col: str = "embedding", query_block: int = 1024,
                       row_block: int = 8192) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for each row of ``queries``, by
    Euclidean distance: query_id, rank (from 1), vec_id, score.

    Exact: the int8 pass only discards pairs that its bounds exclude. Vectors
    (of either side) that are NULL, empty, all zero or hold a NULL, NaN or
    infinite component, and rows without an id, take no part. A query is never
    its own neighbour (rows of its id are left out); rows repeated under an id
    count once, at their least distance, and a repeated query id asks once, with
    its least vector. Vectors meet only vectors of their own length. Ties go to
    the smaller id. Fewer than ``k`` candidates give fewer rows; empty tables give
    none. Other columns are ignored.
    """
    def taken(df: DataFrame) -> DataFrame:
        return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
                .where(F.col("id").isNotNull() & _usable(F.col("v"))))

    rows = taken(vectors)
    asked = taken(queries).groupBy("id").agg(F.min("v").alias("v"))
    n_rows, n_asked = rows.count(), asked.count()
    n_rb, n_qb = max(1, -(-n_rows // row_block)), max(1, -(-n_asked // query_block))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int, asks: bool) -> DataFrame:
        # Dealt before the copies are made: all copies of a row keep its block.
        return (df.select("id", "v", F.size("v").alias("dim"), F.lit(asks).alias("asks"),
                          F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int").alias(own))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))

    tiles = dealt(asked, "qb", n_qb, "rb", n_rb, True).unionByName(dealt(rows, "rb", n_rb, "qb", n_qb, False))

    def search(table: pa.Table) -> pa.Table:
        asks = np.asarray(table.column("asks").to_numpy(zero_copy_only=False), bool)
        ids = table.column("id").to_numpy()
        vecs = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vecs = vecs.astype(float).reshape(len(ids), -1)
        found = tile_nearest(ids[asks], vecs[asks], ids[~asks], vecs[~asks], k) \
            if asks.any() and not asks.all() else []
        block = table.column("rb")[0].as_py()
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()),
                         "vec_id": pa.array([f[1] for f in found], pa.int64()),
                         "score": pa.array([f[2] for f in found], pa.float64()),
                         "part": pa.array([block] * len(found), pa.int32())})

    found = tiles.groupBy("qb", "rb", "dim").applyInArrow(
        search, "query_id long, vec_id long, score double, part int")

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        best = smallest(zip(table.column("score").to_pylist(), table.column("vec_id").to_pylist()), k)
        return pa.table({"query_id": pa.array([key[0].as_py()] * len(best), pa.int64()),
                         "vec_id": pa.array([v for _, v in best], pa.int64()),
                         "score": pa.array([d for d, _ in best], pa.float64()),
                         "part": pa.array([key[1].as_py()] * len(best), pa.int32())})

    parts = n_rb
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        found = (found.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
                 .groupBy("query_id", "part")
                 .applyInArrow(merged, "query_id long, vec_id long, score double, part int"))

    def ranked(key: tuple, table: pa.Table) -> pa.Table:
        best = smallest(zip(table.column("score").to_pylist(), table.column("vec_id").to_pylist()), k)
        return pa.table({"query_id": pa.array([key[0].as_py()] * len(best), pa.int64()),
                         "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                         "vec_id": pa.array([v for _, v in best], pa.int64()),
                         "score": pa.array([d for d, _ in best], pa.float64())})

    return found.groupBy("query_id").applyInArrow(ranked, SCHEMA)
