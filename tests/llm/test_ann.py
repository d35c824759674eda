import math

import numpy as np
import pytest

from staffline.llm import ann
from staffline.llm.queries import QUERIES


def brute(vectors, queries, k):
    out = []
    for qid, q in sorted(queries.items()):
        best = {}
        for vid, v in vectors:
            if vid != qid and len(v) == len(q):
                total = 0.0
                for a, b in zip(q, v):
                    total += (a - b) * (a - b)
                best[vid] = min(best.get(vid, math.inf), math.sqrt(total))
        ranked = sorted((d, v) for v, d in best.items())[:k]
        out += [(qid, i + 1, v, d) for i, (d, v) in enumerate(ranked)]
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("blocks", [(3, 7), (1024, 8192)])
def test_equals_brute_force_with_ties_and_repeats(spark, blocks):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(80)]
    data += data[:5] + [(200, [1.0, 2.0]), (201, [1.0, 2.5])]
    data = [(i, v) for i, v in data if any(v)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumnRenamed("nothing", "x")
    got = ann.nearest_neighbours(df, df.where("vec_id % 10 = 0"), k=5, query_block=blocks[0], row_block=blocks[1])
    queries = {i: v for i, v in data if i % 10 == 0}
    assert rows_of(got) == sorted(brute(data, queries, 5))


def test_merging_in_levels(spark, monkeypatch):
    monkeypatch.setattr(ann, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(df, df.where("vec_id < 4"), k=3, row_block=8)
    assert rows_of(got) == sorted(brute(data, dict(data[:4]), 3))


def test_unusable_vectors_take_no_part(spark):
    data = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, [None, 1.0]), (6, []), (None, [1.0, 0.1]), (7, [1.0, 0.5]), (8, [1e300, -1e300])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS rank")
    got = rows_of(ann.nearest_neighbours(df, df, k=3))
    assert {r[0] for r in got} == {0, 7, 8} and {r[2] for r in got} == {0, 7, 8}
    assert (0, 1, 7, 0.5) in got


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got = ann.nearest_neighbours(df, df)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(30, 33)) * 5, rng.normal(size=(40, 33))
    (cx, sx, nx, ex), (cy, sy, _, ey) = ann._quantise(x), ann._quantise(y)
    product = ann._int_products(cx, cy) * sx[:, None] * sy[None, :]
    spread = nx[:, None] * ey[None, :] + ex[:, None] * np.sqrt((y * y).sum(1))[None, :]
    assert (np.abs(x @ y.T - product) <= spread + 1e-9).all()


def test_query(spark):
    got = QUERIES["op1_nearest"](spark, "/root/testdata/sf0.001")
    assert got.count() == 50
