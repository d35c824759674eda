import random

import pytest

from staffline.llm import packing
from staffline.llm.queries import QUERIES
from tests.llm import edge


def plain_best_fit(lengths, caps, overhead, opened):
    """The same rule with a scan over all bins."""
    bins, out, rest = [], [], sum(lengths)
    for n in lengths:
        fits = [(size - used, -last, i) for i, (size, used, last) in enumerate(bins) if size - used >= n]
        if fits:
            gap = min(f[0] for f in fits)
            i = max((bins[f[2]][2], f[2]) for f in fits if f[0] == gap)[1]
        else:
            least = min(c for c in caps if c >= n)
            size = min((c for c in caps if c == least or (c in opened and c >= n)),
                       key=lambda c: ((c + overhead) / min(c, rest), c))
            bins.append([size, 0, 0])
            i = len(bins) - 1
        out.append((i, bins[i][1]))
        bins[i][1] += n
        bins[i][2] = len(out)
        rest -= n
    return out, [min(c for c in caps if c >= used) for _, used, _ in bins]


@pytest.mark.parametrize("seed", range(6))
def test_equals_plain_best_fit(seed):
    rng = random.Random(seed)
    caps = (8, 16, 32)
    lengths = sorted((rng.randint(1, 32) for _ in range(300)), reverse=True)
    for j in range(3):
        at, offset, size = packing.pack(lengths, caps, 2, caps[:j + 1])
        want, want_size = plain_best_fit(lengths, caps, 2, caps[:j + 1])
        assert list(zip(at, offset)) == want and size == want_size
    best = packing.pack_jointly(lengths, caps, 2)
    costs = [sum(p[2]) + 2 * len(p[2]) for p in (packing.pack(lengths, caps, 2, caps[:j + 1]) for j in range(3))]
    assert sum(best[2]) + 2 * len(best[2]) == min(costs)


def check(rows, lengths, caps):
    """Every token once, no overlap, no overfull sequence, no sequence too long for its contents."""
    bins, seen = {}, {}
    for r in rows:
        if r.length:
            bins.setdefault(r.bin_id, []).append(r)
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert {r.capacity for r in members} == {min(c for c in caps if c >= at)}
    for i, n in lengths.items():
        at = 0
        for start, size in sorted(seen[i]):
            assert start == at
            at += size
        assert at == n


def test_places_every_token_once(spark):
    rng = random.Random(1)
    lengths = {i: rng.choice([0, 1, 5, 40, 100, 257]) for i in range(400)}
    df = spark.createDataFrame(list(lengths.items()), "doc_id long, length long")
    got = packing.best_fit_pack(df, capacities=(16, 64, 100), overhead=3, group_pieces=100).collect()
    check(got, lengths, (16, 64, 100))


def test_edges(spark):
    df = edge.documents(spark).drop("length").withColumn("length", packing.token_length())
    got = packing.best_fit_pack(df).collect()
    assert len([r for r in got if r.doc_id == 7]) == 15
    null = [r for r in got if r.doc_id == 1]
    assert [(r.length, r.bin_id) for r in null] == [(0, None)]
    assert sum(r.length for r in got) == sum(len((t or "").split()) + 1 for _, t, _ in edge.ROWS if t is not None)
    assert packing.best_fit_pack(edge.empty(spark).drop("length").withColumn("length", packing.token_length())).collect() == []


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = QUERIES["op3_pack"](spark, "/root/testdata/sf0.001").collect()
    check(got, {r.doc_id: len(r.text.split()) + 1 for r in docs}, packing.CAPACITIES)
