import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from staffline.llm import dart_minhash as dm
from staffline.llm.queries import QUERIES
from tests.llm import edge


def grams(text):
    ws = (text or "").split()
    ws = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in ws]
    if not ws:
        return collections.Counter()
    return collections.Counter(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4)))


def brute(rows):
    """Class of each row: least id of the connected component of weighted Jaccard >= 0.8."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            where[g].add(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in where[g] if j > i}:
            common = sum((s & sets[j]).values())
            if common / (sum(s.values()) + sum(sets[j].values()) - common) >= 0.8:
                parent[find(j)] = find(i)
    least = collections.defaultdict(list)
    for i, (no, _) in enumerate(rows):
        least[find(i)].append(no)
    return sorted((no, min(least[find(i)]), len(least[find(i)])) for i, (no, _) in enumerate(rows))


def test_signature_estimates_weighted_jaccard():
    rng = random.Random(0)
    gaps = []
    for t in range(30):
        a = [f"w{rng.randrange(300)}" for _ in range(300)]
        b = list(a)
        for _ in range(t):
            b[rng.randrange(300)] = "z"
        if t % 3 == 0:
            a, b = a * 3, b * 4
        row, item, weight, _ = dm.shingles(pa.array([" ".join(a), " ".join(b)]))
        sig = dm.signatures(row, item, weight, 2)
        x, y = (np.sort(np.repeat(item[row == r], weight[row == r])) for r in (0, 1))
        gaps.append((sig[0] == sig[1]).mean() - dm.weighted_jaccard(x, y))
    assert abs(np.mean(gaps)) < 0.02 and np.max(np.abs(gaps)) < 0.2


def test_exact_weighted_jaccard():
    a, b = np.array([1, 1, 1, 2, 5], np.uint32), np.array([1, 1, 2, 2, 9], np.uint32)
    assert dm.weighted_jaccard(a, b) == 3 / 7 and dm.weighted_jaccard(a, a) == 1.0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_classes_equal_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    got = QUERIES["op6_near_dups"](spark, f"/root/testdata/{sf}").collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == brute(docs)


def test_chains_and_large_groups(spark):
    rng = random.Random(3)
    rows, base = [], [f"w{i}" for i in range(200)]
    for i in range(120):  # a drifting chain: neighbours alike, ends not
        base = list(base)
        base[rng.randrange(200)] = f"c{i}"
        rows.append((1000 - i, " ".join(base)))
    rows += [(2000 + i, " ".join([*(f"v{j}" for j in range(100)), f"tail{i}"])) for i in range(150)]
    rows += [(3000 + i, " ".join(f"u{i}_{j}" for j in range(30))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.class_size) for r in dm.near_duplicates(df).collect())
    assert got == brute(rows)
    kept = dm.one_of_each(df).collect()
    assert {r.doc_id for r in kept} == {c for _, c, _ in got} and len(kept) == len({c for _, c, _ in got})


def test_edges(spark):
    df = edge.documents(spark)
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in dm.near_duplicates(df).collect()), key=str)
    want = [(None, None, 1), *((i, i, 1) for i in (1, 2, 3, 4, 7, 8, 9, 10)), (5, 5, 3), (5, 5, 3), (6, 5, 3)]
    assert got == sorted(want, key=str)
    kept = dm.one_of_each(df)
    assert kept.schema == df.schema
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(
        ["None", "1", "2", "3", "4", "5", "7", "8", "9", "10"])
    assert dm.near_duplicates(edge.empty(spark)).collect() == [] and dm.one_of_each(edge.empty(spark)).collect() == []


def test_same_id_with_different_texts_keeps_both(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (1, "one two three four five six seven"), (1, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dm.one_of_each(df).count() == 3
