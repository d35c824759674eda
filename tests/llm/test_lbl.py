import collections
import math
import re
import zlib

import numpy as np
import pytest

from staffline.llm import lbl
from staffline.llm.queries import QUERIES
from tests.llm import edge

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def check_base(rows, docs, train):
    counts, ends = collections.Counter(), len(train)
    for t in train:
        counts.update(words(t))
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    for r in rows:
        ws = words(docs[r.doc_id])
        each = math.log10(n + v + 1)
        want = sum(math.log10(counts[w] + 1) - each for w in ws) + math.log10(ends + 1) - each
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert (r.n_tokens, r.train_tokens) == (len(ws) + 1, n)
        assert r.n_known == sum(counts[w] > 0 for w in ws) + (ends > 0)


@pytest.mark.parametrize("direct", [5, 1 << 17])
def test_base_and_model(spark, monkeypatch, direct):
    monkeypatch.setattr(lbl, "DIRECT", max(direct, lbl.HEAD + 5))
    got = QUERIES["op4_lm_scores"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 7 == 2}
    assert {r.doc_id for r in got if r.held_out} == held and len(got) == len(docs)
    check_base(got, docs, [t for i, t in docs.items() if i not in held])
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_class_probabilities_are_normalised():
    rng = np.random.default_rng(0)
    params = (rng.normal(size=(256, lbl.DIM)), rng.normal(size=(256, lbl.DIM)), rng.normal(size=(256, lbl.DIM)),
              rng.normal(size=256))
    p = 10 ** lbl.class_log10(params, np.arange(256), np.full(256, 7), np.full(256, 9), step=3)
    assert p.sum() == pytest.approx(1.0)


def test_training_beats_frequencies():
    rng = np.random.default_rng(0)
    ctx = rng.integers(0, 4, 4000)
    cls = (ctx + (rng.random(4000) < 0.1)) % 5
    pairs, n = np.unique(ctx * 256 + cls, return_counts=True)
    freq = np.bincount(cls, minlength=256) + 1.0
    noise = freq / freq.sum()
    p = lbl.train_shard(lbl.start_params(noise), noise, pairs // 256, pairs % 256, n, seed=1, epochs=60, batch=4)
    score = (lbl.class_log10(p, cls, ctx % 256, ctx // 256)).mean()
    assert score > np.log10(noise[cls]).mean() + 0.2


def test_triples_equal_brute_force(spark):
    docs = edge.documents(spark).selectExpr("coalesce(text, '') AS text")
    v = lbl.vocabulary(lbl.count_words(docs), docs.count())
    got = {(r.ctx, r.cls): r.n for r in lbl.count_triples(docs, v).collect()}
    want = collections.Counter()
    head = {w: h for w, h in zip(v.hash.tolist(), v.head.tolist()) if h}
    for _, text, _ in edge.ROWS:
        ids = []
        for w in words(text):
            h = int(lbl._span_hash([w])[0])
            tail = int(lbl._tokens(lbl.pa.array([w]))[5][0])
            ids.append(head.get(h, tail))
        ids.append(0)
        for i, c in enumerate(ids):
            one, two = (ids[i - 1] if i else 0), (ids[i - 2] if i > 1 else 0)
            want[two * 256 + one, c] += 1
    assert got == want


def test_edges(spark):
    df = edge.documents(spark)
    got = lbl.score_documents(df, df.where("doc_id <> 9"), keep=("rank",)).collect()
    assert len(got) == len(edge.ROWS) and all(r.rank == "clash" and r.score <= 0 for r in got)
    train = [t for i, t, _ in edge.ROWS if i is not None and i != 9]
    docs = {i: t for i, t, _ in edge.ROWS}
    check_base(got, docs, train)
    assert lbl.score_documents(edge.empty(spark), df).collect() == []
    untrained = lbl.score_documents(df, edge.empty(spark)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in untrained)
