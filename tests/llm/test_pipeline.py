import re

import pytest

import corpus_pipeline
from staffline.llm import langid, pii
from tests.llm.test_dart_minhash import brute
from tests.llm.test_packing import check
from tests.llm.test_pii import base
from tests.llm import edge

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # A document without letters, and a copy of another.
    extra = spark.createDataFrame([(9001, "123 !!! 456", "en", "s", 11)], docs.schema)
    docs = docs.unionByName(extra).cache()
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return out


def test_language_stage(steps):
    before, after = ({r.doc_id: r for r in df.collect()} for df in steps[:2])
    assert steps[1].schema == steps[0].schema and 9001 not in after
    gone = set(before) - set(after)
    assert all(not re.search(r"[^\W\d_]", before[i].text or "") for i in gone)
    assert all(after[i] == before[i] for i in after)


def test_near_duplicate_stage(steps):
    before, after = ({r.doc_id: r for r in df.collect()} for df in steps[1:3])
    assert steps[2].columns == steps[0].columns
    assert set(after) == {c for _, c, _ in brute([(i, r.text) for i, r in before.items()])}
    assert all(after[i] == before[i] for i in after)


def test_personal_data_stage(steps):
    before, after = ({r.doc_id: r for r in df.collect()} for df in steps[2:4])
    assert steps[3].columns == steps[0].columns and set(before) == set(after)
    for i, r in after.items():
        assert base(r.text) == [] and r.n_chars == len(r.text)
        if not re.search("[0-9@]", before[i].text):
            assert r == before[i]


def test_packing_stage_and_run(spark, steps):
    lengths = {r.doc_id: len(r.text.split()) + 1 for r in steps[3].collect()}
    check(steps[4].collect(), lengths, corpus_pipeline.packing.CAPACITIES)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(lengths) - {9001} and corpus_pipeline.ORACLE_SQL is None


def test_stages_on_edge_cases(spark):
    docs = edge.documents(spark)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for df in (docs, edge.empty(spark)):
            out = stage(spark, df, SF)
            assert i == 3 or out.columns == df.columns
            assert (out.count() == 0) == (df.count() == 0)
    assert langid.UNKNOWN and pii.KINDS


def test_language_stage_keeps_evenly_mixed_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.where("lang is not null").collect()
    words = {lang: [w for r in rows if r.lang == lang for w in r.text.split() if w.isalpha()][:400] for lang in {r.lang for r in rows}}
    assert len(words) == 4
    text = "\n".join(" ".join(w[i:i + 40]) for i in (0, 40, 80) for w in words.values())
    extra = spark.createDataFrame([(9002, text, "en", "s", len(text))], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(extra), SF)
    assert kept.where("doc_id = 9002").count() == 1
