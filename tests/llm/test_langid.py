import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffline.llm import langid
from staffline.llm.queries import QUERIES
from tests.llm import edge

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    parts = {"aa": ["ka", "ko", "kake", "tak"], "bb": ["ru", "ris", "rosir", "sur"], "cc": ["mel", "lem", "elle", "mam"]}
    return langid.train([(lang, " ".join("".join(rng.choices(p, k=2)) for _ in range(80)))
                         for lang, p in parts.items() for _ in range(20)])


def test_forward_backward_equals_plain_sums():
    rng = np.random.default_rng(0)
    emit, trans = rng.normal(size=(400, 3)), rng.normal(size=(3, 3))
    row = np.sort(np.r_[np.zeros(250, int), rng.integers(2, 6, 150)])
    got = langid.posteriors(emit, trans, row, 7)
    for r in range(7):
        e, a = np.exp(emit[row == r]), np.exp(trans)
        if not len(e):
            continue
        alpha, s = [], np.ones(3) / 3
        for x in e:
            s = (s @ a) * x
            s /= s.sum()
            alpha.append(s)
        beta, want = np.ones(3), []
        for t in range(len(e) - 1, -1, -1):
            p = alpha[t] * beta
            want.append(p / p.sum())
            beta = a @ (e[t] * beta)
            beta /= beta.sum()
        assert np.allclose(got[row == r], want[::-1], atol=1e-9)


def test_code_switched_text_is_labelled_word_by_word(model):
    words = langid.find_words(["kakako takko kaka koko rosirru risris sursur ruris"])
    post = langid.posteriors(langid.emissions(model, langid.features(words)), model.transition, words.row, 1)
    assert post.argmax(1).tolist() == [0, 0, 0, 0, 1, 1, 1, 1]


def test_edges(spark, model):
    df = edge.documents(spark).drop("score")
    got = langid.identify(df.select("doc_id", "row", "text"), model).collect()
    assert len(got) == len(edge.ROWS)
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3, 4):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert all(0.0 <= r.score <= 1.0 for r in got) and by[7].lang_pred in model.langs
    assert langid.identify(edge.empty(spark).select("doc_id", "text"), model).collect() == []
    nothing = langid.train([])
    assert {r.lang_pred for r in langid.identify(df.select("doc_id", "text"), nothing).collect()} == {"und"}
    assert langid.classify(langid.train([("aa", "ka ko")]), ["ka", "1"]) == (["aa", "und"], [1.0, 0.0])


def test_columns_named_like_the_outputs_are_replaced(spark, model):
    df = edge.documents(spark).withColumns({"lang_pred": F.lit(1), "score": F.lit("old")})
    got = langid.identify(df.select("score", "doc_id", "text", "lang_pred", "row"), model)
    assert got.columns == ["doc_id", "row", "lang_pred", "score"] and dict(got.dtypes)["score"] == "double"
    plain = langid.identify(df.select("doc_id", "row", "text"), model)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_training_sample_ignores_null_languages(spark):
    got = langid.training_sample(edge.documents(spark))
    assert {lang for lang, _ in got} == {"en", "fr"} and len(got) == len(set(got))
    assert langid.training_sample(edge.empty(spark)) == []


def test_keep_identified(spark, model):
    df = edge.documents(spark)
    kept = langid.keep_identified(df, model, 0.34)
    assert kept.schema == df.schema
    assert {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3, 4})


def test_held_out_accuracy(spark):
    got = QUERIES["op2_langid"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert all(got.held_out[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in docs.index)
    held = got[got.held_out]
    assert (held.lang_pred == docs.lang[held.index]).mean() > 0.98


def test_evenly_mixed_text_stays_and_unsure_text_goes(spark, model):
    mixed = " ".join(["kakako takko kaka koko kake tako", "rosirru risris sursur ruris suru riru",
                      "melelle lemmel mammam ellemel memmam lemlem"])
    rows = [(1, mixed, None), (2, "kakako takko kaka", None), (3, "yd", None)]
    _, score, sure = langid.judge(model, [t for _, t, _ in rows])
    assert score[0] < 0.4 and sure[0] > 0.9 and sure[2] < 0.7
    kept = langid.keep_identified(edge.documents(spark, rows), model, 0.6)
    assert {r.doc_id for r in kept.collect()} == {1, 2}
