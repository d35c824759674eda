import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from staffline.llm import collocations
from staffline.llm.queries import QUERIES
from tests.llm import edge


def plain(rows, min_count, top, longest=5):
    """The definition, with dictionaries over all phrases."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        drop = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if a >= cand[p[i:i + k]]:
                        drop.add(p[i:i + k])
        rows = []
        for p, a in cand.items():
            if p not in drop:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_tiles_and_coordinates_count_alike(seed, monkeypatch):
    monkeypatch.setattr(collocations, "TILE", 2)
    rng = np.random.default_rng(seed)
    a, b = (np.minimum(rng.geometric(0.2, 500) - 1, 30) for _ in range(2))
    code, n = collocations.count_pairs(a, b)
    assert dict(zip(code.tolist(), n.tolist())) == Counter((a << 32 | b).tolist())
    none = np.zeros(0, np.int64)
    assert len(collocations.count_pairs(none, none)[0]) == 0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = ["a", "B", "c", "Éa", "d\x1ce", "xy", "the"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", "\n", ",", " ; "]
    return [("".join(rng.choice(words[:rng.randint(1, 7)]) + rng.choice(gaps) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "en", "fr", None])) for _ in range(150)]


@pytest.mark.parametrize("ranked", [1 << 18, 5, 0])
def test_equals_plain_counts(spark, texts, ranked):
    """Also where few or no words and phrases have ids."""
    df = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    assert got(collocations.mine(df, min_count=6, top=40, ranked=ranked)) == plain(texts, 6, 40)


@pytest.mark.parametrize("longer", [12, 5, 0])
def test_phrases_without_an_id_go_by_the_ids_of_their_words(spark, texts, longer, monkeypatch):
    """None is taken up as text where all frequent words have ids."""
    def never(*_):
        raise AssertionError("a phrase was taken up as text")

    monkeypatch.setattr(collocations, "_passes", never)
    df = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    assert got(collocations.mine(df, min_count=6, top=40, longer=longer)) == plain(texts, 6, 40)


@pytest.mark.parametrize("size", [2, 3, 5])
def test_rows_of_word_ids_are_counted(size):
    grams = np.random.default_rng(size).integers(0, 3, (400, size), np.int32)
    rows, n = collocations.count_grams(grams)
    assert dict(zip(map(tuple, rows.tolist()), n.tolist())) == Counter(map(tuple, grams.tolist()))


def test_edges(spark):
    rows = [(t, lang) for _, t, lang in edge.ROWS]
    df = edge.documents(spark)
    assert got(collocations.mine(df, min_count=2, top=50)) == plain(rows, 2, 50)
    assert collocations.mine(edge.empty(spark)).collect() == []


def test_counts_past_64_bits(spark):
    big = 10 ** 14
    schema = "lang string, phrase string, n long"
    words = spark.createDataFrame([("en", "a", 3 * big), ("en", "b", 2 * big)], schema)
    pairs = spark.createDataFrame([("en", "a b", big)], schema)
    total = spark.createDataFrame([("en", 10 ** 17)], "lang string, total long")
    row = collocations.score_phrases([words, pairs], total, 5).first()
    assert row.score == 1000 * big * 10 ** 17 // (6 * big * big)


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert got(QUERIES["op12_collocations"](spark, "/root/testdata/sf0.001")) == plain([(r.text, r.lang) for r in docs], 100, 2000)
