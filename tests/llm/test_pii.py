import hashlib
import itertools
import pathlib
import random
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffline.llm import pii
from staffline.llm.common import least_hashes
from staffline.llm.queries import QUERIES
from tests.llm import edge

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(0)
    texts = []
    for i in range(150):
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        texts.append(rng.choice([
            f"write to user{i}@mail{i % 9}.example.com please", f"the host 10.{i}.3.{i % 200} is down",
            f"paid with {card} today", f"call +1 (415) 555-{rng.randrange(1000, 9999)} now",
            f"version {i}.{i % 7} of {1990 + i % 30} has {i * 37} lines", f"section {i} page {i * 3}, 20{i % 90:02d}-01-02"]))
    return pii.train(texts)


def test_base_equals_plain_patterns():
    rng = random.Random(5)
    parts = ["a", "b.c", "@", ".", "1", "25", "255", "300", "+", "-", " ", "(", ")", "4111111111111111", "é", "\n", "com", "_"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 18)))
        assert pii.base_spans(text) == base(text), text
    assert pii.base_spans("9" * 50_000 + "a" * 50_000 + "@" + "x" * 1000) == []


def test_marginals_and_best_equal_enumeration():
    rng = np.random.default_rng(0)
    n = 5
    cands = [(i, j, None) for i, j in itertools.combinations(range(n + 1), 2) if j - i <= 3]
    scores = rng.normal(size=(len(cands), len(pii.KINDS)))

    def ways(at):
        if at == n:
            yield []
            return
        for rest in ways(at + 1):
            yield rest
        for c, (i, j, _) in enumerate(cands):
            if i == at:
                for y in range(len(pii.KINDS)):
                    for rest in ways(j):
                        yield [(c, y), *rest]

    every = [(sum(scores[c, y] for c, y in w), w) for w in ways(0)]
    total = np.logaddexp.reduce([s for s, _ in every])
    log_z, marginal = pii._expected(n, cands, scores)
    assert log_z == pytest.approx(total)
    want = np.zeros_like(scores)
    for s, w in every:
        for c, y in w:
            want[c, y] += np.exp(s - total)
    assert np.allclose(marginal, want)
    assert pii._best(n, cands, scores, 0.0) == max(every, key=lambda e: e[0])[1]


def test_model_adds_what_patterns_miss(weights):
    for text, kind, value in (("please call 415-555-0123 now", "phone", "415-555-0123"),
                              ("the number (030) 123-4567 is new", "phone", "(030) 123-4567")):
        _, spans = pii._all_spans(text, weights)
        assert [(pii.KINDS[k], text[a:b]) for a, k, b in spans] == [(kind, value)]
    for text in ("version 2.0 of 1999 has 120 lines", "no digits at all", "page 12, section 4", "Apache License, Version 2.0."):
        assert pii._all_spans(text, weights)[1] == []


def test_base_spans_stay(weights):
    text = "mail a@b.co or 1.2.3.4, +1 415 555 0123 and 4111-1111-1111-1111"
    b, spans = pii._all_spans(text, weights)
    assert b == base(text) and set(b) <= set(spans)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op10_pii"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        b = base(docs[r.doc_id])
        written = pii._written(b)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in b) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) - {""} <= set(r.spans.split(","))


def test_edges(spark, weights):
    df = edge.documents(spark)
    got = pii.find_pii(df, weights).collect()
    assert len(got) == len(edge.ROWS)
    none = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == none and r.spans == "" for r in got)
    assert pii.find_pii(edge.empty(spark), weights).collect() == []
    assert not pii.train(["nothing here", ""]).any() and not pii.train([]).any()
    assert pii.training_texts(edge.empty(spark)) == []


def test_redaction(spark, weights):
    rows = [*edge.ROWS, (20, "mail a@b.co, ip 1.2.3.4, again a@b.co", "en")]
    df = edge.documents(spark, rows)
    new = pii.redact_texts(df, weights)
    assert new.schema == df.schema
    by = {r.doc_id: r.text for r in new.collect()}
    assert by[20] == "mail [EMAIL], ip [IP], again [EMAIL]"
    assert all(by[i] == t for i, t, _ in edge.ROWS)


def test_spelled_out_addresses_without_digits_or_signs(spark, weights):
    far = "plain words go on here " * 9
    rows = [(1, f"{far}please write to jane at mailhost dot com about it {far}", "en"),
            (2, "Contact John dot Smith AT mail DOT example dot org", "en"),
            (3, "we met at noon and left at night, the dot on the wall at the door", "en"),
            (4, f"{far}page 7 {far}ask bob at corp dot net", "en")]
    df = edge.documents(spark, rows)
    text = {i: t for i, t, _ in rows}
    want = {1: "jane at mailhost dot com", 2: "John dot Smith AT mail DOT example dot org", 4: "bob at corp dot net"}
    for r in pii.find_pii(df, weights).collect():
        at = text[r.doc_id].find(want[r.doc_id]) if r.doc_id in want else 0
        assert r.spans == (f"email:{at}:{at + len(want[r.doc_id])}" if r.doc_id in want else "")
        assert r.n_email == 0
    for r in pii.redact_texts(df, weights).collect():
        assert r.text == (text[r.doc_id].replace(want[r.doc_id], "[EMAIL]") if r.doc_id in want else text[r.doc_id])


def test_sample_takes_distinct_texts(spark):
    texts = [f"call +1 415 555 {i:04d}" for i in range(12)]
    once = pii.training_texts(edge.documents(spark, [(i, t, "en") for i, t in enumerate(texts)]), limit=12)
    # The text of the least hash stands there very often.
    rows = [(i, t, "en") for i, t in enumerate([*texts, *[once[0]] * 200])]
    assert pii.training_texts(edge.documents(spark, rows), limit=12) == once and sorted(once) == texts
    assert pii.training_texts(edge.documents(spark, rows), limit=5) == once[:5]


def _whole_window(text, weights):
    """The field's spans with every window decoded in one piece."""
    out = []
    for lo, hi in pii._windows(text):
        tokens, cands = pii._candidates(text, lo, hi)
        if cands:
            scores = np.array([c[2] for c in cands]) @ weights
            out += [(tokens[cands[c][0]][0], y, tokens[cands[c][1] - 1][1])
                    for c, y in pii._best(len(tokens), cands, scores, pii.MARGIN)]
    return out


def test_pieces_decode_as_whole_windows(weights, monkeypatch):
    docs = [f"{i}, 415-555-{1000 + i}, (030) 123-4567, ann at host dot com, 7.{i}, +1 415 555 {i:04d}\n" for i in range(40)]
    texts = ["".join(docs), " ".join(docs).replace("\n", ";"), "1,2 " * 900, "415-555-0123, " * 200]
    for chunk in (1, 3, 50, 512):
        monkeypatch.setattr(pii, "CHUNK", chunk)
        for text in texts:
            assert pii.model_spans(text, weights, []) == _whole_window(text, weights)


def test_memory_does_not_grow_with_a_table_of_numbers(tmp_path, weights):
    # One million code points of numbers, in a process of its own: what decoding adds to its peak, in MB.
    np.save(tmp_path / "w.npy", weights)
    code = ("import resource, sys, numpy as np\nfrom staffline.llm import pii\nw = np.load(sys.argv[1])\n"
            "text = ''.join(f'{i * 7919 % 99991},' for i in range(170_000))\npii._all_spans(text[:2000], w)\n"
            "peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024\nbefore = peak()\n"
            "pii.redact(text, w)\nprint(len(text), peak() - before)")
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "w.npy")], capture_output=True, text=True, check=True,
                          cwd=pathlib.Path(__file__).parents[2])
    size, added = map(int, done.stdout.split())
    assert size > 900_000 and added < 60


def test_sample_is_thinned_before_it_is_collected(spark):
    rows = spark.range(200_000, numPartitions=50).select(F.lit("a").alias("of"), F.xxhash64("id").alias("h"))
    few = spark.range(3).select(F.lit("b").alias("of"), F.xxhash64("id").alias("h"))
    got = least_hashes(rows.unionByName(few), 300)
    every = sorted(r.h for r in rows.collect())
    assert [h for of, h in got if of == "a"] == every[:300]
    assert [h for of, h in got if of == "b"] == sorted(r.h for r in few.collect())
