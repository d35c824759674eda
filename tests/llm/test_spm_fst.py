import random

import pytest
import sentencepiece

from staffline.llm import spm_fst
from staffline.llm.queries import PIECE_MODEL, QUERIES
from tests.llm import edge


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@pytest.fixture(scope="module")
def fst():
    return spm_fst.Transducer(spm_fst.load_model(PIECE_MODEL))


def test_equals_library_on_random_strings(fst, library):
    rng = random.Random(4)
    parts = ["a", "b", "e", "th", "he", " ", "  ", "     ", "\n", "\t", "é", "日", "\U0001F600", "the", "▁", ".", "1", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for text, ids in zip(texts, fst.encode_all(texts)):
        assert ids.tolist() == library.encode(text), text
        assert fst.decode(ids) == spm_fst._plain(fst, text)


def test_equals_library_on_documents(spark, library):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_pieces"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.round_trip and r.n_ids == len(r.ids) and r.ids == library.encode(texts[r.doc_id])


def shortest(model, seg):
    """Plain search over all segmentations of a unigram model."""
    best = [(0.0, [])] + [None] * len(seg)
    for j in range(1, len(seg) + 1):
        options = [(best[i][0] - model.score[model.id_of[seg[i:j]]], best[i][1] + [model.id_of[seg[i:j]]])
                   for i in range(j) if best[i] and seg[i:j] in model.id_of]
        if seg[j - 1] not in model.id_of:
            options.append((best[j - 1][0] - model.worst, best[j - 1][1] + [model.unknown]))
        best[j] = min(options, key=lambda o: o[0])
    return best[-1][1]


def test_shortest_path_of_weighted_pieces():
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.1, 1), ("ab", -2.5, 1), ("▁ab", -3.9, 1),
              ("ba", -1.7, 1), ("aba", -4.05, 1)]
    model = spm_fst.Model(pieces, kind=spm_fst.UNIGRAM, byte_fallback=False).compile()
    fst = spm_fst.Transducer(model)
    rng = random.Random(0)
    for _ in range(300):
        word = "▁" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        assert fst.encode_all([word[1:]])[0].tolist() == shortest(model, word)


def test_bounded_table(fst, monkeypatch):
    monkeypatch.setattr(spm_fst, "TABLE", 3)
    small = spm_fst.Transducer(fst.m)
    texts = ["one two three four", "two five", "five six " * 3, "x" * 500]
    assert [a.tolist() for a in small.encode_all(texts)] == [a.tolist() for a in fst.encode_all(texts)]
    assert [a.tolist() for a in small.encode_all(texts[::-1])] == [a.tolist() for a in fst.encode_all(texts[::-1])]
    assert all(len(s) <= spm_fst.KEEP_CHARS for s in small.solved)


def test_edges(spark, fst, library):
    df = edge.documents(spark)
    coded = spm_fst.encode_texts(df, fst.m)
    got = coded.collect()
    assert len(got) == len(edge.ROWS)
    by = {r.doc_id: r for r in got}
    assert by[1].ids is None and by[1].n_ids is None and by[1].round_trip is None
    assert by[2].ids == [] and by[2].round_trip
    for i, text, _ in edge.ROWS:
        if text:
            assert by[i].ids == library.encode(text) and by[i].round_trip
    back = {r.doc_id: r.text for r in spm_fst.decode_ids(coded, fst.m).collect()}
    assert back[1] is None and back[5] == edge.REPEATED and back[7] == edge.LONG
    assert spm_fst.encode_texts(edge.empty(spark), fst.m).collect() == []
