import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from staffline.llm import wordpiece
from staffline.llm.queries import PIECE_MODEL, QUERIES
from tests.llm import edge


def library(pieces):
    vocab = {"[UNK]": 0}
    for p in pieces:
        vocab.setdefault(p, len(vocab))
    t = Tokenizer(models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=wordpiece.MAX_CHARS))
    t.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return t


@pytest.fixture(scope="module")
def pieces():
    return wordpiece.read_pieces(PIECE_MODEL)


def test_small_vocabularies_equal_greedy_matching():
    rng = random.Random(0)
    for _ in range(40):
        vocab = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(12)}
        vocab |= {"##" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(12)}
        a, t = wordpiece.compile_pieces(sorted(vocab)), library(sorted(vocab))
        texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(5)) for _ in range(20)]
        words, counts = wordpiece.count_texts(a, texts)
        assert counts.tolist() == [len(e.ids) for e in t.encode_batch(texts)] and set(words) == {5}


def test_documents_equal_library(spark, pieces):
    sf = "/root/testdata/sf0.01"
    t = library(pieces)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op8_token_counts"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.n_tokens == len(t.encode(texts[r.doc_id]).ids) and r.n_words == len(texts[r.doc_id].split())


def test_edges(spark, pieces):
    a, t = wordpiece.compile_pieces(pieces), library(pieces)
    got = wordpiece.count_tokens(edge.documents(spark), a).collect()
    assert len(got) == len(edge.ROWS)
    by = {r.doc_id: (r.n_words, r.n_tokens) for r in got}
    for i, text, _ in edge.ROWS:
        assert by[i] == (len((text or "").split()), len(t.encode(text or "").ids))
    assert by[1] == by[2] == by[3] == (0, 0) and by[8] == (1, 1)
    assert wordpiece.count_tokens(edge.empty(spark), a).collect() == []
    assert wordpiece.count_texts(wordpiece.compile_pieces([]), ["a b", ""])[1].tolist() == [2, 0]


def greedy(pieces, word):
    """Longest match first over the whole word; 1 if some letter is in no piece."""
    start, inner = ({p for p in pieces if not p.startswith("##")}, {p[2:] for p in pieces if p.startswith("##")})
    most = max(map(len, start | inner))
    at = n = 0
    while at < len(word):
        held = inner if at else start
        size = next((k for k in range(min(most, len(word) - at), 0, -1) if word[at:at + k] in held), 0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


def test_words_of_any_length_in_the_query(spark, pieces, tmp_path):
    rng = random.Random(4)
    letters = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz/") for _ in range(n)) for n in (90, 101, 256, 257, 5000)]
    texts = [*letters, "的" * 3000, " ".join(letters), "a" * 400 + "\U0010fffd"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in QUERIES["op8_token_counts"](spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        assert got[i] == (len(text.split()), sum(greedy(pieces, w) for w in text.split()))
    assert got[4][1] > 1000 and got[7] == (1, 1)
    limited = wordpiece.count_texts(wordpiece.compile_pieces(pieces, max_chars=100), texts)[1].tolist()
    assert limited[1:6] == [1] * 5 and limited[0] == got[0][1]


def test_long_and_short_words_are_counted_alike(monkeypatch):
    rng = random.Random(1)
    for _ in range(30):
        vocab = sorted({rng.choice(["", "##"]) + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(25)})
        a = wordpiece.compile_pieces(vocab, max_chars=None)
        texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(40)]
        want = [greedy(vocab, t) for t in texts]
        for limit in (0, 20, 256):
            monkeypatch.setattr(wordpiece, "LONG", limit)
            assert wordpiece.count_texts(a, texts)[1].tolist() == want
