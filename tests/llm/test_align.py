import bisect
import functools
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from staffline.llm import align
from staffline.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, QUERIES, read_bytes, read_text
from tests.llm import edge

SPEC, MODEL = read_text(BYTE_TOKENIZER), read_bytes(PIECE_MODEL)


@pytest.fixture(scope="module")
def both():
    return align.Held(align.Tokenizers(SPEC, MODEL))


@functools.cache
def loaded():
    a = Tokenizer.from_str(SPEC)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=MODEL), align.byte_letters()


def whole(text):
    """Groups and links of a text encoded as a whole, by sets of ends and all pairs."""
    if not text:
        return [], []
    a, b, letters = loaded()
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_raw = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_raw = []
    for i in b_ids:
        p = b.id_to_piece(i)
        b_raw.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
    if not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
        return [], []

    def ends(raw):
        out, at = [], 0
        for x in raw:
            at += len(x)
            out.append(at)
        return out

    x, y = ends(a_raw), ends(b_raw)
    common = sorted(set(x) & set(y))
    groups = [([], []) for _ in common]
    for side, ids, at in ((0, a_ids, x), (1, b_ids, y)):
        for t, e in zip(ids, at):
            groups[bisect.bisect_left(common, e)][side].append(t)
    linked, j0 = [], 0
    for i, e in enumerate(x):
        s = e - len(a_raw[i])
        while j0 < len(y) and y[j0] <= s:
            j0 += 1
        j = j0
        while j < len(y) and y[j] - len(b_raw[j]) < e:
            linked.append((a_ids[i], b_ids[j]))
            j += 1
    return groups, linked


def plain(texts):
    """Rows of the query but doc_id, by brute force."""
    parts = [whole(t) for t in texts]
    count = Counter(p for _, linked in parts for p in linked)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for groups, linked in parts:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(linked),
                    sum(count[p] == most[p[1]] for p in linked), sum(count[p] for p in linked),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_division_equals_all_common_ends(seed):
    rng = random.Random(seed)
    for _ in range(200):
        a, b, cuts, at = [], [], [], 0
        for _ in range(rng.randint(1, 4)):  # texts end to end
            n = rng.randint(1, 60)
            a += sorted({at + n, *(at + rng.randint(1, n) for _ in range(rng.randint(0, 30)))})
            b += sorted({at + n, *(at + rng.randint(1, n) for _ in range(rng.randint(0, 30)))})
            cuts.append(len(a))
            at += n
        x, y = np.array(a), np.array(b)
        a_end, b_end = align.align(x, y, np.array(cuts))
        assert x[a_end - 1].tolist() == y[b_end - 1].tolist() == sorted(set(a) & set(b))
        want = {(i, j) for i in range(len(a)) for j in range(len(b))
                if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])}
        j, extra, i = align.links(x, y)
        got = [*enumerate(j.tolist()), *zip(i.tolist(), extra.tolist())]
        assert len(got) == len(want) and set(got) == want
    none = np.zeros(0, np.int64)
    assert len(align.align(none, none, none)[0]) == 0


def test_a_long_stretch_without_common_ends_is_one_group():
    n = 200_000
    a_end, b_end = align.align(np.r_[np.arange(2, 2 * n, 2), 2 * n + 1], np.r_[np.arange(1, 2 * n, 2), 2 * n + 1], np.array([n]))
    assert a_end.tolist() == [n] and b_end.tolist() == [n + 1]


def test_stretches_equal_whole_texts(both):
    rng = random.Random(7)
    parts = ["a", "The", "thentien", "é", "́", "'s", "9", "12345", "ß", "日本", "😀", "<|endoftext|>", "<s>", "<unk>", "<0x41>",
             "--", "Größe,", "don't.", "é!", "a'", "\x1c", "\x85", "　", " ", "​", "\x00", "▁", ".", "x" * 70, "﻿", "\r"]
    gaps = ["", "", " ", " ", "  ", "   ", "\n", "\t", "\n ", " \n"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 12)))
        assert align.align_text(both, text) == whole(text)[0], text


def rows_of(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    r.groups_sha256) for r in df.collect()))


def want_of(rows):
    return sorted((i is None, i or 0, *x) for (i, _), x in zip(rows, plain([t for _, t in rows])))


def test_edges(spark):
    got = rows_of(align.align_texts(edge.documents(spark), SPEC, MODEL))
    assert got == want_of([(i, t) for i, t, _ in edge.ROWS])
    mark = [r for r in got if r[1] == 9][0]
    assert mark[2:] == (0, 0, 0, 0, 0, 0, "")  # the mark of a space stands in that text itself
    assert align.align_texts(edge.empty(spark), SPEC, MODEL).collect() == []


def test_blocks_of_every_size_count_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    want = want_of([(r.doc_id, r.text) for r in docs.collect()])
    for links in (1, 5_000):
        assert rows_of(align.align_texts(docs.repartition(3), SPEC, MODEL, block_links=links)) == want


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = rows_of(QUERIES["op11_align"](spark, "/root/testdata/sf0.001"))
    assert got == want_of([(r.doc_id, r.text) for r in docs])


def test_tokens_that_do_not_give_back_their_bytes_are_told_apart():
    of = align.Bytes([b"a", b"bc", b"", b"\xc3", b"\xa9"])
    raw = [b"abc", b"a", b"acb", "é".encode(), b"bc"]  # given back, too long, as long but other bytes, given back, empty
    ids = [[0, 1], [0, 0], [0, 1], [3, 4], [2]]
    flat = np.array([i for x in ids for i in x], np.uint32)
    n, size = np.array([len(x) for x in ids]), np.array([len(x) for x in raw])
    same = of.give_back(flat, n, np.frombuffer(b"".join(raw), np.uint8), size)
    assert same.tolist() == [True, False, False, True, False]


def test_what_a_task_holds_is_numbered_anew_once_dropped(monkeypatch):
    monkeypatch.setattr(align, "STRETCHES_HELD", 5)
    held = align.Held(align.Tokenizers(SPEC, MODEL))
    long = "x" * (align.STRETCH_BYTES + 1)
    for text in ("one two three", f"two {long} four", "five six seven one", f"{long} two\x00 é one", "one two three"):
        assert align.align_text(held, text) == whole(text)[0], text
        assert long not in held and held.a.n == held.b.n >= len(held)
