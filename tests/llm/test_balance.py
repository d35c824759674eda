import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from staffline.llm import balance
from staffline.llm.queries import QUERIES, WORD_TOKENIZER, read_text
from tests.llm import edge

SPEC = read_text(WORD_TOKENIZER)


def plain(lengths, cap, lin, quad):
    """The same rule with a scan over a list of sequences."""
    out, cost, room, size = [], [], [], []
    rest = {}
    for d, n in enumerate(lengths):
        for i in range(n // cap):
            out.append((d, i * cap, cap, len(size), 0))
            size.append(cap), room.append(0), cost.append(lin * cap + quad * cap * cap)
        rest[d] = n % cap
    total, bit = sum(rest.values()), cap
    sizes = [cap] * (total // cap)
    while bit > 1:
        bit //= 2
        if total % cap & bit:
            sizes.append(bit)
    for s in sizes:
        size.append(s), room.append(s), cost.append(0.0)

    def place(d, start, n, s):
        out.append((d, start, n, s, size[s] - room[s]))
        room[s] -= n
        cost[s] += lin * n + quad * n * n

    later = []
    for d in sorted(rest, key=lambda d: -rest[d]):
        fits = [s for s in range(len(size)) if room[s] >= rest[d]]
        if rest[d] and fits:
            place(d, lengths[d] - rest[d], rest[d], min(fits, key=lambda s: (cost[s], s)))
        elif rest[d]:
            later.append(d)
    for d in later:
        while rest[d]:
            s = min((s for s in range(len(size)) if room[s]), key=lambda s: (cost[s], s))
            n = min(room[s], rest[d])
            place(d, lengths[d] - rest[d], n, s)
            rest[d] -= n
    return out, size, cost


@pytest.mark.parametrize("seed", range(8))
def test_equals_plain_rule(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 3, 5, 9, 17, 31, 32, 33, 70, 200]) for _ in range(rng.choice([0, 1, 7, 120]))]
    assert balance.balance(lengths, 32, 1.0, 0.125) == plain(lengths, 32, 1.0, 0.125)


def test_costs_are_balanced():
    """Costs lie closer together than when each document goes where it fits tightest."""
    lengths = np.random.default_rng(3).integers(20, 2000, 3000).tolist()
    pieces, size, cost = balance.balance(lengths)
    full = [c for s, c in zip(size, cost) if s == balance.CAPACITY]
    room, tight = [], []
    for n in sorted(lengths, reverse=True):
        fits = [s for s, r in enumerate(room) if r >= n]
        s = min(fits, key=lambda s: room[s]) if fits else len(room)
        if not fits:
            room.append(balance.CAPACITY), tight.append(0.0)
        room[s] -= n
        tight[s] += balance.LINEAR * n + balance.QUADRATIC * n * n
    tight = [c for c, r in zip(tight, room) if r < 40]
    assert np.std(full) < 0.7 * np.std(tight)
    assert len(pieces) <= len(lengths) + len(size)  # about one cut a sequence, which full sequences need


def check(rows, want, cap, power_of_two=True):
    """Every id once, sequences gapless, no longer than allowed, no padding."""
    seqs, got = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        got[r.doc_id, r.doc_tokens].append(r)
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at and n > 0
            at += n
        assert at == cap or (at < cap and at & (at - 1) == 0)
    used = defaultdict(int)
    for doc_id, ids in want:
        for r in got[doc_id, len(ids)]:
            part = ids[r.start:r.start + r.length]
            used[doc_id] += r.length
            assert len(part) == r.length
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert sum(used.values()) == sum(r.length for r in rows)


def test_words_equal_whole_texts():
    t = Tokenizer.from_str(SPEC)
    words = balance.Words(SPEC, 2)
    rng = random.Random(5)
    parts = ["a", "B", "é", "é", "́", "'s", "'re", "9", "ß", "İ", "日本", "😀", "<|endoftext|>", "<|startoftext|>", "--",
             "\x1c", "\x85", "　", " ", "​", "\x00", "'", ".", "x" * 90]
    gaps = ["", "", " ", "  ", "\n", "\t\r\n", "\x0b", "\f"]
    texts = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    texts += ["a,b,.c.", "don't,", "<|endoftext|>,", "a<|endoftext|>!", "x'r,e", "Größe;", "a" * 70 + "!?"]
    for text, ids in zip(texts, words.ids([x.encode() for x in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids + [2]


def test_a_word_is_tokenised_once_in_any_case_and_held_within_bounds(monkeypatch):
    t = Tokenizer.from_str(SPEC)
    words, asked = balance.Words(SPEC, 2), []
    real = words.model

    class Model:
        def tokenize(self, text):
            asked.append(text)
            return real.tokenize(text)

    words.model = Model()
    text = "Thing thing THING, thing. (thing) thing's"
    assert np.frombuffer(words.ids([text.encode()] * 3)[2], "<u4").tolist() == t.encode(text).ids + [2]
    assert asked == ["thing"]
    monkeypatch.setattr(balance, "WORDS_HELD", 5)
    words = balance.Words(SPEC, 2)
    text = " ".join(f"word{i}, a{'b' * i}." for i in range(100))
    assert np.frombuffer(words.ids([text.encode()])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids + [2]
    assert len(words) <= 5


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        balance.splits_at_space('{"added_tokens": [], "pre_tokenizer": {"type": "ByteLevel"}}')


def test_edges(spark):
    t = Tokenizer.from_str(SPEC)
    rows = balance.pack_tokens(edge.documents(spark), SPEC, 2, capacity=256).collect()
    want = {(i, text): t.encode(text or "", add_special_tokens=False).ids + [2] for i, text, _ in edge.ROWS}
    check(rows, [(i, ids) for (i, _), ids in want.items()], 256)
    assert sum(r.length for r in rows) == sum(len(t.encode(x or "", add_special_tokens=False).ids) + 1 for _, x, _ in edge.ROWS)
    assert [(r.length, r.doc_tokens, r.ids_crc32) for r in rows if r.doc_id == 1] == [(1, 1, zlib.crc32(b"\2\0\0\0"))]
    assert balance.pack_tokens(edge.empty(spark), SPEC, 2).collect() == []


def test_groups_and_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    rows = balance.pack_tokens(docs, SPEC, 2, capacity=512, group_tokens=20_000).collect()
    t = Tokenizer.from_str(SPEC)
    check(rows, [(r.doc_id, t.encode(r.text, add_special_tokens=False).ids + [2]) for r in docs.collect()], 512)
    assert {r.cost >= 0 and r.capacity for r in rows} >= {512}


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    t = Tokenizer.from_str(SPEC)
    rows = QUERIES["op13_balanced_pack"](spark, "/root/testdata/sf0.001").collect()
    want = [(r.doc_id, t.encode(r.text, add_special_tokens=False).ids + [2]) for r in docs]
    check(rows, want, 4096)
    assert {(r.doc_id, r.doc_tokens) for r in rows} == {(i, len(ids)) for i, ids in want}
