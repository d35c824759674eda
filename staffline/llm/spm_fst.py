"""SentencePiece encoding and decoding as weighted finite-state transduction.

A model file is compiled into three transducers: the normaliser (word mark for
space, one in front of the text), the piece lexicon (a path of characters for each piece, weight
minus its score) and byte fallback (a path of byte pieces for a character that no
piece spells). A text is composed with them left to right: a state is a
position and the piece that ended there. For a model of merges (BPE), the
composition is also filtered by an acceptor of neighbouring pieces: two pieces
may follow each other only if merging their characters gives these two again,
which admits exactly the segmentation that the merges make. The
tropical shortest path through what is left is the encoding. Segments between
word marks are independent, so each is solved once and kept in a bounded table.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import Table, text_slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Entries of a worker's tables of solved segments and of neighbour checks; full tables are emptied.
TABLE = 500_000
#: Segments longer than this are solved but not kept.
KEEP_CHARS = 64

_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int = BPE
    dummy_prefix: bool = True
    squeeze: bool = False
    byte_fallback: bool = True
    id_of: dict[str, int] = field(default_factory=dict)
    score: list[float] = field(default_factory=list)
    bytes_of: list[int] = field(default_factory=list)
    unknown: int = 0
    longest: int = 1
    #: Weight of a character that no piece spells.
    worst: float = 0.0

    def compile(self) -> "Model":
        self.id_of = {p: i for i, (p, _, k) in enumerate(self.pieces) if k in (NORMAL, USER)}
        self.score = [s for _, s, _ in self.pieces]
        at = {p: i for i, (p, _, k) in enumerate(self.pieces) if k == BYTE}
        self.bytes_of = [at.get(f"<0x{b:02X}>", -1) for b in range(256)]
        self.unknown = next((i for i, (_, _, k) in enumerate(self.pieces) if k == UNKNOWN), 0)
        self.longest = max(map(len, self.id_of), default=1)
        self.worst = min(self.score, default=0.0) - 10.0
        return self


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at:at + size]
            at += size


def load_model(path: str) -> Model:
    """Read a model file (pieces, scores, kinds, and the settings of trainer
    and normaliser). Only identity normalisation is compiled; a model with a
    character map is refused."""
    with open(path, "rb") as f:
        data = f.read()
    model = Model([])
    for no, value in _fields(data):
        if no == 1:
            d = dict(_fields(value))
            model.pieces.append((d[1].decode(), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, NORMAL)))
        elif no == 2:
            d = dict(_fields(value))
            model.kind, model.byte_fallback = d.get(3, UNIGRAM), bool(d.get(35, 0))
        elif no == 3:
            d = dict(_fields(value))
            if d.get(2):
                raise ValueError("models with a character map are not supported")
            model.dummy_prefix, model.squeeze = bool(d.get(3, 1)), bool(d.get(4, 1))
    return model.compile()


class Transducer:
    """The compiled model with its tables, as a worker holds it."""

    def __init__(self, model: Model):
        self.m = model
        self.solved: dict[str, bytes] = {}
        self.pairs = Table()
        self._compile_lexicon()
        self.blob, self.piece_at, self.piece_len = self._output_side()

    def _compile_lexicon(self) -> None:
        """The lexicon as a trie, and the merges of symbols (pieces, and
        characters that are no piece by themselves)."""
        m = self.m
        trie: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        symbol = dict(m.id_of)
        for piece, no in m.id_of.items():
            at = 0
            for ch in piece:
                at = trie.setdefault((at, ord(ch)), len(trie) + 1)
                symbol.setdefault(ch, len(m.pieces) + len(symbol))
            ends[at] = no
        self.edges = Table(np.array([u << 21 | c for u, c in trie], np.int64), np.array(list(trie.values()), np.int32))
        self.node_id = np.full(len(trie) + 1, -1, np.int64)
        self.node_id[list(ends)] = list(ends.values())
        self.scores = np.array(m.score)
        merges = {symbol[p[:i]] << 20 | symbol[p[i:]]: no for p, no in m.id_of.items() for i in range(1, len(p))
                  if p[:i] in symbol and p[i:] in symbol}
        self.merges = Table(np.array(list(merges), np.int64), np.array(list(merges.values()), np.int32))
        chars = [[symbol[ch] for ch in p] if i == m.id_of.get(p) else [] for i, (p, _, _) in enumerate(m.pieces)]
        self.symbols_len = np.array([len(c) for c in chars], np.int64)
        self.symbols_at = np.cumsum(self.symbols_len) - self.symbols_len
        self.symbols = np.array([s for c in chars for s in c], np.int64)

    # normaliser
    def normalise(self, text: str) -> str:
        if self.m.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = text.replace(" ", MARK)
        return MARK + text if self.m.dummy_prefix else text

    # acceptor of neighbouring pieces
    def follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether a piece may follow another: merging their characters (the
        pair of best score first, the leftmost of equals) gives these two again.
        Answers are kept; new pairs are merged together."""
        key = left.astype(np.int64) << 20 | right
        got = self.pairs.get(key)
        if (got < 0).any():
            new = np.unique(key[got < 0])
            if self.pairs.held > 2 * TABLE:
                self.pairs = Table()
                new = np.unique(key)
            self.pairs.put(new, self._merged(new >> 20, new & 0xFFFFF).astype(np.int32))
            got = self.pairs.get(key)
        return got == 1

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the characters of two pieces gives these two again."""
        out = np.zeros(len(left), bool)
        size = self.symbols_len[left] + self.symbols_len[right]
        for n in np.unique(size).tolist():
            rows = np.flatnonzero(size == n)
            a, b = left[rows], right[rows]
            sym = np.full((len(rows), n), -1, np.int64)
            for part, at in ((a, np.zeros(len(a), np.int64)), (b, self.symbols_len[a])):
                for j in range(int(self.symbols_len[part].max())):
                    on = np.flatnonzero(self.symbols_len[part] > j)
                    sym[on, at[on] + j] = self.symbols[self.symbols_at[part[on]] + j]
            live = np.arange(len(rows))
            while len(live) and sym.shape[1] > 1:
                s = sym[live]
                made = self.merges.get((np.maximum(s[:, :-1], 0) << 20 | np.maximum(s[:, 1:], 0)).ravel())
                made = np.where((s[:, 1:] < 0).ravel(), -1, made).reshape(s.shape[0], -1)
                value = np.where(made >= 0, self.scores[np.maximum(made, 0)], -np.inf)
                where = value.argmax(1)
                on = np.flatnonzero(value[np.arange(len(s)), where] > -np.inf)
                s, i, rows_on = s[on], where[on], live[on]
                s[np.arange(len(on)), i] = made[on, i]
                shift = np.minimum(np.arange(sym.shape[1]) + (np.arange(sym.shape[1]) > i[:, None]), sym.shape[1] - 1)
                s = np.take_along_axis(s, shift, 1)
                s[:, -1] = -1
                sym[rows_on] = s
                live = rows_on
            if n >= 2:
                out[rows] = (sym[:, 0] == a) & (sym[:, 1] == b) & ((sym[:, 2] < 0) if n > 2 else True)
        return out

    # composition and shortest path
    def solve_all(self, segs: list[str]) -> list[bytes]:
        """Ids (bytes of int32) of the tropical shortest path through each segment, all
        segments composed together: first the lexicon's arcs over the characters,
        then the path weights, one position of all segments after the other."""
        m = self.m
        code = np.frombuffer("".join(segs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.array([len(s) for s in segs], np.int64)
        begin = np.cumsum(size) - size
        n = len(code)
        seg = np.repeat(np.arange(len(segs)), size)
        room = np.repeat(begin + size, size) - np.arange(n)
        arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        on, node = np.arange(n), np.zeros(n, np.int64)
        spelled = np.zeros(n, bool)
        for step in range(1, m.longest + 1):
            node = self.edges.get(node << 21 | code[on + step - 1]).astype(np.int64)
            on, node = on[node >= 0], node[node >= 0]
            no = self.node_id[node]
            hit = no >= 0
            arcs.append((on[hit], on[hit] + step, no[hit]))
            if step == 1:
                spelled[on[hit]] = True
            keep = room[on] > step
            on, node = on[keep], node[keep]
        loose = np.flatnonzero(~spelled)
        arcs.append((loose, loose + 1, np.full(len(loose), -2, np.int64)))
        start, end, no = (np.concatenate(x) for x in zip(*arcs))
        place = start - begin[seg[start]]
        order = np.argsort(place.astype(np.uint16) if size.max(initial=0) < 65536 else place, kind="stable")
        start, end, no, place = start[order], end[order], no[order], place[order]
        # A segment of n characters has n + 1 states.
        source, target = start + seg[start], end + seg[start]
        weight = np.full(n + len(segs), np.inf)
        last, before = np.full(n + len(segs), -1, np.int64), np.zeros(n + len(segs), np.int64)
        origin = begin + np.arange(len(segs))
        weight[origin] = 0.0
        edge = np.searchsorted(place, np.arange(int(size.max(initial=0)) + 1))
        cost = np.where(no >= 0, -self.scores[np.maximum(no, 0)], -m.worst)
        for a, b in zip(edge, edge[1:]):
            q, to, p = source[a:b], target[a:b], no[a:b]
            ok = np.isfinite(weight[q])
            if m.kind == BPE:
                check = np.flatnonzero(ok & (last[q] >= 0) & (p >= 0))
                ok[check] = self.follow(last[q[check]], p[check])
            total = weight[q] + cost[a:b]
            ok &= total < weight[to]
            weight[to[ok]], last[to[ok]], before[to[ok]] = total[ok], p[ok], q[ok]
        state, path = origin + size, []
        state = state[state != origin]
        first = np.zeros(n + len(segs), bool)
        first[origin] = True
        while len(state):
            path.append(state)
            state = before[state]
            state = state[~first[state]]
        used = np.sort(np.concatenate(path)) if path else np.zeros(0, np.int64)
        ids = last[used]
        owner = np.searchsorted(origin, used, side="right") - 1
        if (ids < 0).any():
            many = [([int(i)] if i >= 0 else self._spelled(segs[o][q - 1 - origin[o]]))
                    for i, o, q in zip(ids, owner, used)]
            owner = np.repeat(owner, [len(x) for x in many])
            ids = np.array([i for x in many for i in x], np.int64)
        cut = (4 * np.searchsorted(owner, np.arange(len(segs) + 1))).tolist()
        raw = ids.astype(np.int32).tobytes()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]

    def _spelled(self, char: str) -> list[int]:
        """Byte pieces of a character that no piece spells, or the unknown one."""
        if not self.m.byte_fallback:
            return [self.m.unknown]
        return [self.m.bytes_of[b] for b in char.encode("utf-8", "surrogatepass")]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; segments that are not in the table are solved together."""
        parts = [_SEGMENT.findall(self.normalise(t)) for t in texts]
        known = self.solved
        if len(known) > TABLE:
            known.clear()
        new = list({s for p in parts for s in p if s not in known})
        if new:
            known.update(zip(new, self.solve_all(new)))
        out = [np.frombuffer(b"".join([known[s] for s in p]), np.int32) for p in parts]
        for s in new:
            if len(s) > KEEP_CHARS:
                del known[s]
        return out

    # output side
    def _output_side(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = []
        for p, _, k in self.m.pieces:
            if k == BYTE:
                out.append(bytes([int(p[3:5], 16)]))
            elif k == CONTROL:
                out.append(b"")
            elif k == UNKNOWN:
                out.append(" ⁇ ".encode())
            else:
                out.append(p.replace(MARK, " ").encode())
        size = np.array([len(b) for b in out], np.int64)
        return np.frombuffer(b"".join(out), np.uint8), np.cumsum(size) - size, size

    def decode(self, ids: np.ndarray) -> str:
        """The text of a piece sequence: pieces and bytes in order, the mark a
        space, the one in front taken off. Bytes that are no UTF-8 become U+FFFD."""
        size = self.piece_len[ids]
        total = int(size.sum())
        at = np.repeat(self.piece_at[ids] - (np.cumsum(size) - size), size) + np.arange(total)
        text = self.blob[at].tobytes().decode("utf-8", "replace")
        return text[1:] if self.m.dummy_prefix and text.startswith(" ") else text


def encode_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids, round_trip (decoding ``ids`` gives the normalised
    text back) of every row.

    A NULL text gives NULL ids, no count and no check; an empty one gives no ids.
    Each row is encoded by itself (repeats too); other columns are ignored; an
    empty table gives no rows. A very long text is cut at word marks only, which
    no piece crosses. The model travels with the function (its size is that of the vocabulary).
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches):
        fst = Transducer(model)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").to_pylist()
                coded = iter(fst.encode_all([t for t in texts if t is not None]))
                ids = [None if t is None else next(coded) for t in texts]
                same = [None if t is None else fst.decode(i) == _plain(fst, t) for t, i in zip(texts, ids)]
                off = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([0 if i is None else len(i) for i in ids], out=off[1:])
                null = np.array([i is None for i in ids])
                flat = np.concatenate([i for i in ids if i is not None and len(i)] or [np.zeros(0, np.int32)])
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32(), mask=np.r_[null, False]),
                                                 pa.array(flat, pa.int32()))
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    "n_ids": pa.array([None if i is None else len(i) for i in ids], pa.int64()),
                    "ids": lists, "round_trip": pa.array(same, pa.bool_())})

    return slim.mapInArrow(scan, f"doc_id {dict(slim.dtypes)['doc_id']}, n_ids long, ids array<int>, round_trip boolean")


def _plain(fst: Transducer, text: str) -> str:
    """What decoding has to give back: the normalised text, marks as spaces."""
    out = fst.normalise(text).replace(MARK, " ")
    return out[1:] if fst.m.dummy_prefix and out.startswith(" ") else out


def decode_ids(rows: DataFrame, model: Model, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of each row's piece ids (NULL for NULL). Ids outside
    the vocabulary raise an error."""
    slim = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def scan(batches):
        fst = Transducer(model)
        for batch in batches:
            texts = [None if i is None else fst.decode(np.array(i, np.int64)) for i in batch.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return slim.mapInArrow(scan, f"doc_id {dict(slim.dtypes)['doc_id']}, text string")
