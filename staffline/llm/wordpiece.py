"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary becomes a trie with two roots (start of a word, continuation).
Every node holds a failure link to the node that matching goes on from once its
longest pieces are taken off, and the number of pieces taken off on the way.
One pass over the letters of a word then gives the number of its pieces without
building any of them. All words of a slice of texts step through the automaton
together, one letter position at a time, with numpy; very long words, of which few
would step together, go through it one by one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import Table, code_point_class, text_slices
from staffline.llm.spm_fst import load_model

#: The usual limit of word-piece models, for ``max_chars``: longer words are one unknown token.
MAX_CHARS = 100
#: Longer words are matched one by one.
LONG = 256

ROOT, INNER, DEAD = 0, 1, -1


@dataclass
class Automaton:
    edges: Table            # node << 21 | code point -> node
    fail: np.ndarray        # failure link, DEAD if none
    pops: np.ndarray        # pieces taken off along the failure link
    max_chars: int | None   # longer words are one unknown token; None: words of any length are matched
    plain: tuple[dict[int, int], list[int], list[int]] | None = None  # the same for one word; made where it is used


def read_pieces(path: str) -> list[str]:
    """Word pieces from a SentencePiece model file: pieces that begin with the
    word mark start a word, the others continue one (written with ``##``).
    Control, unknown and byte pieces are left out."""
    out = []
    for piece, _, kind in load_model(path).pieces:
        if kind == 1 and piece.strip("▁"):
            out.append(piece[1:] if piece[0] == "▁" else "##" + piece)
    return out


def compile_pieces(pieces: Iterable[str], max_chars: int | None = MAX_CHARS) -> Automaton:
    """The automaton of a vocabulary of word starts and ``##`` continuations;
    without ``max_chars``, words of any length are matched."""
    edges: list[dict[int, int]] = [{}, {}]
    final = [False, False]

    def add(at: int, piece: str) -> None:
        for ch in piece:
            nxt = edges[at].get(ord(ch))
            if nxt is None:
                nxt = edges[at][ord(ch)] = len(edges)
                edges.append({})
                final.append(False)
            at = nxt
        final[at] = True

    for p in pieces:
        if p.startswith("##") and len(p) > 2:
            add(INNER, p[2:])
        elif p:
            add(ROOT, p)
    n = len(edges)
    fail, pops = [DEAD] * n, [0] * n
    layer = [ROOT, INNER]
    while layer:
        below = []
        for u in layer:
            for code, v in edges[u].items():
                below.append(v)
                if final[v]:
                    fail[v], pops[v] = INNER, 1
                    continue
                z, taken = fail[u], pops[u]
                while z != DEAD and code not in edges[z]:
                    z, taken = fail[z], taken + pops[z]
                if z != DEAD:
                    fail[v], pops[v] = edges[z][code], taken
        layer = below
    key = np.array([u << 21 | code for u in range(n) for code in edges[u]], np.int64)
    to = np.array([v for u in range(n) for v in edges[u].values()], np.int32)
    return Automaton(Table(key, to), np.array(fail, np.int32), np.array(pops, np.int32), max_chars)


def _count_long(a: Automaton, word: list[int]) -> int:
    """Pieces of one word, -1 if it cannot be split into pieces."""
    if a.plain is None:
        on = a.edges.key != -1
        a.plain = dict(zip(a.edges.key[on].tolist(), a.edges.value[on].tolist())), a.fail.tolist(), a.pops.tolist()
    edges, fail, pops = a.plain
    node = count = 0
    for c in word:
        while (nxt := edges.get(node << 21 | c)) is None:
            count += pops[node]
            node = fail[node]
            if node == DEAD:
                return -1
        node = nxt
    while node != INNER:
        count += pops[node]
        node = fail[node]
        if node == DEAD:
            return -1
    return count


def count_words(a: Automaton, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Pieces of each word code[start:end]; a word that cannot be split into
    pieces, or is longer than the limit if there is one, is one unknown token."""
    size = end - start
    count = np.zeros(len(start), np.int32)
    node = np.zeros(len(start), np.int32)
    unknown = size > a.max_chars if a.max_chars is not None else np.zeros(len(start), bool)
    order = np.argsort(size, kind="stable")
    order = order[~unknown[order]]
    for i in order[size[order] > LONG].tolist():
        n = _count_long(a, code[start[i]:end[i]].tolist())
        count[i], unknown[i] = n, n < 0
    order = order[size[order] <= LONG]
    sizes = size[order]
    for t in range(int(sizes[-1]) if len(sizes) else 0):
        on = order[np.searchsorted(sizes, t, side="right"):]
        on = on[~unknown[on]]
        c = code[start[on] + t].astype(np.int64)
        while len(on):
            nxt = a.edges.get(node[on].astype(np.int64) << 21 | c)
            ok = nxt != DEAD
            node[on[ok]] = nxt[ok]
            on, c = on[~ok], c[~ok]
            back = a.fail[node[on]]
            count[on] += a.pops[node[on]]
            stuck = back == DEAD
            unknown[on[stuck]] = True
            on, c, back = on[~stuck], c[~stuck], back[~stuck]
            node[on] = back
    on = order[~unknown[order]]
    while len(on):
        back = a.fail[node[on]]
        count[on] += a.pops[node[on]]
        unknown[on[back == DEAD]] = True
        node[on] = back
        on = on[(back != INNER) & (back != DEAD)]
    return np.where(unknown, 1, count)


def count_texts(a: Automaton, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(words, pieces) of each text; words are split at Unicode white space."""
    raw = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    edge = np.diff((~code_point_class("isspace")[raw]).astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(bounds, start, side="right") - 1
    pieces = count_words(a, raw, start, end)
    n = len(texts)
    return np.bincount(row, minlength=n)[:n], np.bincount(row, weights=pieces, minlength=n)[:n].astype(np.int64)


def count_tokens(docs: DataFrame, automaton: Automaton, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens of every row. NULL and empty texts have no
    words and no tokens; every row is counted by itself (repeats too); other columns
    are ignored; an empty table gives no rows. The automaton, whose size is that of
    the vocabulary, travels with the function."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, pieces = count_texts(automaton, ["" if t is None else t for t in part.column("text").to_pylist()])
                yield pa.record_batch({"doc_id": part.column("doc_id"), "n_words": pa.array(words, pa.int64()),
                                       "n_tokens": pa.array(pieces, pa.int64())})

    return slim.mapInArrow(scan, f"doc_id {dict(slim.dtypes)['doc_id']}, n_words long, n_tokens long")
