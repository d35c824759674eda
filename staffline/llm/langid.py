"""Language identification by a linear-chain conditional random field over words.

Each word of a text is a step of the chain; its label is a language. Emission
scores sum learned weights of hashed character n-grams, affixes and lexicon
membership; transitions between labels are learned too, from training texts
that are spliced from runs of several languages, so that code-switched text is
labelled word by word. Forward-backward gives each word's posterior; a text's
language is the one with the greatest mean posterior. Features and sums are computed
with numpy over a slice of texts at once: the chain is cut into blocks whose
transfer matrices are multiplied, so that long texts cost no long Python loop.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import _power, code_point_class, least_hashes, mix, text_slices

#: Training documents per language (the bound of the fitting sample), words per spliced training text,
#: and how many such texts are made.
DOCS_PER_LANG = 300
SPLICE = 48
SPLICES = 2400
#: Longer words are left out of the fitting sample (never out of a text that is judged).
SAMPLE_WORD = 60
LEXICON = 400
BITS = 17
BLOCK = 64
UNKNOWN = "und"
#: Mean of the words' greatest posteriors from which a text of several languages counts as identified.
MIN_SURE = 0.7
#: Bytes of text that are judged together: features and posteriors take some hundred bytes a letter.
SLICE = 1 << 19


@dataclass
class Words:
    """Letters of a list of texts as code points (0 elsewhere), and the words."""
    code: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def find_words(texts: list[str]) -> Words:
    """Maximal runs of letters, in lower case; row = number of the text."""
    low = [t.lower() for t in texts]
    raw = np.frombuffer("\n".join(["", *low, "", "", "", ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 for t in low], np.int64)
    letter = code_point_class("isalpha")[raw]
    code = np.where(letter, raw, 0).astype(np.uint64)
    edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(np.cumsum(sizes) + 1, start, side="right")
    return Words(code, start, end, row)


_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _slot(kind: int, *codes: np.ndarray) -> np.ndarray:
    h = np.full(codes[0].shape, np.uint64(kind * 0x1000193 + 1), np.uint64)
    for k, c in zip(_K, codes):
        h += c * k
        h ^= h >> np.uint64(29)
    h *= _K[3]
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def word_hash(w: Words) -> np.ndarray:
    """64-bit hash of each word, from prefix sums over its letters."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    n = len(w.code)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(w.code) * _power("up", n), out=acc[1:])
    return mix((acc[w.end] - acc[w.start]) * _power("down", n)[w.start])


def features(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slots of the 2- and 3-gram at each letter; index of each word's first
    letter among the letters; affix slots of each word; hash of each word)."""
    at = np.flatnonzero(w.code)
    c0, c1, c2 = w.code[at - 1], w.code[at], w.code[at + 1]
    grams = np.stack([_slot(1, c0, c1), _slot(2, c0, c1, c2)], 1)
    first = np.searchsorted(at, w.start)
    s, e = w.start, w.end - 1
    long3, long4 = w.end - s >= 3, w.end - s >= 4

    def pick(i, ok):
        return np.where(ok, w.code[i], np.uint64(0))

    affix = np.stack([
        _slot(3, pick(s, True), pick(s + 1, long3), pick(s + 2, long3)),
        _slot(4, pick(e, True), pick(e - 1, long3), pick(e - 2, long3)),
        _slot(5, pick(e, True), pick(e - 1, long4), pick(e - 2, long4), pick(e - 3, long4)),
    ], 1) if len(s) else np.zeros((0, 3), np.int64)
    return grams, first, affix, word_hash(w)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray        # (2^BITS, L)
    lex_hash: np.ndarray       # sorted hashes of lexicon words
    lex_in: np.ndarray         # (words, L): in the lexicon of the language
    lex_weights: np.ndarray    # (L + 1, L): lexicon feature (or none) -> label
    transition: np.ndarray     # (L, L)


def _lexicon_rows(m: Model, hashes: np.ndarray) -> np.ndarray:
    """(words, L + 1): membership in each language's lexicon, and in none."""
    out = np.zeros((len(hashes), len(m.langs) + 1), np.float32)
    if len(m.lex_hash):
        i = np.minimum(np.searchsorted(m.lex_hash, hashes), len(m.lex_hash) - 1)
        hit = m.lex_hash[i] == hashes
        out[hit, :-1] = m.lex_in[i[hit]]
    out[:, -1] = out[:, :-1].sum(1) == 0
    return out


def emissions(m: Model, feats) -> np.ndarray:
    """(words, L) scores."""
    grams, first, affix, hashes = feats
    if not len(first):
        return np.zeros((0, len(m.langs)), np.float32)
    letter = m.weights[grams[:, 0]]
    letter += m.weights[grams[:, 1]]
    out = np.add.reduceat(letter, first, axis=0)
    for j in range(affix.shape[1]):
        out += m.weights[affix[:, j]]
    return out + _lexicon_rows(m, hashes) @ m.lex_weights


def _scaled(x: np.ndarray, axis) -> np.ndarray:
    return x / np.maximum(x.max(axis=axis, keepdims=True), 1e-30)


def posteriors(emit: np.ndarray, transition: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Forward-backward over many chains at once: the posterior label
    distribution of each word. ``row`` (ascending) tells the chain of each word.
    A chain starts from equal weights, through the transitions."""
    n, L = emit.shape
    if not n:
        return np.zeros((0, L))
    A = np.exp(transition - transition.max()).astype(np.float64)
    psi = np.exp(emit - emit.max(1, keepdims=True)).astype(np.float64) + 1e-12
    chain_at = np.searchsorted(row, np.arange(rows + 1))
    length = np.diff(chain_at)
    blocks = -(-length // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    B = int(blocks.sum())
    word = np.arange(n) - chain_at[row]
    b_of, p_of = first_block[row] + word // BLOCK, word % BLOCK
    # Words laid out as (place in block, block, L); places after the end of a chain are skipped.
    grid = np.zeros((BLOCK, B, L))
    used = np.zeros((BLOCK, B), bool)
    grid[p_of, b_of] = psi
    used[p_of, b_of] = True
    full = used.sum(0)
    # 1. transfer matrix of each block
    M = np.broadcast_to(np.eye(L), (B, L, L)).copy()
    for t in range(int(full.max())):
        on = np.flatnonzero(used[t])
        M[on] = _scaled((M[on] @ A) * grid[t, on][:, None, :], (1, 2))
    # 2. state before the first and weights after the last word of each block
    left, right = np.full((B, L), 1.0 / L), np.ones((B, L))
    order = np.flatnonzero(blocks)
    for s in range(1, int(blocks.max())):
        on = first_block[order[blocks[order] > s]] + s
        left[on] = _scaled(np.einsum("bi,bij->bj", left[on - 1], M[on - 1]), 1)
        last = first_block[order[blocks[order] > s]] + blocks[order[blocks[order] > s]] - s
        right[last - 1] = _scaled(np.einsum("bij,bj->bi", M[last], right[last]), 1)
    # 3. within the blocks
    alpha = np.zeros((BLOCK, B, L))
    state = left
    for t in range(int(full.max())):
        on = used[t][:, None]
        state = np.where(on, _scaled((state @ A) * grid[t], 1), state)
        alpha[t] = state
    beta = right.copy()
    for t in range(int(full.max()) - 1, -1, -1):
        on = used[t][:, None]
        post = alpha[t] * beta
        alpha[t] = post / np.maximum(post.sum(1, keepdims=True), 1e-300)
        beta = np.where(on, _scaled((grid[t] * beta) @ A.T, 1), beta)
    return alpha[p_of, b_of]


def train(samples: list[tuple[str, str]], epochs: int = 4, batch: int = 60, seed: int = 11) -> Model:
    """Fit on (language, text) pairs: texts of SPLICE words are spliced from
    runs of several documents, and the log-likelihood of their word labels is
    climbed by Adagrad. The lexicon holds each language's most frequent words
    of the sample."""
    samples = sorted(samples)
    langs = sorted({lang for lang, _ in samples})
    L = len(langs)
    model = Model(langs, np.zeros((1 << BITS, max(L, 1)), np.float32), np.zeros(0, np.uint64),
                  np.zeros((0, L), np.float32), np.zeros((L + 1, max(L, 1)), np.float32), np.zeros((L, L)))
    if L < 2:
        return model
    w = find_words([t for _, t in samples])
    short = w.end - w.start <= SAMPLE_WORD
    w = Words(w.code, w.start[short], w.end[short], w.row[short])
    label_of = np.array([langs.index(lang) for lang, _ in samples])
    feats = features(w)
    hashes = feats[3]
    label = label_of[w.row]
    top: dict[int, set[int]] = {}
    for k in range(L):
        h, c = np.unique(hashes[label == k], return_counts=True)
        for x in h[np.lexsort((h, -c))][:LEXICON].tolist():
            top.setdefault(x, set()).add(k)
    model.lex_hash = np.array(sorted(top), np.uint64)
    model.lex_in = np.array([[float(k in top[x]) for k in range(L)] for x in sorted(top)], np.float32)
    rng = np.random.default_rng(seed)
    doc_at = np.searchsorted(w.row, np.arange(len(samples) + 1))
    by_lang = [np.flatnonzero((label_of == k) & (np.diff(doc_at) > 0)) for k in range(L)]
    by_lang = [d for d in by_lang if len(d)]
    chains = []
    for _ in range(SPLICES if by_lang else 0):
        words: list[np.ndarray] = []
        n = 0
        while n < SPLICE:
            docs = by_lang[rng.integers(len(by_lang))]
            d = docs[rng.integers(len(docs))]
            run = int(min(rng.geometric(1 / 16), SPLICE - n, doc_at[d + 1] - doc_at[d]))
            a = int(rng.integers(doc_at[d], doc_at[d + 1] - run + 1))
            words.append(np.arange(a, a + run))
            n += run
        chains.append(np.concatenate(words))
    letters = w.end - w.start
    square = np.full(model.weights.shape, 1e-4, np.float32)
    square_t, square_x = np.full((L, L), 1e-4), np.full(model.lex_weights.shape, 1e-4)
    for _ in range(epochs):
        for at in range(0, len(chains), batch):
            part = chains[at:at + batch]
            ids = np.concatenate(part)
            chain = np.repeat(np.arange(len(part)), [len(c) for c in part])
            size = letters[ids]
            first = np.cumsum(size) - size
            flat = np.arange(size.sum()) - np.repeat(first, size) + np.repeat(feats[1][ids], size)
            sub = (feats[0][flat], first, feats[2][ids], hashes[ids])
            y = label[ids]
            post, pairs = _marginals(emissions(model, sub), model.transition, chain)
            gold = np.eye(L)[y]
            gap = (gold - post).astype(np.float32)
            same = np.flatnonzero(np.diff(chain) == 0)
            seen = np.zeros((L, L))
            np.add.at(seen, (y[same], y[same + 1]), 1.0)
            for value, sq, grad in ((model.transition, square_t, seen - pairs),
                                    (model.lex_weights, square_x, _lexicon_rows(model, sub[3]).T @ gap)):
                sq += grad * grad
                value += 0.2 * grad / np.sqrt(sq)
            slot = np.concatenate([sub[0].ravel(), sub[2].ravel()])
            what = np.concatenate([np.repeat(np.repeat(gap, size, 0), 2, 0), np.repeat(gap, sub[2].shape[1], 0)])
            used, where = np.unique(slot, return_inverse=True)
            grad = np.zeros((len(used), L), np.float32)
            np.add.at(grad, where, what)
            square[used] += grad * grad
            model.weights[used] += 0.1 * grad / np.sqrt(square[used])
    return model


def _marginals(emit: np.ndarray, transition: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors, and the summed pair posteriors of neighbouring words."""
    post = posteriors(emit, transition, chain, int(chain[-1]) + 1)
    # The pair posterior of t, t+1 follows from the filtered state at t and the smoothed one at t+1.
    n, L = emit.shape
    A = np.exp(transition - transition.max())
    psi = np.exp(emit - emit.max(1, keepdims=True)) + 1e-12
    at = np.searchsorted(chain, np.arange(int(chain[-1]) + 2))
    length = np.diff(at)
    state = np.full((len(length), L), 1.0 / L)
    pairs = np.zeros((L, L))
    for t in range(int(length.max())):
        on = np.flatnonzero(length > t)
        i = at[on] + t
        step = state[on][:, :, None] * A * psi[i][:, None, :]
        new = step.sum(1)
        if t:
            back = step / np.maximum(new[:, None, :], 1e-300) * post[i][:, None, :]
            pairs += back.sum(0)
        state[on] = new / np.maximum(new.sum(1, keepdims=True), 1e-300)
    return post, pairs


def training_sample(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                    per_lang: int = DOCS_PER_LANG) -> list[tuple[str, str]]:
    """At most ``per_lang`` (language, text) pairs of each language, the least
    by hash of the text: only hashes are ranked, thinned for each language before, so that
    a language with a third of all rows does not meet in one task; texts are fetched for the chosen."""
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
            .select(F.col(lang_col).cast("string").alias("of"), F.xxhash64(text_col).alias("h")))
    keys = set(least_hashes(rows, per_lang))
    if not keys:
        return []
    spark = docs.sparkSession
    wanted = spark.createDataFrame(sorted(keys), "lang string, h long")
    texts = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
             .withColumn("h", F.xxhash64("text")).join(F.broadcast(wanted), ["lang", "h"])
             .groupBy("lang", "h").agg(F.min("text").alias("text")))
    return [(r.lang, r.text) for r in texts.collect()]


def classify(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score (mean posterior of that language) of each text."""
    return judge(model, texts)[:2]


def judge(model: Model, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
    """Language and score of each text, and how sure its words are: the mean
    of each word's greatest posterior, whichever language has it."""
    n = len(texts)
    w = find_words(texts)
    has = np.bincount(w.row, minlength=n)[:n] if len(w.row) else np.zeros(n, np.int64)
    if not model.langs:
        return [UNKNOWN] * n, [0.0] * n, [0.0] * n
    if len(model.langs) == 1:
        one = [1.0 if h else 0.0 for h in has]
        return [model.langs[0] if h else UNKNOWN for h in has], one, one
    post = posteriors(emissions(model, features(w)), model.transition, w.row, n)
    total = np.zeros((n, len(model.langs)))
    if len(w.row):
        at = np.flatnonzero(np.r_[True, np.diff(w.row) != 0])
        total[w.row[at]] = np.add.reduceat(post, at, axis=0)
    best = total.argmax(1)
    score = total[np.arange(n), best] / np.maximum(has, 1)
    sure = np.bincount(w.row, weights=post.max(1), minlength=n)[:n] / np.maximum(has, 1)
    return ([model.langs[b] if h else UNKNOWN for b, h in zip(best, has)],
            *([float(min(1.0, s)) if h else 0.0 for s, h in zip(x, has)] for x in (score, sure)))


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1) in place of
    the text column; all other columns pass through. A column of ``docs`` that is named like one
    of these two is replaced.

    A text that is NULL, empty or without a letter is ``und`` with score 0, as is
    every text if nothing was learned. Very long texts are labelled whole. Rows are judged one by one, so repeated
    rows repeat the result; ties go to the language first in order; an empty
    table gives no rows.
    """
    rest = [c for c in docs.columns if c not in (text_col, lang_out, score_out)]
    slim = docs.select(*rest, text_col)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in slim.dtypes[:-1]), f"`{lang_out}` string", f"`{score_out}` double"])

    def scan(batches):
        for batch in batches:
            for part in text_slices(batch, text_col, SLICE):
                lang, score = classify(model, ["" if t is None else t for t in part.column(len(rest)).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*rest, lang_out, score_out])

    return slim.mapInArrow(scan, schema)


def keep_identified(docs: DataFrame, model: Model, min_score: float, text_col: str = "text",
                    min_sure: float = MIN_SURE) -> DataFrame:
    """The rows of ``docs`` whose text gets a language with at least
    ``min_score``, or, as in texts of several languages, whose words are each sure of
    theirs by ``min_sure`` in the mean; all columns stay as they are. Texts that are
    NULL, empty or without a letter go."""
    place = docs.columns.index(text_col)

    def scan(batches):
        for batch in batches:
            for part in text_slices(batch, text_col, SLICE):
                found = judge(model, ["" if t is None else t for t in part.column(place).to_pylist()])
                keep = [a != UNKNOWN and (s >= min_score or c >= min_sure) for a, s, c in zip(*found)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
