"""Personal data in texts: exact base patterns, and a semi-Markov conditional
random field for what the patterns miss.

The field scores whole candidate segments (up to ``MAX_TOKENS`` tokens) with
features of the span and of its borders, for each entity type, against leaving
its tokens outside. Its weights are learned by gradient ascent on the exact
log-likelihood (forward and backward sums over all segmentations of a window);
windows around the base finds of a bounded sample are the labelled data, with
written variants of each find (no plus sign, spelled-out signs, other separators)
so that the model reaches beyond the patterns. Decoding picks boundaries and types
together by bounded-length dynamic programming. Only windows around digits, ``@`` and
the words ``at`` and ``dot`` are decoded: a segment without a digit, an ``@`` or two such
words is no candidate for any type.
"""

from __future__ import annotations

import bisect
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import least_hashes, text_slices

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 14
#: Code points of context on each side of a trigger.
CONTEXT = 40
#: Documents of the training sample, and windows taken from them.
SAMPLE_DOCS = 2000
SAMPLE_WINDOWS = 400
#: Tokens whose candidates are scored together.
CHUNK = 512
#: Log-odds that a segment must have over leaving its tokens outside.
MARGIN = 2.0

# The base patterns. The forms with possessive parts and a look-behind match the same spans as
# the plain ones, in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_")
_SIGN = re.compile(r"[0-9@]")
_SPELLED = re.compile(r"(?<![^\W\d_])(?:[Aa][Tt]|[Dd][Oo][Tt])(?![^\W\d_])")
_TRIGGER = re.compile(r"[0-9@]+|" + _SPELLED.pattern)
#: A spelled-out address as a whole; a host begins with no article.
_ADDRESS = re.compile(r"{0}(?:\s+dot\s+{0})*\s+at\s+(?!(?:the|an?|this|that)\s){0}(?:\s+dot\s+{0})+".format(
    r"(?!(?:at|dot)(?![A-Za-z0-9_%+-]))[A-Za-z0-9_%+-]++"), re.IGNORECASE)
_CUES = {"email": {"mail", "email", "contact"}, "ip": {"ip", "host", "server", "address"},
         "card": {"card", "visa", "credit", "iban"}, "phone": {"tel", "phone", "call", "fax", "mobile"}}

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping
    per kind; a match that fails its check is dropped and not tried again."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- the semi-Markov field ---------------------------------------------------

FEATURES = 33


def _span_features(text: str, a: int, b: int, tokens: list[str], cues: set[str], near: tuple[str, str]) -> list[float]:
    """Features of the segment text[a:b] as a whole and of its two borders;
    ``near`` holds the tokens beside it."""
    s = text[a:b]
    d = _digits(s)
    n = len(d)
    left = text[a - 1] if a else " "
    right = text[b] if b < len(text) else " "
    after = text[b + 1] if b + 1 < len(text) else " "
    letters = any(c.isalpha() for c in s)
    parts = s.split(".")
    quad = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    low = s.lower()
    spelled = _ADDRESS.fullmatch(s) is not None
    joined = near[0].lower() in ("at", "dot") or near[1].lower() in ("at", "dot")
    mail = ("@" in s and "." in s[s.index("@"):]) or re.search(r"\W(at|dot)\W.*\w\W+(dot|at)\W", low) is not None
    return [
        1.0, float(n == 0), float(0 < n < 7), float(7 <= n <= 8), float(9 <= n <= 11), float(12 <= n <= 15),
        float(n > 15), float(letters), float("@" in s), float(mail), float(quad),
        float(12 <= n <= 19 and luhn(d)), float(s[0] == "+"), float("(" in s), float("-" in s), float(" " in s),
        float("\n" in s), float(len(parts) == 4), float("." in s), float(tokens[0].isalnum() or tokens[0] in "+("),
        float(tokens[-1].isalnum()), float(left.isalnum() or left in "@_"), float(right.isalnum() or right in "@_"),
        float(right in ".-" and after.isalnum()), float(left in ".-+"),
        *(float(bool(cues & _CUES[k])) for k in KINDS), float(any(c not in "0123456789 ().+-" for c in s)),
        float(spelled and not joined), float(spelled and joined), float(n == 0 and not spelled),
    ]


def _candidates(text: str, lo: int, hi: int):
    """Tokens of a window and its candidate segments (i, j, features): every
    run of up to MAX_TOKENS tokens that has a digit or an ``@``, or a spelled-out one."""
    tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text, lo, hi)]
    return tokens, _segments(text, tokens, 0, len(tokens))


def _segments(text: str, tokens: list[tuple[int, int, str]], start: int, stop: int):
    """The candidates (``_candidates``) whose first token is one of ``start`` to ``stop``."""
    cands = []
    for i in range(start, stop):
        a, _, first = tokens[i]
        if not (first.isalnum() or first in "+("):
            continue
        cues = {t[2].lower() for t in tokens[max(0, i - 4):i]}
        spell = 0
        seen = False
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            t = tokens[j][2]
            if j > i and "\n" in text[tokens[j - 1][1]:tokens[j][0]]:
                break
            seen = seen or t == "@" or "0" <= t[0] <= "9"
            spell += t.lower() in ("at", "dot")
            if (seen or spell >= 2) and t.isalnum():
                near = (tokens[i - 1][2] if i else "", tokens[j + 1][2] if j + 1 < len(tokens) else "")
                cands.append((i, j + 1, _span_features(text, a, tokens[j][1],
                                                       [x[2] for x in tokens[i:j + 1]], cues, near)))
    return cands


def _lattice(n: int, cands, scores: np.ndarray):
    """Arcs by end position: (start, candidate, type, score)."""
    arcs: list[list[tuple[int, int, int, float]]] = [[] for _ in range(n + 1)]
    for c, (i, j, _) in enumerate(cands):
        for y in range(len(KINDS)):
            arcs[j].append((i, c, y, float(scores[c, y])))
    return arcs


def _expected(n: int, cands, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """log Z of a window and the marginal of each (candidate, type); a token
    left outside scores 0."""
    arcs = _lattice(n, cands, scores)
    fwd = np.zeros(n + 1)
    for j in range(1, n + 1):
        fwd[j] = np.logaddexp.reduce([fwd[j - 1], *(fwd[i] + s for i, _, _, s in arcs[j])])
    bwd = np.full(n + 1, -np.inf)
    bwd[n] = 0.0
    for j in range(n, 0, -1):
        bwd[j - 1] = np.logaddexp(bwd[j - 1], bwd[j])
        for i, _, _, s in arcs[j]:
            bwd[i] = np.logaddexp(bwd[i], bwd[j] + s)
    marginal = np.zeros_like(scores)
    for j in range(1, n + 1):
        for i, c, y, s in arcs[j]:
            marginal[c, y] = np.exp(fwd[i] + s + bwd[j] - fwd[n])
    return float(fwd[n]), marginal


def _best(n: int, cands, scores: np.ndarray, margin: float) -> list[tuple[int, int]]:
    """The best segmentation of a window, as (candidate, type) pairs."""
    path = _Path()
    for arcs in _lattice(n, cands, scores - margin)[1:]:
        path.step((i, y, s) for i, _, y, s in arcs)
    place = {(i, j): c for c, (i, j, _) in enumerate(cands)}
    return [(place[i, j], y) for i, j, y in path.segments()]


class _Path:
    """Dynamic programming over segment ends, each segment at most MAX_TOKENS
    long; a token left outside scores 0. Ten bytes a token."""

    def __init__(self):
        self.best, self.length, self.kind = array("d", [0.0]), array("b", [0]), array("b", [0])

    def step(self, arcs) -> None:
        """The next token, and the segments (start, type, score) that end with it."""
        j = len(self.best)
        best, length, kind = self.best[-1], 0, 0
        for i, y, s in arcs:
            if self.best[i] + s > best:
                best, length, kind = self.best[i] + s, j - i, y
        self.best.append(best)
        self.length.append(length)
        self.kind.append(kind)

    def segments(self) -> list[tuple[int, int, int]]:
        """(start, end, type) of the best segmentation."""
        out, j = [], len(self.best) - 1
        while j:
            n = self.length[j]
            if n:
                out.append((j - n, j, self.kind[j]))
            j -= n or 1
        return out[::-1]


def _decode(text: str, lo: int, hi: int, weights: np.ndarray) -> Iterator[Span]:
    """The segments of the best segmentation of a window. CHUNK tokens and
    their candidates are held at a time. Only segments that score above MARGIN can be in it;
    where none of those crosses, what lies before is decided and let go, so a
    window takes some bytes a token at most."""
    source = _TOKEN.finditer(text, lo, hi)
    tokens: list[tuple[int, int, str]] = []  # those held; the first has number ``number``
    number = first = 0
    arcs: dict[int, list[tuple[int, int, float]]] = {}  # by end: start, type, score
    reach = 0
    path, origin, edges = _Path(), 0, array("q")
    while True:
        tokens += [(m.start(), m.end(), m[0]) for m in islice(source, first + CHUNK + MAX_TOKENS + 1 - len(tokens))]
        done = len(tokens) < first + CHUNK + MAX_TOKENS + 1
        stop = len(tokens) if done else first + CHUNK
        cands = _segments(text, tokens, first, stop)
        until: dict[int, int] = {}
        if cands:
            scores = np.array([c[2] for c in cands]) @ weights - MARGIN
            for c, y in zip(*np.nonzero(scores > 0)):
                i, j = number + cands[c][0], number + cands[c][1]
                arcs.setdefault(j, []).append((i, int(y), float(scores[c, y])))
                until[i] = max(until.get(i, 0), j)
        if until or arcs:
            for at in range(first, stop):
                reach = max(reach, until.get(number + at, 0))
                end = number + at + 1
                path.step((i - origin, y, s) for i, y, s in arcs.pop(end, ()))
                edges.extend(tokens[at][:2])
                if reach <= end:
                    if path.best[-1]:
                        yield from ((edges[2 * i], y, edges[2 * j - 1]) for i, j, y in path.segments())
                    path, origin, edges = _Path(), end, array("q")
        else:
            origin = number + stop
        if done:
            return
        drop = max(0, stop - 4)
        del tokens[:drop]
        number, first = number + drop, stop - drop


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """Merged ranges of CONTEXT code points around digits, ``@`` and the words
    ``at`` and ``dot``, widened to word borders; those that hold no candidate are left out."""
    for lo, hi in _ranges(text):
        if _SIGN.search(text, lo, hi) or sum(1 for _ in islice(_SPELLED.finditer(text, lo, hi), 2)) == 2:
            yield lo, hi


def _ranges(text: str) -> Iterator[tuple[int, int]]:
    lo = hi = -1
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if a > hi:
            if hi >= 0:
                yield lo, hi
            lo = a
            while lo and text[lo - 1].isalnum() and a - lo < CONTEXT:
                lo -= 1
        hi = b
    if hi >= 0:
        yield lo, hi


#: Digits as letters, for addresses without digits.
_LETTERS = str.maketrans("0123456789", "ouwthfxszn")


def _variants(kind: int, value: str) -> list[str]:
    """Other spellings of an entity that the base patterns do not match."""
    if kind == 0:
        spelled = value.replace("@", " at ").replace(".", " dot ")
        return [spelled, spelled.translate(_LETTERS), value.replace("@", " @ ")]
    if kind == 3:
        d = _digits(value)
        return [f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}"]
    return []


def train(texts: list[str], epochs: int = 12, rate: float = 0.3, decay: float = 1e-3) -> np.ndarray:
    """Weights (features, types) from the base finds of sample texts; all
    zero (nothing is added) if no text has a find."""
    data = []
    for text in texts:
        spans = base_spans(text)
        if any(a[2] > b[0] for a, b in zip(spans, spans[1:])):
            continue  # overlapping kinds: no single segmentation
        for lo, hi in _windows(text):
            inside = [s for s in spans if lo <= s[0] and s[2] <= hi]
            if any(s[0] < hi and lo < s[2] and s not in inside for s in spans) or hi - lo > 8 * CONTEXT:
                continue
            data.append((text[lo:hi], [(a - lo, k, b - lo) for a, k, b in inside]))
            for a, k, b in inside[:1]:
                for new in _variants(k, text[a:b]) if len(inside) == 1 else []:
                    data.append((text[lo:a] + new + text[b:hi], [(a - lo, k, a - lo + len(new))]))
    weights = np.zeros((FEATURES, len(KINDS)))
    if not any(gold for _, gold in data):
        return weights
    data.sort(key=lambda d: (not d[1],))
    half = SAMPLE_WINDOWS // 2
    found = [d for d in data if d[1]]
    data = found[:: max(1, len(found) // half)] + [d for d in data if not d[1]][:half]
    prepared = []
    for text, gold in data:
        tokens, cands = _candidates(text, 0, len(text))
        place = {(tokens[i][0], tokens[j - 1][1]): c for c, (i, j, _) in enumerate(cands)}
        marks = [(place.get((a, b)), k) for a, k, b in gold]
        if cands and all(c is not None for c, _ in marks):
            prepared.append((len(tokens), cands, np.array([c[2] for c in cands]), marks))
    square = np.full_like(weights, 1e-6)
    for _ in range(epochs):
        for n, cands, x, marks in prepared:
            _, expected = _expected(n, cands, x @ weights)
            for c, k in marks:
                expected[c, k] -= 1.0
            gradient = x.T @ expected + decay * weights
            square += gradient * gradient
            weights -= rate * gradient / np.sqrt(square)
    return weights


def model_spans(text: str, weights: np.ndarray, base: list[Span]) -> list[Span]:
    """Base spans and the field's spans that overlap none of them."""
    if not weights.any():
        return base
    out = list(base)
    covered: list[list[int]] = []  # merged ranges of the base spans
    for a, _, b in base:
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    starts = [a for a, _ in covered]
    for lo, hi in _windows(text):
        for a, y, b in _decode(text, lo, hi, weights):
            at = bisect.bisect_left(starts, b) - 1
            if at < 0 or covered[at][1] <= a:
                out.append((a, y, b))
    return sorted(out)


def training_texts(docs: DataFrame, text_col: str = "text", limit: int = SAMPLE_DOCS) -> list[str]:
    """At most ``limit`` distinct texts with a digit or an ``@`` and of bounded
    length, the least by hash: the labelled sample of the classifier. Hashes are thinned
    before the least are found, so that few reach one place; texts are fetched for those only."""
    text = F.col(text_col)
    rows = (docs.where(text.rlike("[0-9@]") & (F.length(text) < 20_000))
            .select(text.alias("text"), F.xxhash64(text).alias("h")))
    least = [h for _, h in least_hashes(rows.select(F.lit("").alias("of"), "h"), limit)]
    if not least:
        return []
    wanted = docs.sparkSession.createDataFrame([(h,) for h in least], "h long")
    texts = rows.join(F.broadcast(wanted), "h").groupBy("h").agg(F.min("text").alias("text"))
    return [r.text for r in sorted(texts.collect(), key=lambda r: r.h)]


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for part in text_slices(batch, column):
        yield part, ["" if t is None else t for t in part.column(column).to_pylist()]


def _all_spans(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    if _TRIGGER.search(text) is None:
        return [], []
    base = base_spans(text)
    return base, model_spans(text, weights, base)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base finds),
    base_sha256, and spans (``kind:start:end`` of all finds by start, then kind).

    NULL text counts as empty. Every row is judged by itself, so repeated rows
    and ids repeat the result; other columns are ignored; an empty table gives no rows.
    """
    import hashlib

    def scan(batches):
        for batch in batches:
            for part, texts in _texts(batch, "text"):
                found = [_all_spans(t, weights) for t in texts]
                counts = [[sum(s[1] == k for s in base) for base, _ in found] for k in range(len(KINDS))]
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    **{f"n_{k}": pa.array(c, pa.int64()) for k, c in zip(KINDS, counts)},
                    "base_sha256": pa.array([hashlib.sha256(_written(b).encode()).hexdigest() for b, _ in found],
                                            pa.string()),
                    "spans": pa.array([_written(a) for _, a in found], pa.string())})

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = "".join(f"n_{k} long, " for k in KINDS)
    return slim.mapInArrow(scan, f"doc_id {dict(slim.dtypes)['doc_id']}, {counts}base_sha256 string, spans string")


def redact(text: str | None, weights: np.ndarray) -> str | None:
    """The text with each find replaced by its type in brackets; finds that
    overlap become one, named after the first."""
    if text is None:
        return None
    _, spans = _all_spans(text, weights)
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        a, k, b = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < b:
            b = max(b, spans[i][2])
            i += 1
        out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join(out) + text[at:]


def redact_texts(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in the text column; all other columns and rows stay.

    A NULL text stays NULL and an empty one empty; a text is decoded whole, however long, CHUNK
    tokens at a time. Each row is redacted by itself, so repeated rows give the same result;
    an empty table gives no rows; no column is added, so no name can clash.
    """
    place = docs.columns.index(text_col)

    def scan(batches):
        for batch in batches:
            for part, _ in _texts(batch, text_col):
                new = [redact(t, weights) for t in part.column(place).to_pylist()]
                cols = part.columns
                cols[place] = pa.array(new, part.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return docs.mapInArrow(scan, docs.schema)
