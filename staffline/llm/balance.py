"""Cost-balanced packing of tokenised texts into sequences of one length.

The cost of a piece of n tokens is estimated as ``linear * n + quadratic * n^2``
(matrix products grow with the tokens, attention inside a piece with their
square). Texts are tokenised once, where they are read; a group of some thousand
texts is packed as soon as it is full, in the same task, so that no token is
shuffled and a task holds one group at a time. Within a group documents go, longest
first, to the sequence of least cost that still has room for the whole of them;
what no sequence can take whole is cut over the rooms left, least cost first. A group
opens as many sequences as its tokens fill, so that each of them ends up full; the
tokens over go into sequences whose lengths are powers of two, which need no
padding either.

Token ids do not depend on what stands across white space (the pattern of the
tokenizer never matches any), so a word is tokenised once per task and then looked up.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import LATIN, latin_ids, text_slices, without_gc

CAPACITY = 4096
#: Cost of a token, and of a pair of tokens of one piece: for a model of width d, about 1 to 6 d (here 2,048).
LINEAR, QUADRATIC = 1.0, 1.0 / (6 * 2048)
#: A group is packed once it has this many tokens (1,024 sequences, 16 MB of ids).
GROUP_TOKENS = 1 << 22
#: Longer words are tokenised each time; the words held by a task are dropped when there are as many as this.
WORD_BYTES, WORDS_HELD = 64, 1_000_000
#: What TAIL takes as the punctuation after a letter: ASCII, without the apostrophe.
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)


def balance(lengths: Sequence[int], capacity: int = CAPACITY, linear: float = LINEAR,
            quadratic: float = QUADRATIC) -> tuple[list[tuple[int, int, int, int, int]], list[int], list[float]]:
    """(document, start, length, sequence, offset) of each piece, and the size and cost of
    each sequence. ``lengths`` in any order; equal ones keep theirs.

    A document of at least ``capacity`` tokens first gives up full sequences. Every
    sequence is full but the last ones, whose sizes are the powers of two that add up
    to the tokens over, the largest first."""
    pieces: list[tuple[int, int, int, int, int]] = []
    rest = np.asarray(lengths, np.int64)
    whole = rest // capacity
    one = linear * capacity + quadratic * capacity * capacity
    for doc in np.flatnonzero(whole).tolist():
        for i in range(int(whole[doc])):
            pieces.append((doc, i * capacity, capacity, len(pieces), 0))
    first = len(pieces)
    rest = rest % capacity
    total = int(rest.sum())
    size = np.r_[np.full(total // capacity, capacity, np.int64),
                 np.array([1 << b for b in range(62, -1, -1) if total % capacity >> b & 1], np.int64)]
    room, cost = size.copy(), np.zeros(len(size))

    def put(doc: int, start: int, n: int, at: int) -> None:
        pieces.append((doc, start, n, first + at, int(size[at] - room[at])))
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n

    left = []
    for doc in np.argsort(-rest, kind="stable").tolist():
        n = int(rest[doc])
        if not n:
            break
        at = int(np.where(room >= n, cost, np.inf).argmin())
        if room[at] >= n:
            put(doc, int(whole[doc]) * capacity, n, at)
        else:
            left.append(doc)
    for doc in left:
        start, end = int(whole[doc]) * capacity, int(lengths[doc])
        while start < end:
            at = int(np.where(room > 0, cost, np.inf).argmin())
            n = min(int(room[at]), end - start)
            put(doc, start, n, at)
            start += n
    return pieces, [capacity] * first + size.tolist(), [one] * first + cost.tolist()


class Words(dict):
    """Word -> its ids as little-endian 32-bit numbers, made by a tokenizer at first use."""

    def __init__(self, tokenizer: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer  # the library is loaded where it is used
        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = np.array([end_id], "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(PUNCTUATION)
        if word.isalpha():  # ASCII letters, which stand for themselves in a byte-level alphabet
            low = word.lower()
            ids = array("I", [t.id for t in self.model.tokenize(low.decode())]).tobytes() if low == word else self[low]
        elif len(stem) < len(word) and stem[-1:].isalpha() and not any(t in word for t in self.special):
            ids = self[stem] + self[word[len(stem):]]  # as TAIL
        elif LATIN.fullmatch(text := word.decode()):
            ids = latin_ids(self.model, text.lower())
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(word) <= WORD_BYTES:
            if len(self) >= WORDS_HELD:
                self.clear()
            self[word] = ids
        return ids

    def ids(self, texts: Sequence[bytes]) -> list[bytes]:
        """The ids and the end of each text."""
        return [b"".join(map(self.__getitem__, t.split())) + self.end for t in texts]


def splits_at_space(tokenizer: str) -> None:
    """Refuse a tokenizer whose tokens might depend on what stands across white space."""
    import json
    spec = json.loads(tokenizer)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = steps[0] if steps else {}
    space = [t for t in spec["added_tokens"] if any(c.isspace() for c in t["content"]) or t["lstrip"] or t["rstrip"]]
    pattern = first.get("pattern", {}).get("Regex", "")
    if (first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert") or space
            or " " in pattern or r"\s" in pattern.replace(r"[^\s", "")):
        raise ValueError("tokenizer does not drop white space between words")


def pack_tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC,
                group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pack every token of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, capacity (size of the sequence), cost (of the sequence); one row per piece.

    ``tokenizer`` is the JSON text of a tokenizer that drops white space (its size is that
    of a vocabulary; it travels with the function). A document is its ids and ``end_id``;
    a NULL or empty text is the end alone. A document longer than a sequence is cut into
    several; nothing is cut away, whatever its length. Equal lengths are placed in the order
    of the rows; repeated rows, and rows of one or no id, are documents of their own. An empty
    table gives no rows. Other columns are ignored. Sequence ids name the task and count
    up in it; a task that runs again over the same rows gives the same ones."""
    splits_at_space(tokenizer)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(tokenizer, end_id)
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        names: list[pa.Array] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held
            length = [len(x) >> 2 for x in ids]
            pieces, size, cost = balance(length, capacity, linear, quadratic)
            key = pa.concat_arrays(names)
            for a in range(0, len(pieces), 50_000):
                part = pieces[a:a + 50_000]
                doc, start, n, seq, offset = map(list, zip(*part))
                crc = [zlib.crc32(ids[d][4 * s:4 * (s + m)]) for d, s, m in zip(doc, start, n)]
                yield pa.record_batch({
                    "doc_id": key.take(pa.array(doc)), "start": pa.array(start, pa.int64()),
                    "length": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": pa.array([length[d] for d in doc], pa.int64()),
                    "sequence_id": pa.array([sequence + s for s in seq], pa.int64()),
                    "offset": pa.array(offset, pa.int64()), "capacity": pa.array([size[s] for s in seq], pa.int64()),
                    "cost": pa.array([cost[s] for s in seq], pa.float64())})
            sequence, held = sequence + len(size), 0
            names.clear()
            ids.clear()

        for batch in batches:
            for part in text_slices(batch, "text"):
                names.append(part.column("doc_id"))
                new = words.ids(pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist())
                ids += new
                held += sum(map(len, new)) >> 2
                if held >= group_tokens:
                    yield from flush()
        if ids:
            yield from flush()

    return slim.mapInArrow(without_gc(scan), f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
                                 "sequence_id long, offset long, capacity long, cost double")
