"""Packs documents into sequences of at most ``size`` tokens, keeping their order.

The documents of an input partition form one stream of token ids, each document closed by
``end_id``. Windows are cut from the stream by dynamic programming over the places where a cut
is allowed: document ends (free), sentence ends (``sentence_penalty``), and, only inside
stretches without either, every ``size / 8`` tokens (``stretch_penalty``). The cost is the
padding of every window plus the penalties of its cuts, in tokens:

    f(j) = penalty(j) + min over i, with c(j) - c(i) <= size, of f(i) + size - (c(j) - c(i))

``f(i) + c(i)`` does not depend on j, so a monotone queue gives each minimum in constant time.
Windows as long as a power of two need no padding; those few transitions are looked at apart.

The stream is worked off in blocks of ``block_tokens``: the last window of a block is not
fixed yet but starts the next block, so memory is bounded and only the end of a partition is
padded for being the end. Nothing is shuffled; the sequence number holds the partition.
"""

from __future__ import annotations

import re
import string
import sys
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from parcelwise.llm.words import tidy
from parcelwise.llm.words import texts as texts_of

TOKENIZER = "word_bpe_49k.json"
BLOCK_TOKENS = 1 << 18
OUTPUT_BYTES = 4 << 20


class WordIds(dict):
    """Word (bytes between ASCII white space) to the bytes of its ids, little-endian 32 bit.

    The tokenizer drops white space and never joins what it separates, so a text's ids are
    those of its words. A plain word is asked of the library's model directly, in lower case
    and apart from ASCII punctuation behind it, which its rules always cut off as one piece; anything else goes
    through the whole library. At ``limit`` words the table becomes the older generation, which
    is still looked at, so frequent words stay and memory is bounded.
    """

    #: Letters whose lower case and normal form are one character each.
    _PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.limit = limit
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The model sees bytes as characters: printable ones stay, the rest follow from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.characters = {b: 256 + k for k, b in enumerate(others)}

    def sentence_ends(self) -> np.ndarray:
        """For every id, whether it is punctuation that closes a sentence."""
        vocabulary = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, number in vocabulary.items():
            text = piece.removesuffix("</w>")
            ends[number] = text != piece and any(c in ".!?" for c in text) and not any(c.isalnum() for c in text)
        return ends

    def word_ends(self) -> np.ndarray:
        """For every id, whether a word ends with it."""
        vocabulary = self.tokenizer.get_vocab()
        ends = np.ones(max(vocabulary.values()) + 1, bool)
        for piece, number in vocabulary.items():
            ends[number] = piece.endswith("</w>") or piece.startswith("<|")
        return ends

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(word)
        if value is None:
            value = self._encode(word)
        self[word] = value
        return value

    def _encode(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only, which are the same in every alphabet here
            return _packed(map(_id_of, self.model.tokenize(word.decode()))) if word.islower() else self[word.lower()]
        plain = word.rstrip(_MARKS)
        if plain.isalpha() and plain != word:
            return self[plain.lower()] + self[word[len(plain) :]]
        text = word.decode()
        plain = self._PLAIN.fullmatch(text)
        if not plain:
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if plain[2] or text != text.lower():
            return self[plain[1].lower().encode()] + (self[plain[2].encode()] if plain[2] else b"")
        seen = word.decode("latin-1").translate(self.characters)
        return _packed(map(_id_of, self.model.tokenize(seen)))


_id_of = attrgetter("id")
_MARKS = string.punctuation.encode()


def _packed(ids: Iterable[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder != "little":
        numbers.byteswap()
    return numbers.tobytes()


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case where the ids are the same: the tokenizer does so too, after it has found its control
    strings and joined letters with marks (U+0300 to U+033F, which begin with this byte) behind them."""
    return (text if b"<|" in text or b"\xcc" in text else text.lower()).split()


@lru_cache(maxsize=1)
def id_table(path: str) -> WordIds:
    """One table for all tasks of a Python worker."""
    return WordIds(path)


def cut(places: np.ndarray, penalties: np.ndarray, size: int) -> list[int]:
    """Indexes into ``places`` of the cheapest cuts, first and last place included.

    ``places`` rises from 0, and no two neighbours are further apart than ``size``.
    """
    c, penalty = places.tolist(), penalties.tolist()
    exact: dict[int, list[int]] = {}
    power = size // 2 if size & (size - 1) == 0 else 1 << (size.bit_length() - 1)
    for _ in range(3):  # a few halves; shorter windows would only be crumbs
        at = np.searchsorted(places, places - power)
        for j in np.flatnonzero((at < len(places)) & (places[np.minimum(at, len(places) - 1)] == places - power)):
            exact.setdefault(int(j), []).append(int(at[j]))
        power //= 2
    f, g, back = [0.0] * len(c), [0.0] * len(c), [0] * len(c)
    queue: deque[int] = deque()
    for j in range(1, len(c)):
        value = g[j - 1]
        while queue and g[queue[-1]] >= value:
            queue.pop()
        queue.append(j - 1)
        here = c[j]
        while here - c[queue[0]] > size:
            queue.popleft()
        best = queue[0]
        cost = g[best] + size - here
        for i in exact.get(j, ()):
            if f[i] < cost:
                best, cost = i, f[i]
        back[j] = best
        f[j] = cost = cost + penalty[j]
        g[j] = cost + here
    cuts = [len(c) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class _Stream:
    """Documents of one partition that are not yet in a fixed window."""

    def __init__(self, size: int, sentence_ends: np.ndarray, sentence_penalty: float, stretch_penalty: float):
        self.size, self.sentence_ends = size, sentence_ends
        self.sentence_penalty, self.stretch_penalty = sentence_penalty, stretch_penalty
        self.documents: list[tuple[object, bytes, int]] = []  # id, bytes of ids, tokens already given out
        self.held = 0
        self.sequence = 0

    def add(self, doc_id: object, ids: bytes) -> None:
        self.documents.append((doc_id, ids, 0))
        self.held += len(ids) // 4

    def _places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places, penalties, ends, at = [np.zeros(1, np.int64)], [np.zeros(1)], [], 0
        step = max(1, self.size // 8)
        for _, ids, start in self.documents:
            tokens = np.frombuffer(ids, "<u4")[start:]
            inside = np.flatnonzero(self.sentence_ends[np.minimum(tokens, len(self.sentence_ends) - 1)][:-1]) + 1
            if len(inside) and inside[-1] == len(tokens) - 1:
                inside = inside[:-1]  # only the end mark would follow
            bounds = np.concatenate([[0], inside, [len(tokens)]])
            far = np.flatnonzero(np.diff(bounds) > step)
            extra = [np.arange(bounds[k] + step, bounds[k + 1], step) for k in far]
            own = np.concatenate([inside, *extra]).astype(np.int64)
            cost = np.full(len(own), self.stretch_penalty)
            cost[: len(inside)] = self.sentence_penalty
            order = np.argsort(own, kind="stable")
            places += [at + own[order], np.array([at + len(tokens)])]
            penalties += [cost[order], np.zeros(1)]
            at += len(tokens)
            ends.append(at)
        return np.concatenate(places), np.concatenate(penalties), np.array(ends)

    def windows(self, last: bool) -> Iterator[tuple]:
        """Rows of all windows that are fixed now; the others stay."""
        if not self.documents:
            return
        places, penalties, ends = self._places()
        cuts = places[cut(places, penalties, self.size)].tolist()
        fixed = cuts if last else cuts[:-1]
        starts = ends - np.array([len(ids) // 4 - start for _, ids, start in self.documents])
        for begin, end in zip(fixed, fixed[1:]):
            k, offset = bisect_right(ends, begin), 0
            while begin < end:
                doc_id, ids, start = self.documents[k]
                upto = min(end, int(ends[k]))
                first = start + begin - int(starts[k])
                length = upto - begin
                yield doc_id, first, length, ids[4 * first : 4 * (first + length)], len(ids) // 4, self.sequence, offset
                offset += length
                begin = upto
                k += 1
            self.sequence += 1
        rest = []
        if not last:
            k = bisect_right(ends, fixed[-1])
            doc_id, ids, start = self.documents[k]
            rest = [(doc_id, ids, start + fixed[-1] - int(starts[k])), *self.documents[k + 1 :]]
        self.documents = rest
        self.held = sum(len(ids) // 4 - start for _, ids, start in rest)


def pack(
    docs: DataFrame,
    *,
    size: int = 2048,
    end_id: int = 1,
    sentence_penalty: float = 16,
    stretch_penalty: float = 64,
    tokenizer_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: which document's tokens stand where in which sequence.

    ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids`` (the piece
    itself, little-endian unsigned 32-bit, as ``numpy.frombuffer(ids, '<u4')`` reads it),
    ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence, without gaps from 0. Every id
    lies in exactly one piece. Sequences never cross an input partition, and their order is
    that of the rows there.

    NULL text counts as empty: such a document is its end mark alone. Repeated rows and NULL ids are
    packed like others; other columns are ignored; an empty table gives no row.
    """
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = id_table(path)
        stream = _Stream(size, words.sentence_ends(), sentence_penalty, stretch_penalty)
        first = TaskContext.get().partitionId() << 32
        kind = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns[5] = [first + n for n in columns[5]]
            return pa.record_batch([pa.array(v, t) for v, t in zip(columns, types)], names=names)

        def given(last: bool) -> Iterator[pa.RecordBatch]:
            rows, held = [], 0
            for row in stream.windows(last):
                rows.append(row)
                held += len(row[3])
                if held >= OUTPUT_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0), texts_of(batch)):
                own = words_of(text) if text else []
                stream.add(doc_id.as_py(), b"".join(map(words.__getitem__, own)) + end)
                if stream.held >= block_tokens:
                    yield from given(last=False)
        if kind is not None:
            yield from given(last=True)

    return narrow.mapInArrow(
        tidy(run),
        f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
