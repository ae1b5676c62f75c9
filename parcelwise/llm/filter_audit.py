"""How filters act in every order: who removes what, what would be removed anyway, and what is lost.

A document's result under all filters is a mask with a bit per filter that it fails. The counts of masks, at most 32 per
part for five filters, say everything about every order. Four filters look at one text; the fifth fails texts that a
smaller id has too, anywhere in the table. Those are found with radix tries:

1. Every task puts its texts into a compressed trie whose terminals hold the least id. A copy that meets a smaller id
   is settled at once; one text per trie goes on, so a text that very many documents share is sent once per trie.
2. Prefixes adapt: one that more bytes share than a cell may hold is lengthened until it doesn't, or until one text is
   left. Texts are range-partitioned and sorted by them, so all copies of a text lie in one cell.
3. Full texts of a cell go into one trie, again with the least id at the terminals; what stands there in the end is no
   duplicate. A task holds one cell at a time, and one copy of each of its texts.

Only ids, parts and masks go on from there, to the labels and into the counts.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.words import texts as texts_of
from parcelwise.llm.words import tidy
from parcelwise.sources.scratch import scratch_folder, written

#: Bytes of distinct texts in a task's trie before it is written out.
TRIE_BYTES = 32 << 20
#: Bytes of texts that may share a prefix, and prefixes that may be lengthened at a time (their hashes are broadcast).
CELL_BYTES = 32 << 20
LEAST_CELL = 1 << 20
MOST_HOT = 1_000_000
RANGE_BYTES = 48 << 20
MOST_RANGES = 100_000
PREFIX, LONGER = 8, 4
BATCH_BYTES = 4 << 20

_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(128, 192))
_SYMBOL = re.compile(rb"[#$%&*|]")
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_CHUNK = 1 << 20


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a stretch of a long one at a time."""
    at = 0
    while at < len(text):
        white = _WHITE.search(text, at + _CHUNK) if len(text) - at > _CHUNK else None
        end = white.start() if white else len(text)
        yield text[at:end].split()
        at = end


def failed(text: bytes) -> int:
    """Bits 1, 2, 4, 8: under 50 words; under 65 % distinct words; over 5 % capitals; one of ``#$%&*|``."""
    n, distinct = 0, set()
    for words in _word_lists(text):
        n += len(words)
        distinct.update(words)
    chars = len(text.translate(None, _CONTINUED))
    capitals = len(text) - len(text.translate(None, _UPPER))
    return (
        (n < 50)
        | (100 * len(distinct) < 65 * n) << 1
        | (100 * capitals > 5 * chars) << 2
        | (_SYMBOL.search(text) is not None) << 3
    )


class Node:
    __slots__ = ("edges", "least", "at_least", "mask")

    def __init__(self):
        self.edges: dict[int, list] = {}  # first byte: [label, node]
        self.least = None  # a terminal's least id, as ``_rank`` orders them
        self.at_least: Counter | None = None  # rows of the least id by part
        self.mask = 0


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common start of ``a`` and ``b[at:]``, which differ somewhere."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie: edges carry the bytes that only one child continues with."""

    def __init__(self):
        self.root = Node()

    def find(self, text: bytes) -> Node:
        """The node where the text ends, made if it isn't there."""
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = Node()
                node.edges[text[at]] = [text[at:], leaf]
                return leaf
            label, below = edge
            if text.startswith(label, at):
                node, at = below, at + len(label)
                continue
            same = _common(label, text, at)
            middle = Node()
            middle.edges[label[same]] = [label[same:], below]
            edge[:] = [label[:same], middle]
            node, at = middle, at + same
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """Every text with its terminal."""
        stack = [(b"", self.root)]
        while stack:
            text, node = stack.pop()
            if node.at_least is not None:
                yield text, node
            stack.extend((text + label, below) for label, below in node.edges.values())


def _rank(doc_id: int | None) -> tuple[bool, int]:
    """Ids in order, no id after all of them."""
    return doc_id is None, doc_id or 0


class _Out:
    """Rows on their way out; those without an id are counted instead, as no label is theirs."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes, self.nameless = schema, [], 0, Counter()

    def add(self, rank: tuple[bool, int], part: str, mask: int, copies: int, text: bytes | None = None) -> None:
        if rank[0] and text is None:
            self.nameless[part, mask] += copies
            return
        self.rows.append((None if rank[0] else rank[1], part, mask, copies, text))
        self.bytes += 50 + len(text or b"")

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        """What has gathered, if it is ``least`` bytes."""
        if self.rows and self.bytes >= least:
            columns = [list(c) for c in zip(*self.rows, strict=True)][: len(self.schema)]
            self.rows, self.bytes = [], 0
            arrays = [pa.array(c, pa.binary()).view(f.type) if f.name == "text" else pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)

    def last(self) -> Iterator[pa.RecordBatch]:
        self.rows += [(None, part, mask, n, None) for (part, mask), n in self.nameless.items()]
        self.nameless.clear()
        yield from self.batches(0)


_MASKS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("copies", pa.int64())])
_SIFTED = _MASKS.append(pa.field("text", pa.string()))


def _settle(node: Node, rank: tuple[bool, int], rows: dict, again: int, out: _Out) -> None:
    """Rows of one text and id arrive at its terminal: whoever has the greater id is a duplicate."""
    if rank == node.least:
        node.at_least.update(rows)
        return
    if rank < node.least:
        (rank, rows), (node.least, node.at_least) = (node.least, node.at_least), (rank, Counter(rows))
    for part, copies in rows.items():
        out.add(rank, part, node.mask | again, copies)


def _sift(rules: Callable[[bytes], int], again: int, trie_bytes: int):
    """Masks of all rows; of each text, the rows that no smaller id in this task settles keep it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, out = Trie(), 0, _Out(_SIFTED)

        def written_out() -> Iterator[pa.RecordBatch]:
            for text, node in trie.terminals():
                for part, copies in node.at_least.items():
                    out.add(node.least, part, node.mask, copies, text)
                yield from out.batches(BATCH_BYTES)

        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, part, text in zip(ids, parts, texts_of(batch, 2), strict=True):
                rank, text = _rank(doc_id), text or b""
                node = trie.find(text)
                if node.at_least is None:
                    node.least, node.at_least, node.mask = rank, Counter({part: 1}), rules(text)
                    held += len(text) + 500
                else:
                    _settle(node, rank, {part: 1}, again, out)
                if held > trie_bytes:
                    yield from written_out()
                    trie, held = Trie(), 0
            yield from out.batches(BATCH_BYTES)
        yield from written_out()
        yield from out.last()

    return run


def _settle_cells(again: int):
    """Rows sorted by cell: a trie for each cell, its terminals' rows are no duplicates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cell, out = Trie(), None, _Out(_MASKS)

        def finished() -> Iterator[pa.RecordBatch]:
            for _, node in trie.terminals():
                for part, copies in node.at_least.items():
                    out.add(node.least, part, node.mask, copies)
            yield from out.batches(BATCH_BYTES)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for doc_id, part, mask, copies, key, text in zip(*columns, texts_of(batch, 5), strict=True):
                if key != cell:
                    yield from finished()
                    trie, cell = Trie(), key
                node, rank = trie.find(text), _rank(doc_id)
                if node.at_least is None:
                    node.least, node.at_least, node.mask = rank, Counter({part: copies}), mask
                else:
                    _settle(node, rank, {part: copies}, again, out)
        yield from finished()
        yield from out.last()

    return run


def _left(length: int) -> Column:
    return F.substring("text", 1, length)


def _with_prefixes(rows: DataFrame, total: int, cell_bytes: int) -> DataFrame:
    """``rows`` with the column ``key``: a prefix of the text that few bytes share, or that only copies share."""
    spark, length = rows.sparkSession, PREFIX
    even = total // int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(min(cell_bytes, max(LEAST_CELL, even)), total // MOST_HOT)
    key, open_ = _left(length), rows
    while True:
        hash_ = F.xxhash64(_left(length))
        shared = open_.select(hash_.alias("_hot"), F.octet_length("text").cast("long").alias("_n"), F.xxhash64("text").alias("_h"))
        shared = shared.groupBy("_hot").agg(F.sum("_n").alias("_n"), F.min("_h").alias("_low"), F.max("_h").alias("_high"))
        hot = written(shared.where((F.col("_n") > most) & (F.col("_low") != F.col("_high"))).select("_hot"), scratch_folder(spark))
        if hot.isEmpty():
            return rows.withColumn("key", key)
        # At most total / most hashes: a million, or as many as a shuffle has partitions.
        name = f"_hot_{length}"
        rows = rows.join(F.broadcast(hot.withColumnRenamed("_hot", name)), F.xxhash64(_left(length)) == F.col(name), "left")
        open_ = rows.where(F.col(name).isNotNull())
        length *= LONGER
        key = F.when(F.col(name).isNotNull(), _left(length)).otherwise(key)


def masks(
    docs: DataFrame,
    *,
    rules: Callable[[bytes], int] = failed,
    n_rules: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    trie_bytes: int = TRIE_BYTES,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Rows by ``doc_id``, ``part``, ``mask`` and how many they are, ``copies``.

    ``rules`` gives the bits of the filters that a text fails, from its UTF-8 bytes; bit ``n_rules`` is set where a smaller
    id has the same text. NULL text counts as empty, a NULL part as the empty string. Rows without an id come after all
    ids: they duplicate any that has one, and not each other. Repeated rows duplicate what their id does. Texts are
    compared whole; one must fit a row. Other columns are ignored; an empty table gives an empty one.
    """
    spark, again = docs.sparkSession, 1 << n_rules
    narrow = docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[part_col], F.lit("")).alias("part"), docs[text_col].alias("text")
    )
    schema = "doc_id long, part string, mask int, copies long"
    sifted = written(narrow.mapInArrow(tidy(_sift(rules, again, trie_bytes)), f"{schema}, text string"), scratch_folder(spark))
    open_ = sifted.where("text IS NOT NULL")
    total = open_.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = min(MOST_RANGES, math.ceil(total / RANGE_BYTES)) or 1
    keyed = _with_prefixes(open_, total, cell_bytes).select("doc_id", "part", "mask", "copies", "key", "text")
    sorted_ = keyed.repartitionByRange(ranges, "key").sortWithinPartitions("key")
    settled = sorted_.mapInArrow(tidy(_settle_cells(again)), schema)
    return settled.unionByName(sifted.where("text IS NULL").drop("text"))


def count_masks(masked: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``part``, ``mask`` and the documents there: ``n``, ``good`` (labelled quality 1) and ``toxic`` (toxic 1).

    Several labels of a document count as the greatest of each; a document without one is neither.
    """
    known = labels.where(labels[id_col].isNotNull()).groupBy(labels[id_col].cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
    joined = masked.join(known, "doc_id", "left")
    flagged = lambda flag: F.sum(F.col("copies") * F.coalesce(flag, F.lit(0)))
    return joined.groupBy("part", "mask").agg(F.sum("copies").alias("n"), flagged("_good").alias("good"), flagged("_toxic").alias("toxic"))


def _steps(letters: str) -> list[dict]:
    """Every order of the filters, step by step: the filter's bit and the bits of those before it."""
    bit, out = {c: 1 << k for k, c in enumerate(letters)}, []
    for order in permutations(letters):
        before = 0
        for step, c in enumerate(order, 1):
            out.append({"filter_order": "".join(order), "step": step, "own": bit[c], "before": before})
            before |= bit[c]
    return out


def orders(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """What every filter does at every step of every order, a row each per part.

    ``kept``, ``removed``, ``redundant`` (failing, removed before), ``unique_fails`` (failing this filter only),
    ``good_lost``, ``toxic_lost``, and ``shapley``: the filter's removed, summed over all orders.
    """
    steps = F.from_json(F.lit(json.dumps(_steps(letters))), "array<struct<filter_order:string,step:int,own:int,before:int>>")
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("_masks"))
    rows = per_part.withColumn("_at", F.explode(steps)).select("part", "_masks", "_at.*")
    own, before = F.col("own"), F.col("before")
    zero = F.lit(0).cast("long")

    def total(test: Callable[[Column], Column], value: Callable[[Column], Column] = lambda m: m["n"]) -> Column:
        return F.aggregate(F.filter("_masks", lambda m: test(m["mask"])), zero, lambda a, m: a + value(m))

    fails = lambda m: m.bitwiseAND(own) != 0
    gone = lambda m: m.bitwiseAND(before) != 0
    here = lambda m: fails(m) & ~gone(m)
    all_orders = math.factorial(len(letters))
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: ~gone(m) & ~fails(m)).alias("kept"),
        total(here).alias("removed"),
        total(lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda m: m == own).alias("unique_fails"),
        total(here, lambda m: m["good"]).alias("good_lost"),
        total(here, lambda m: m["toxic"]).alias("toxic_lost"),
        # Of the filters that a document fails each is the first in as many orders.
        total(fails, lambda m: m["n"] * F.floor(F.lit(all_orders) / F.bit_count(m["mask"]))).alias("shapley"),
    )
