"""Finds test items in texts, with edits, by pigeonhole pieces and bit-parallel distance.

An item of n normalised characters may differ in k = floor(error_rate * n) edits. Cut into k + 1 pieces, at
least one piece stands unchanged wherever the item does. One automaton (Aho-Corasick) finds all pieces of all items
in one pass over a text; hits of an item on neighbouring diagonals make one window; there Myers'
bit-parallel algorithm gives the least edit distance of the item to any substring.

Texts and items are compared as words (letters and digits) in lower case with one space between. Items of up to
``block_chars`` go to all tasks at once. A larger set is a table: equal texts become one, are dealt into blocks, and
one block after the other goes to the tasks, is matched against all rows, its places written, and is let go. So the driver and
a task hold one block at a time, however many items there are; item ids are joined to the places at the end.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property, reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.neardup import Work
from parcelwise.llm.words import tidy

ERROR_RATE = 0.05
BLOCK_CHARS = 4_000_000

_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]+")


def normalised(text: str) -> str:
    """A space before and after every word, so a whole item also ends at word ends."""
    words = _GAP.sub(" ", text.lower()).strip()
    return f" {words} " if words else ""


def offsets(text: str) -> array:
    """For every character of ``normalised(text)``, the place in ``text`` it comes from."""
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow in lower case
        back = array("q", (k for k, c in enumerate(text) for _ in c.lower()))
        back.extend([len(text) - 1] * (len(lower) - len(back)))
    else:
        back = range(len(text))
    found, last = array("q"), 0
    for word in _WORD.finditer(lower):
        found.append(last)
        found.extend(back[k] for k in range(word.start(), word.end()))
        last = back[word.end() - 1] + 1
    if found:
        found.append(last)
    return found


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of about equal length, with their places in the item."""
    cuts = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """An item for Myers' algorithm; its masks are made when a text first has one of its pieces."""

    def __init__(self, item: str, budget: int):
        self.item, self.budget = item, budget

    @cached_property
    def forward(self) -> dict[str, int]:
        return self._masks(self.item)

    @cached_property
    def backward(self) -> dict[str, int]:
        return self._masks(self.item[::-1])

    @staticmethod
    def _masks(item: str) -> dict[str, int]:
        masks: dict[str, int] = {}
        for k, c in enumerate(item):
            masks[c] = masks.get(c, 0) | 1 << k
        return masks

    def _scan(self, masks: dict[str, int], text: str, anywhere: bool) -> tuple[int, int]:
        """The least distance and the length of the text up to its first end; ``anywhere``: any start."""
        m = len(self.item)
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, score = full, 0, m
        best, end = m, 0
        first = 0 if anywhere else 1
        for at, c in enumerate(text, 1):
            equal = masks.get(c, 0)
            vertical = equal | down
            horizontal = (((equal & up) + up) ^ up) | equal
            more = down | (full & ~(horizontal | up))
            less = up & horizontal
            if more & top:
                score += 1
            elif less & top:
                score -= 1
            if score < best:
                best, end = score, at
            more, less = more << 1 | first, less << 1
            up = (less | ~(vertical | more)) & full
            down = more & vertical & full
        return best, end

    def find(self, text: str) -> tuple[int, int, int] | None:
        """(distance, start, end) of the closest substring, if within the budget."""
        best, end = self._scan(self.forward, text, anywhere=True)
        if best > self.budget:
            return None
        _, length = self._scan(self.backward, text[:end][::-1], anywhere=False)
        return best, end - length, end


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        import ahocorasick

        self.items, self.patterns = [], []
        places: dict[str, list[tuple[int, int]]] = {}
        for name, text in items:
            item = normalised(text)
            if not item:
                continue
            budget = int(error_rate * len(item))
            for at, piece in pieces(item, budget):
                places.setdefault(piece, []).append((len(self.items), at))
            self.items.append(name)
            self.patterns.append(Pattern(item, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, start, end, distance) in the text, every place once."""
        plain = normalised(text)
        if not plain or not self.items:
            return []
        diagonals: dict[int, set[int]] = {}
        for last, (length, where) in self.automaton.iter(plain):
            start = last + 1 - length
            for number, at in where:
                diagonals.setdefault(number, set()).add(start - at)
        found: dict[tuple, int] = {}
        for number, own in diagonals.items():
            pattern = self.patterns[number]
            k, n = pattern.budget, len(pattern.item)
            ordered = sorted(own)
            group = [ordered[0]]
            for d in [*ordered[1:], None]:
                if d is not None and d - group[-1] <= k:
                    group.append(d)
                    continue
                exact = [x for x in group if x >= 0 and plain.startswith(pattern.item, x)]
                for x in exact:
                    found[number, x, x + n] = 0
                if not exact:
                    begin = max(0, group[0] - k)
                    hit = pattern.find(plain[begin : group[-1] + n + k])
                    if hit:
                        found[number, begin + hit[1], begin + hit[2]] = hit[0]
                group = [d]
        if not found:
            return []
        back = offsets(text)
        return [(self.items[i], back[s + 1] if plain[s] == " " else back[s], back[e - 1] + (plain[e - 1] != " "), d) for (i, s, e), d in found.items()]


def _places(narrow: DataFrame, items: Broadcast, item_type: str, error_rate: float) -> DataFrame:
    """Places of the items, (name, text) each, in ``doc_id``, ``text``."""
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, error_rate)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                rows += [(doc_id.as_py(), *hit) for hit in matcher.find(text.as_py())]
            if rows:
                columns = list(zip(*rows))
                types = [batch.schema.field(0).type, None, pa.int64(), pa.int64(), pa.int64()]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "item_id", "start", "end", "distance"]
                )

    return narrow.mapInArrow(tidy(run), f"doc_id {id_type}, item_id {item_type}, start long, end long, distance long")


def _chars(items: DataFrame) -> int:
    return items.agg(F.sum(F.char_length("text"))).first()[0] or 0


def find_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per place where a text has an item: ``doc_id``, ``item_id``, ``start``, ``end``, ``distance``.

    Places are characters of the original text. An item without words, and a NULL text on either side, match
    nothing. Repeated rows and items are matched each; a NULL id stays NULL. Empty tables give no row;
    other columns are ignored. Nothing is shuffled but the items and, with more than one block of them, the places. With more
    than one block the search runs when this is called. A very long text takes memory for itself and 8 bytes a character.
    """
    spark = docs.sparkSession
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).where("text IS NOT NULL")
    wanted = items.select(items[item_col].alias("item_id"), items[item_text_col].alias("text")).where("text IS NOT NULL")

    def shared(rows: DataFrame) -> Broadcast:
        return spark.sparkContext.broadcast([tuple(r) for r in rows.toLocalIterator()])  # about block_chars characters

    if _chars(wanted) <= block_chars:
        return _places(narrow, shared(wanted), wanted.schema["item_id"].dataType.simpleString(), error_rate)

    work = Work(spark)
    named = work.keep(wanted.withColumn("key", F.md5("text")))
    once = work.keep(named.groupBy("key").agg(F.any_value("text").alias("text")))
    blocks = min(once.count(), -(-_chars(once) // block_chars))
    # Sorted by block, so that reading one of them skips the others.
    dealt = work.keep(once.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).sort("block"))
    found = []
    for k in range(blocks):
        block = shared(dealt.where(F.col("block") == k).select("key", "text"))
        found.append(work.keep(_places(narrow, block, "string", error_rate)))
        block.destroy()
    places = reduce(DataFrame.unionByName, found).withColumnRenamed("item_id", "key")
    return places.join(named.select("key", "item_id"), "key").select("doc_id", "item_id", "start", "end", "distance")
