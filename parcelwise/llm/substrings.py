"""Repeated lines, paragraphs and passages: what an earlier place of the corpus has already goes, all but the earliest occurrence.

Lines and paragraphs are normalised (white space, A-Z) and hashed, those of less than ``min_words`` words together with the
lines after them; equal digests are grouped over the corpus. A unit depends only on the text from its start on, and is found as a
whole or not at all (sentences can be units too). What is repeated inside of units, or across them, is left to ``passage``.

``passage`` looks at every run of ``min_words`` words, wherever it begins or ends: a word goes where
such a run around it stands earlier. Posting every run would cost a row a word, so texts are cut by content first.
The runs of a text that share their least short word window (``f``; the rightmost of equals) are a stretch, and
a stretch is posted as (``f``, digest of its words ``g``). Equal runs have equal ``f``, so

* a stretch whose (f, g) stands earlier is repeated as a whole;
* only where one ``f`` has several ``g`` can stretches share some runs and not others: there the first text of
  each (f, g) posts its runs one by one. So a passage is followed word by word to its ends, and only there.

Occurrences rank by id, then by place. Within a text later occurrences are known at once. Between texts the least id of
each digest is found by an aggregate with map-side combine; only digests of several texts are joined back. No
group is collected: a digest that a third of all texts has is one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.neardup import Work
from parcelwise.llm.words import mixed, tidy, windows

MIN_WORDS = 25
UNITS = ("line", "paragraph", "passage")
#: Base of the rolling hashes, odd so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C17
_SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTES = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64, endpoint=False)

#: What lies between two units.
_GAPS = {
    "sentence": re.compile(r"(?<=[.!?])\s+|\s*\n\s*"),
    "line": re.compile(r"\s*\n\s*"),
    "paragraph": re.compile(r"\s*\n\s*\n\s*"),
}


def parts(text: str, unit: str) -> list[tuple[int, int, bytes, int]]:
    """(start, end, normalised words, number of words) of every part that has a word."""
    found, start = [], 0
    ends = [(m.start(), m.end()) for m in _GAPS[unit].finditer(text)] + [(len(text), len(text))]
    for end, after in ends:
        words = text[start:end].lower().encode().split()
        if words:
            found.append((start, end, b" ".join(words), len(words)))
        start = after
    return found


def units(own: list[tuple[int, int, bytes, int]], min_words: int) -> list[tuple[int, int, bytes]]:
    """(first part, last part, digest) of every unit; parts near the end may be too few for one."""
    import xxhash

    digests = [xxhash.xxh3_128_digest(words) for _, _, words, _ in own]
    out, last, held = [], -1, 0
    for first in range(len(own)):
        while held < min_words and last + 1 < len(own):
            last += 1
            held += own[last][3]
        if held < min_words:
            break
        out.append((first, last, xxhash.xxh3_128_digest(b"".join(digests[first : last + 1]))))
        held -= own[first][3]
        if last == first:  # the next one starts behind
            held = 0
    return out


def _text_units(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, owners, digests = [], [], []
                for k, value in enumerate(part.column(1)):
                    own = parts(value.as_py() or "", unit)
                    seen = set()
                    for first, last, digest in units(own, min_words):
                        rows.append((own[first][0], own[last][1], digest in seen))
                        seen.add(digest)
                        owners.append(k)
                        digests.append(digest)
                if not rows:
                    continue
                starts, ends, again = zip(*rows)
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    [part.column(0).take(pa.array(owners)), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(again)],
                    names=["doc_id", "h1", "h2", "start", "end", "again"],
                )

    return docs.mapInArrow(tidy(run), f"doc_id {kind}, h1 long, h2 long, start int, end int, again boolean")


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base from 0 to ``size`` - 1, and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each start and end, whatever lies before."""
    powers, inverse = _powers(1 << max(12, len(values).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[: len(values)], dtype=np.uint64)])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def _bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.concatenate([[True], _SPACES[raw], [True]])
    return np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])


def word_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash in lower case, start, end) of every word between ASCII white space; places are characters."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends = _bounds(raw)
    low = np.frombuffer(text.lower().encode(), np.uint8)
    # Lower case may have other lengths, but no white space more or less.
    hashes = _rolled(_BYTES[low], *((starts, ends) if len(low) == len(raw) and text.isascii() else _bounds(low)))
    if len(raw) > len(text):
        place = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        starts, ends = place[starts], place[ends]
    return hashes, starts, ends


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words."""
    starts = np.arange(len(words) - size + 1)
    return _rolled(words, starts, starts + size)


def stretches(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word behind the last, ``f``, ``g``) of every stretch, for at least ``min_words`` words."""
    size = max(1, min_words // 3)
    width = min_words - size + 1
    short = windows(words, size)
    least = np.lib.stride_tricks.sliding_window_view(short, width)[:, ::-1].argmin(axis=1)
    chosen = np.arange(len(least)) + width - 1 - least
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    behind = np.concatenate([first[1:], [len(least)]]) - 1 + min_words
    return first, behind, short[chosen[first]], _rolled(words, first, behind)


def _text_stretches(docs: DataFrame, min_words: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                owners, found = [], []
                for k, value in enumerate(part.column(1)):
                    words, starts, ends = word_places(value.as_py())
                    if len(words) < min_words:
                        continue
                    first, behind, f, g = stretches(words, min_words)
                    again = np.ones(len(first), bool)
                    again[np.unique(np.stack([f, g]), axis=1, return_index=True)[1]] = False
                    owners.append(np.full(len(first), k))
                    found.append((f.view(np.int64), g.view(np.int64), starts[first], ends[behind - 1], again))
                if not found:
                    continue
                f, g, start, end, again = map(np.concatenate, zip(*found))
                own = pa.array(np.concatenate(owners))
                yield pa.record_batch(
                    [part.column(0).take(own), part.column(2).take(own), pa.array(f), pa.array(g), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(again)],
                    names=["doc_id", "t", "f", "g", "start", "end", "again"],
                )

    return docs.select("doc_id", "text", "t").mapInArrow(tidy(run), f"doc_id {kind}, t long, f long, g long, start int, end int, again boolean")


def _stretch_runs(docs: DataFrame, min_words: int) -> DataFrame:
    """The runs of the stretches in ``own``, a sorted array of (start, end, f, g) beside each text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                owners, found = [], []
                for k, (text, own) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    words, starts, ends = word_places(text)
                    hashes = run_hashes(words, min_words)
                    seen = set()
                    for x in own:
                        first = int(np.searchsorted(starts, x["start"]))
                        behind = int(np.searchsorted(ends, x["end"])) + 1
                        for p in range(first, behind - min_words + 1):
                            h = hashes[p].astype(np.int64)
                            key = (x["f"], h)
                            owners.append(k)
                            found.append((x["f"], x["g"], h, starts[p], ends[p + min_words - 1], key in seen))
                            seen.add(key)
                if not found:
                    continue
                f, g, h, start, end, again = zip(*found)
                yield pa.record_batch(
                    [part.column(0).take(pa.array(owners)), *(pa.array(x, pa.int64()) for x in (f, g, h)), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(again)],
                    names=["doc_id", "f", "g", "h", "start", "end", "again"],
                )

    return docs.select("doc_id", "text", "own").mapInArrow(tidy(run), f"doc_id {kind}, f long, g long, h long, start int, end int, again boolean")


def _passages(work: Work, docs: DataFrame, min_words: int) -> DataFrame:
    """(``doc_id``, ``start``, ``end``, ``first_doc_id``) of repeated stretches and runs; they overlap."""
    docs = docs.withColumn("t", F.xxhash64("text"))  # rows that repeat an id may differ in text
    found = work.keep(_text_stretches(docs, min_words))
    by_f = found.where("NOT again").groupBy("f").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.min("g").alias("c"), F.max("g").alias("d")
    )
    shared = work.keep(by_f.where("a < b OR c < d").select("f", F.expr("c < d").alias("several")))
    held = work.keep(found.join(shared, "f"))
    least = work.keep(held.groupBy("f", "g").agg(F.min("doc_id").alias("first_doc_id")))  # so that the join can split hot keys
    held = work.keep(held.join(least, ["f", "g"]))
    firsts = held.where("several AND NOT again AND doc_id = first_doc_id")
    listed = work.keep(firsts.groupBy("doc_id", "t").agg(F.sort_array(F.collect_set(F.struct("start", "end", "f", "g"))).alias("own")))
    runs = work.keep(_stretch_runs(docs.join(listed, ["doc_id", "t"]), min_words))
    by_run = runs.groupBy("f", "h").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))
    by_run = work.keep(by_run.where("first_doc_id < last_doc_id").drop("last_doc_id"))
    later_runs = work.keep(runs.join(by_run, ["f", "h"]).where("doc_id > first_doc_id"))
    earlier = work.keep(later_runs.groupBy("f", "g").agg(F.min("first_doc_id").alias("earlier")))
    later = held.where("doc_id > first_doc_id").join(earlier, ["f", "g"], "left")
    columns = ("doc_id", "start", "end")
    return (
        later.select(*columns, F.least("first_doc_id", "earlier").alias("first_doc_id"))
        .unionByName(later_runs.select(*columns, "first_doc_id"))
        .unionByName(runs.where("again").select(*columns, F.col("doc_id").alias("first_doc_id")))
        .unionByName(found.where("again").select(*columns, F.col("doc_id").alias("first_doc_id")))
    )


def _whole_units(work: Work, docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """The same for repeated units."""
    found = work.keep(_text_units(docs, unit, min_words))
    once = found.where("NOT again")
    several = once.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))
    several = work.keep(several.where("first_doc_id < last_doc_id").drop("last_doc_id"))
    later = found.join(several, ["h1", "h2"]).where("doc_id > first_doc_id").select("doc_id", "start", "end", "first_doc_id")
    return later.unionByName(found.where("again").select("doc_id", "start", "end", F.col("doc_id").alias("first_doc_id")))


def repeated_spans(
    docs: DataFrame,
    *,
    unit: str | tuple[str, ...] = UNITS,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per span to remove: ``doc_id``, ``start``, ``end`` (characters of the original text) and
    ``first_doc_id``, the least id that has a run (or unit) of it first.

    Spans of a text neither overlap nor touch. NULL and empty texts, and texts of fewer than ``min_words`` words,
    have no span. Rows that repeat an id are the same document to the ranking: they keep what is theirs first. Rows
    with a NULL id can't be ranked and are left alone. Other columns are ignored.
    """
    work = Work(docs.sparkSession)
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    kinds = (unit,) if isinstance(unit, str) else unit
    later = [_passages(work, narrow, min_words) if kind == "passage" else _whole_units(work, narrow, kind, min_words) for kind in kinds]
    later = reduce(DataFrame.unionByName, later)
    # Spans that overlap or touch become one: a new one begins behind all ends before it.
    in_order = Window.partitionBy("doc_id").orderBy("start", "end")
    behind = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(behind.isNull() | (F.col("start") > behind + 1), 1).otherwise(0)
    numbered = later.withColumn("_begins", begins)
    numbered = numbered.withColumn("_span", F.sum("_begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy("doc_id", "_span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_doc_id").alias("first_doc_id"))
    return merged.select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "first_doc_id")


def remove_spans(docs: DataFrame, spans: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of the text, and ``kept_spans``: the (start, end) of what stays.

    All rows and columns stay; a text without spans is unchanged. What stays is joined as it is. A column of the
    documents that is called ``kept_spans`` already stays, and there is no other.
    """
    taken = {c.lower() for c in docs.columns}
    free = lambda name: name if name not in taken else free("_" + name)
    doc, cut_at = free("_doc"), free("_cuts")
    by_doc = spans.groupBy(F.col("doc_id").alias(doc)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cut_at))
    joined = docs.join(by_doc, docs[id_col] == by_doc[doc], "left")
    text = docs[text_col]
    cuts = F.coalesce(cut_at, F.array().cast("array<struct<start:bigint,end:bigint>>"))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda x: x["end"]))
    ends = F.concat(F.transform(cuts, lambda x: x["start"]), F.array(F.char_length(text).cast("long")))
    kept = F.filter(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda x: x["start"] < x["end"])
    piece = lambda x: F.substring(text, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))
    cut = F.when(F.col(cut_at).isNull(), text).otherwise(F.array_join(F.transform(kept, piece), ""))
    others = [docs[c] if c != text_col else cut.alias(c) for c in docs.columns]
    report = [] if "kept_spans" in taken else [F.when(text.isNotNull(), kept).alias("kept_spans")]
    return joined.select(*others, *report)
