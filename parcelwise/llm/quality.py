"""Quality rules as a short-circuit cascade.

Every rule looks at a few measures of a text. On a bounded sample of all rows each rule's cost (seconds a
row, its measures included) and selectivity (share of rows it rejects) are estimated; the rules
then run in falling order of rejections per second, and a row leaves at its first rejection.
Measures are computed when first asked for and at most once a row. The order changes
the work only: a row is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.words import WordHashes, texts, windows

SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
WINDOW = 8
#: Rows that the estimates of cost and selectivity are made on, about; a larger sample makes the order surer, not the verdicts.
SAMPLE_ROWS = 1000
SEED = 7


class Measures:
    """The measures of one text; NULL has none of anything."""

    def __init__(self, text: bytes | None, hashes: WordHashes):
        self.text, self.hashes = text or b"", hashes

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def n_digits(self) -> int:
        return len(self.text) - len(self.text.translate(None, DIGITS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.text.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of eight words that the text has twice or more."""
        if self.n_words <= WINDOW:
            return 0
        own = windows(self.hashes.of(self.words), WINDOW)
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        if not same.any():
            return 0
        repeated = np.zeros(len(own), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        edges = np.zeros(self.n_words + 1, np.int64)
        edges[: len(own)] += repeated
        edges[WINDOW : WINDOW + len(own)] -= repeated
        return int((np.cumsum(edges) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


#: The base rules: too short, or much of it repeated.
BASE = (
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
)
RULES = (
    *BASE,
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: 10 * m.n_dup_lines > 3 * len(m.lines)),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words),
    Rule("digits", lambda m: 10 * m.n_digits > 3 * m.word_chars),
)


def measure_rules(docs: DataFrame, rules: Sequence[Rule], text_col: str, sample_rows: int) -> dict[str, tuple[float, float]]:
    """Rule to (seconds a row, share rejected), each rule alone, over about ``sample_rows`` rows drawn from all of them.

    Every row is as likely as any other, whatever its partition, id or text, so no hot source fills the sample. Tasks measure
    their own rows, one text at a time; of each rule only sums go on, and no text reaches the driver.
    """
    n = docs.count()
    if not n or not rules:
        return {}
    drawn = docs.select(docs[text_col].alias("text")).sample(min(1.0, sample_rows / n), SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rows = WordHashes(), 0
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            rows += batch.num_rows
            for text in texts(batch, 0):
                for k, rule in enumerate(rules):
                    begin = time.perf_counter()
                    rejected[k] += bool(rule.rejects(Measures(text, hashes)))
                    seconds[k] += time.perf_counter() - begin
        if rows:
            columns = [pa.array(range(len(rules)), pa.int32()), pa.array([rows] * len(rules)), pa.array(seconds), pa.array(rejected)]
            yield pa.record_batch(columns, names=["rule", "n", "seconds", "rejected"])

    sums = drawn.mapInArrow(run, "rule int, n long, seconds double, rejected long").groupBy("rule").agg(
        (F.sum("seconds") / F.sum("n")).alias("cost"), (F.sum("rejected") / F.sum("n")).alias("share")
    )
    return {rules[r["rule"]].name: (r["cost"], r["share"]) for r in sums.collect()}


def order_rules(rules: Sequence[Rule], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first; rules that the sample doesn't tell apart keep their order."""

    def value(rule: Rule) -> float:
        seconds, rejected = measured.get(rule.name, (1.0, 0.0))
        return rejected / max(seconds, 1e-9)

    return sorted(rules, key=value, reverse=True)


def judge(
    docs: DataFrame,
    *,
    rules: Sequence[Rule] = RULES,
    report: Sequence[str] = ("n_words",),
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, the measures in ``report`` (always computed) and ``kept``.

    Words are what stands between ASCII white space. NULL text has no words, so the base rules
    reject it. Repeated rows and NULL ids are judged like others, other columns are ignored, an
    empty table gives no row. ``docs`` is counted and sampled when this is called. No shuffle but of the rules' sums; a very
    long text takes memory for its own words, one text at a time.
    """
    names = {rule.name for rule in rules}
    if len(names) < len(rules):
        raise ValueError("rule names must differ")
    ordered = order_rules(rules, measure_rules(docs, rules, text_col, sample_rows))
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            columns: list[list] = [[] for _ in report]
            kept = []
            for text in texts(batch):
                measures = Measures(text, hashes)
                kept.append(not any(rule.rejects(measures) for rule in ordered))
                for column, name in zip(columns, report):
                    column.append(getattr(measures, name))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array(kept, pa.bool_())],
                names=["doc_id", *report, "kept"],
            )

    return narrow.mapInArrow(run, ", ".join([f"doc_id {id_type}", *(f"{n} long" for n in report), "kept boolean"]))
