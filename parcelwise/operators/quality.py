"""Row validation with reasons, duplicate flags, accept/reject split and quality gates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions.scalars import is_blank, to_double

REASON = "_rejection_reason"


@dataclass(frozen=True)
class RangeCheck:
    """``reason`` is given to a row whose ``column`` is no number or lies outside the bounds."""

    column: str
    reason: str
    low: float | None = None
    high: float | None = None
    above: float | None = None

    def holds(self) -> Column:
        x = to_double(self.column)
        ok = x.isNotNull()
        if self.low is not None:
            ok = ok & (x >= self.low)
        if self.high is not None:
            ok = ok & (x <= self.high)
        if self.above is not None:
            ok = ok & (x > self.above)
        return F.coalesce(ok, F.lit(False))


@dataclass(frozen=True)
class RuleSet:
    required: tuple[str, ...]
    date_column: str | None = None
    unique_key: tuple[str, ...] = ()
    checks: tuple[RangeCheck, ...] = field(default=())


# The rules of the three sources.
LISTING_RULES = RuleSet(
    required=("source_date",),
    date_column="source_date",
    checks=(
        RangeCheck("squareMeters", "squareMeters_out_of_range", low=10, high=300),
        RangeCheck("price", "price_invalid", above=0),
    ),
)
DEMOGRAPHY_RULES = RuleSet(
    required=("Miasto_GUS", "Glowne_Miasto", "Data"),
    date_column="Data",
    unique_key=("Miasto_GUS", "Data"),
    checks=(RangeCheck("Populacja_Ogolna", "populacja_invalid", above=0),),
)
POI_RULES = RuleSet(
    required=("City", "LAT", "LON"),
    unique_key=("City", "LAT", "LON"),
    checks=(RangeCheck("LAT", "lat_invalid", low=0), RangeCheck("LON", "lon_invalid", low=0)),
)


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "is_duplicate"
) -> DataFrame:
    """Mark every row of a key but its first; NULL keys equal each other.

    ``order`` must tell all rows of a key apart. The first row per repeated key comes
    from an aggregate with map-side combine and is joined back, so one key with very
    many rows is not sorted in one task as a ranking window would do; keys that occur
    once do not enter the join.
    """
    row_order = F.struct(*order)
    firsts = (
        df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.min(row_order).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > 1)
    )
    same_key = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = df.join(firsts, same_key, "left")
    repeated = F.col("_first").isNotNull() & (row_order != F.col("_first"))
    return joined.select(*[F.col(c) for c in df.columns], repeated.alias(name))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def validate_rows(
    df: DataFrame,
    rules: RuleSet,
    order: Sequence[str] = (),
    within: Sequence[str] = (),
    reason: str = REASON,
) -> DataFrame:
    """Add the ``;``-joined reasons for rejecting each row; empty text for a good row.

    Reasons come in rule order: required fields, date, duplicate, range checks. Rules
    on columns the frame lacks are skipped. Duplicates are looked for inside ``within``
    (say, the source file), over all rows, good or bad; columns with a range check are compared
    as numbers there (``50.10`` is ``50.1``), and as text where they are none.
    """
    present = set(df.columns)
    columns = df.columns
    steps = [F.when(is_blank(c), F.lit(f"brak_{c}")) for c in rules.required if c in present]
    if rules.date_column in present:
        steps.append(F.when(is_blank(rules.date_column), F.lit("brak_daty")))
    if rules.unique_key and set(rules.unique_key) <= present:
        numbers = {check.column for check in rules.checks} & set(rules.unique_key)
        as_number = {f"_n_{c}": to_double(c) for c in numbers}
        as_text = {f"_t_{c}": F.when(to_double(c).isNull(), F.col(c)) for c in numbers}
        keys = [k for c in rules.unique_key for k in ([f"_n_{c}", f"_t_{c}"] if c in numbers else [c])]
        df = flag_duplicates(df.withColumns(as_number | as_text) if numbers else df, [*within, *keys], order, "_duplicate")
        steps.append(F.when(F.col("_duplicate"), F.lit("duplikat")))
    steps += [F.when(~check.holds(), F.lit(check.reason)) for check in rules.checks if check.column in present]
    text = F.concat_ws(";", *steps) if steps else F.lit("")
    return df.select(*columns, text.alias(reason))


def split_rejects(validated: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, rejected rows with it)."""
    good = validated.filter(F.col(reason) == "").drop(reason)
    return good, validated.filter(F.col(reason) != "")


def quality_report(validated: DataFrame, by: str = "source_file", reason: str = REASON) -> DataFrame:
    """Accepted and rejected row counts per file, with the verdict of the gate."""
    report = validated.groupBy(by).agg(
        F.count_if(F.col(reason) == "").alias("rows_ok"),
        F.count_if(F.col(reason) != "").alias("rows_rejected"),
    )
    return report.withColumn("all_rejected", F.col("rows_ok") == 0)


class QualityError(Exception):
    """A source file fails as a whole."""


def missing_columns(columns: Sequence[str], rules: RuleSet) -> list[str]:
    return [c for c in rules.required if c not in columns]


def gate_report(report: DataFrame, files: DataFrame, by: str = "source_file") -> DataFrame:
    """Per file of ``files`` (columns ``by`` and ``absent``, a text): ``rows_ok``, ``rows_rejected``, ``verdict``.

    ``report`` is that of ``quality_report``; a file without rows there is empty.
    """
    rows = files.join(report, by, "left")
    verdict = (
        F.when(F.col("absent") != "", F.concat(F.lit("columns missing: "), F.col("absent")))
        .when(F.col("rows_ok").isNull(), F.lit("empty file"))
        .when(F.col("rows_ok") == 0, F.lit("every row rejected"))
        .otherwise(F.lit("ok"))
    )
    return rows.select(
        by,
        F.coalesce("rows_ok", F.lit(0)).alias("rows_ok"),
        F.coalesce("rows_rejected", F.lit(0)).alias("rows_rejected"),
        verdict.alias("verdict"),
    )


def enforce_gate(
    report: DataFrame, files: Sequence[str], by: str = "source_file"
) -> tuple[int, int]:
    """Total (accepted, rejected) rows; an error naming every empty or wholly rejected file.

    ``report`` has one row per source file, so what comes to the driver is as small as
    the list of files it already holds.
    """
    rows = {r[by]: r for r in report.collect()}
    problems = [f"{name}: empty file" for name in files if name not in rows]
    problems += [f"{name}: every row rejected" for name in sorted(rows) if rows[name]["all_rejected"]]
    if problems:
        raise QualityError("; ".join(problems))
    return sum(r["rows_ok"] for r in rows.values()), sum(r["rows_rejected"] for r in rows.values())


def enforce_verdicts(gate: DataFrame, by: str = "source_file") -> tuple[int, int]:
    """The same for the frame of ``gate_report``: every file whose verdict isn't ok is named."""
    rows = gate.orderBy(by).collect()
    problems = [f"{r[by]}: {r['verdict']}" for r in rows if r["verdict"] != "ok"]
    if problems:
        raise QualityError("; ".join(problems))
    return sum(r["rows_ok"] for r in rows), sum(r["rows_rejected"] for r in rows)


def quality_recheck(
    df: DataFrame, area: str = "squaremeters", price: str = "price", low: float = 10, high: float = 300
) -> DataFrame:
    """Rows whose area and price are still sound after imputation."""
    return df.filter(F.col(area).cast("double").between(low, high) & (F.col(price).cast("double") > 0))


def month_gaps(df: DataFrame, month: str = "source_date") -> DataFrame:
    """Neighbouring months with nothing between them that lie more than one month apart.

    The window has no partition key, but sees distinct months only.
    """
    months = (
        df.select(F.trunc(F.col(month).try_cast("date"), "month").alias("_m"))
        .filter(F.col("_m").isNotNull())
        .distinct()
    )
    index = F.year("_m") * 12 + F.month("_m")
    in_order = Window.orderBy("_m")
    return (
        months.select(
            F.lag("_m").over(in_order).cast("string").alias("month_before"),
            F.col("_m").cast("string").alias("month_after"),
            (index - F.lag(index).over(in_order)).alias("months_apart"),
        )
        .filter(F.col("months_apart") > 1)
    )
