"""Joins over time and differences between snapshots.

* ``asof_join``: every row with the latest state of its key at or before its time.
* ``interval_join``: pairs of periods of one key that have a day in common.
* ``snapshot_diff``: what is new, gone or changed between two states of a table.

None of them sorts the rows of a key in one task: a key with a third of all rows costs a shuffle by (key, time), which
Spark can split, and small tables of states, bins or counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_number(time: Column) -> Column:
    """Months since year 0: the time bucket of the as-of join and the bin of the interval join."""
    return F.year(time) * 12 + F.month(time) - 1


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    matched_time: str = "as_of",
) -> DataFrame:
    """``left`` with the ``values`` of the latest right row of the same ``by`` at or before its time.

    Time is cut into months. The states of a key inside a month (one per date) are an array, and the last state
    before it is carried over the months by a window that sees states only. Left rows meet one such row by equality on key and month,
    whatever their number: no left row is sorted, and a crowded key and month is a join partition that Spark can split.

    ``matched_time`` is the date of the state, NULL with the values where there is none. A left row with a NULL key or time
    has none; right rows with one don't count. Of several right rows at one date the greatest by ``values`` counts (NULL least).
    All left rows stay, repeated ones too; times are dates.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    states = (
        right.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(right_time).cast("date").alias("_t"), F.struct(*values).alias("_v"))
        .dropna(subset=[*keys, "_t"])
        .groupBy(*keys, "_t")
        .agg(F.max("_v").alias("_v"))
        .withColumn("_month", month_number(F.col("_t")))
    )
    inside = states.groupBy(*keys, "_month").agg(F.sort_array(F.collect_list(F.struct("_t", "_v"))).alias("_states"))
    own = [F.col(c).alias(k) for c, k in zip(by, keys)]
    asked = left.select(*own, month_number(F.col(left_time).cast("date")).alias("_month")).dropna().distinct()
    before = Window.partitionBy(*keys).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    grid = (
        asked.withColumn("_asked", F.lit(True))
        .join(inside, [*keys, "_month"], "full")
        .withColumn("_carried", F.last(F.element_at("_states", -1), ignorenulls=True).over(before))
        .where("_asked")
        .drop("_asked")
    )
    row = F.col("_left")  # the left columns are kept apart from the names used here
    time = row[left_time].cast("date")
    same = [row[c] == F.col(k) for c, k in zip(by, keys)] + [month_number(time) == F.col("_month")]
    joined = left.select(F.struct(*left.columns).alias("_left")).join(grid, same, "left")
    here = F.filter(F.coalesce("_states", F.array().cast(grid.schema["_states"].dataType)), lambda s: s["_t"] <= time)
    state = F.coalesce(F.when(F.size(here) > 0, F.element_at(here, -1)), F.col("_carried"))
    out = joined.select("_left", state.alias("_state"))
    return out.select(
        *[row[c].alias(c) for c in left.columns], F.col("_state._t").alias(matched_time), *[F.col("_state._v")[c].alias(c) for c in values]
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_period: tuple[str, str],
    right_period: tuple[str, str],
    fine_months: int = 3,
    coarse_months: int = 48,
    longest: int = 8,
) -> DataFrame:
    """Pairs of left and right rows of one key whose periods (first and last day, both included) have a day in common.

    Periods are posted under the bins of time that they touch. One that would touch more than ``longest`` fine bins is posted under
    coarse ones only, so a posting list stays short; short periods are posted at both levels, and a pair is looked for at the coarse
    level if either is long. Each pair is kept at its first common bin alone, so nothing has to be made distinct.

    The right columns carry the prefix ``right_`` where the left has the name already. Rows with a NULL key or a period that has no first or last day, or
    ends before it begins, join nothing.
    """
    renamed = {c: f"right_{c}" if c in left.columns else c for c in right.columns}
    begin, end = F.col(left_period[0]).cast("date"), F.col(left_period[1]).cast("date")

    def posted(df: DataFrame, first: Column, last: Column) -> DataFrame:
        bins = lambda width: (F.floor(month_number(first) / width), F.floor(month_number(last) / width))
        fine, coarse = bins(fine_months), bins(coarse_months)
        long = fine[1] - fine[0] >= longest
        at = lambda level, of: F.transform(F.sequence(*of), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin")))
        level = F.concat(F.when(long, F.array().cast("array<struct<level:int,bin:bigint>>")).otherwise(at(0, fine)), at(1, coarse))
        sound = df.where(first <= last)
        return sound.withColumns({"_first": first, "_last": last, "_long": long}).withColumn("_at", F.explode(level))

    mine = posted(left, begin, end)
    other = right.select(*[F.col(c).alias(renamed[c]) for c in right.columns])
    theirs = posted(other, F.col(renamed[right_period[0]]).cast("date"), F.col(renamed[right_period[1]]).cast("date"))
    theirs = theirs.withColumnsRenamed({"_first": "_rfirst", "_last": "_rlast", "_long": "_rlong", "_at": "_rat"})
    same = [mine[c] == theirs[renamed[c]] for c in by] + [F.col("_at") == F.col("_rat")]
    later = F.greatest("_first", "_rfirst")
    width = F.when(F.col("_at.level") == 0, fine_months).otherwise(coarse_months)
    wanted = (F.col("_at.level") == F.when(F.col("_long") | F.col("_rlong"), 1).otherwise(0)) & (F.col("_first") <= F.col("_rlast")) & (
        F.col("_rfirst") <= F.col("_last")
    )
    first_common = F.col("_at.bin") == F.floor(month_number(later) / width)
    pairs = mine.join(theirs, same).where(wanted & first_common)
    return pairs.select(*left.columns, *[F.col(renamed[c]) for c in right.columns if renamed[c] not in {f"right_{k}" for k in by}])


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of columns that tells NULL from text and where each value ends."""
    part = lambda c: F.coalesce(F.concat(F.char_length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.sha2(F.concat_ws(",", *[part(c) for c in columns]), 256)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key that isn't the same in both: ``change`` (``new``, ``gone`` or ``changed``), ``rows_old``, ``rows_new``, ``rows_same``.

    Rows are alike if all ``columns`` are, NULL equal to NULL; only digests travel. Repeated rows count: a key whose row stands twice in one
    and once in the other has changed. NULL keys equal each other. Counts are combined before the shuffle, so a key
    with very many rows is no more than its different rows per task.
    """
    side = lambda df, n_old, n_new: df.select(*keys, row_digest(columns).alias("_d"), F.lit(n_old).alias("_o"), F.lit(n_new).alias("_n"))
    both = side(old, 1, 0).unionByName(side(new, 0, 1))
    per_row = both.groupBy(*keys, "_d").agg(F.sum("_o").alias("_o"), F.sum("_n").alias("_n"))
    per_key = per_row.groupBy(*keys).agg(
        F.sum("_o").alias("rows_old"), F.sum("_n").alias("rows_new"), F.sum(F.least("_o", "_n")).alias("rows_same")
    )
    change = F.when(F.col("rows_old") == 0, "new").when(F.col("rows_new") == 0, "gone").otherwise("changed")
    unlike = (F.col("rows_old") != F.col("rows_new")) | (F.col("rows_same") != F.col("rows_new"))
    return per_key.where(unlike).select(*keys, change.alias("change"), "rows_old", "rows_new", "rows_same")


def without(df: DataFrame, others: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` that none of ``others`` has, by NULL-safe digests of ``columns``."""
    gone = reduce(DataFrame.union, [o.select(row_digest(columns).alias("_digest")) for o in others]).distinct()
    return df.join(gone, row_digest(columns) == F.col("_digest"), "left_anti")
