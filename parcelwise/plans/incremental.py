"""Months into a star that exists already: what a month delivers replaces that month, and nothing else is read or written.

Keys are digests of a row's natural key, so they don't change between loads, and loads in any order, or all at once, give
the same tables. Means and premiums depend on all months, so they aren't stored with the facts: every month stores its sums
and counts, a few rows, and the measures are made from those when facts are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.scalars import normalize_city
from parcelwise.operators.kpi import COMPARABLE, POI_CUT, RENT, SELL, with_price_per_sqm
from parcelwise.operators.star import LISTING_KEY
from parcelwise.sources.observed import RowCounts
from parcelwise.sources.scratch import dropped, scratch_folder, shuffles_freed, written

FACTS, PARTS = "offers", "price_parts"
MONTH = "source_date"
_SIDE = "poi_side"
#: Rows dealt to their months at a time, or an eighth of the load if that is more: so much is shuffled at once.
TURN_ROWS = 4_000_000


def stable_key(*columns: str) -> Column:
    """A key that depends on the natural key alone: 128 bits as text."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\u001f", *parts).cast("binary"))


def load_months(listings: DataFrame, folder: str, keys: Sequence[str] = LISTING_KEY) -> None:
    """Write the months that ``listings`` holds into the star under ``folder``, replacing them there if they stand already.

    A month is one partition of each table, written as a whole (dynamic partition overwrite), so a load can be repeated after
    a failure. Rows without a month can't be loaded and are left out; an empty frame changes nothing. Months are dealt to tasks by a
    rebalancing shuffle: few files a month, and a month that is too large for a task is split. ``listings`` is computed once, into a
    table that goes when the load ends; months are dealt from it, a few at a time, so that only their shuffle lies on disk. The
    sums are made from the facts as written.
    """
    rows = with_price_per_sqm(listings).where(F.col(MONTH).isNotNull())
    rows = rows.withColumns({MONTH: F.col(MONTH).cast("string"), "offer_key": stable_key(*keys), "city_norm": normalize_city("city")})
    side = F.when(F.col("poicount") > POI_CUT, "high").when(F.col("poicount") <= POI_CUT, "low")
    counts, rows, staged = RowCounts(), rows.withColumn(_SIDE, side), scratch_folder(listings.sparkSession)
    staged_rows = written(counts.watch(rows, FACTS), staged)
    # As many as the load has, each a partition of the table.
    sizes = [] if not counts.of(FACTS)["rows"] else sorted(map(tuple, staged_rows.groupBy(MONTH).count().collect()))
    for months in _in_turns(sizes, max(TURN_ROWS, counts.of(FACTS)["rows"] / 8)):
        _write_months(staged_rows.where(F.col(MONTH).isin(months)).hint("rebalance", MONTH), f"{folder}/{FACTS}")
    months = [month for month, _ in sizes]
    facts = listings.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{FACTS}").where(F.col(MONTH).isin(months)) if months else staged_rows
    parts = facts.withColumn("_price", F.col("price_per_sqm").cast("decimal(28,12)")).where("_price IS NOT NULL")
    parts = parts.groupBy(MONTH, *COMPARABLE, _SIDE).agg(F.sum("_price").alias("total"), F.count("_price").alias("n"))
    _write_months(parts.hint("rebalance", MONTH), f"{folder}/{PARTS}")
    dropped(listings.sparkSession, staged)


def _in_turns(sizes: Sequence[tuple[str, int]], most: float) -> list[list[str]]:
    """The months in groups of about ``most`` rows; one with more is a group of its own."""
    turns, held = [], most
    for month, rows in sizes:
        if held + rows > most:
            turns.append([])
            held = 0
        turns[-1].append(month)
        held += rows
    return turns


def _write_months(df: DataFrame, path: str) -> None:
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(MONTH).parquet(path)


def read_facts(spark: SparkSession, folder: str) -> DataFrame:
    """All facts with ``price_deviation`` (from the mean of comparable offers of all months) and ``location_premium`` of their kind."""
    facts = spark.read.parquet(f"{folder}/{FACTS}").withColumn(MONTH, F.col(MONTH).cast("string"))
    parts = spark.read.parquet(f"{folder}/{PARTS}")
    means = parts.groupBy(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(COMPARABLE)]).agg((F.sum("total").cast("double") / F.sum("n")).alias("_mean"))
    means = written(means, scratch_folder(spark))  # Spark knows their size then, and shuffles the facts only where they don't fit a task
    of_side = lambda side: F.coalesce(
        F.sum(F.when(F.col(_SIDE) == side, F.col("total"))).cast("double") / F.sum(F.when(F.col(_SIDE) == side, F.col("n"))), F.lit(0.0)
    )
    premiums = parts.where(F.col("listing_type").isin(SELL, RENT)).groupBy(F.col("listing_type").alias("_kind"))
    premiums = premiums.agg(F.round(of_side("high") - of_side("low"), 2).alias("_premium"))  # two rows at most
    joined = facts.join(means, [F.col(c) == F.col(f"_g{k}") for k, c in enumerate(COMPARABLE)], "left")
    kind = F.when(F.col("listing_type") == SELL, SELL).otherwise(RENT)
    joined = joined.join(F.broadcast(premiums), kind == F.col("_kind"), "left")
    deviation = F.when(F.col("_mean") > 0, (F.col("price_per_sqm") - F.col("_mean")) / F.col("_mean"))
    return joined.select(*facts.columns, deviation.alias("price_deviation"), F.coalesce("_premium", F.lit(0.0)).alias("location_premium"))
