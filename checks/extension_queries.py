"""Queries beyond the nightly jobs: counts on the way, rings, as-of and interval joins, loads by month, sketches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bridge import view
from checks.spark_queries import crowded_listings, listings, validated_listings
from parcelwise.functions import scalars as S
from parcelwise.operators import demography as D
from parcelwise.operators import imputation as I
from parcelwise.operators import kpi as K
from parcelwise.operators import poi as N
from parcelwise.operators import quality as Q
from parcelwise.operators import rollup as U
from parcelwise.operators import star as R
from parcelwise.operators import temporal as T
from parcelwise.plans import incremental as M
from parcelwise.sources import files as X
from parcelwise.sources.observed import RowCounts, files_report, watch_rejects
from parcelwise.sources.scratch import scratch_folder, written
from parcelwise.streaming import intake

KINDS = ("view", "click", "purchase", "signup", "cart")


def observed_counts(spark, sf):
    """Rows per file as one write gives them, beside the rows that it wrote."""
    files = ["all_apartments_rent.csv", "all_apartments_sell.csv", "never.csv"]
    folder, counts = scratch_folder(spark), RowCounts()
    validated = validated_listings(spark, sf)
    X.write_rejects(watch_rejects(counts, validated, "listings", files, "source_file"), f"{folder}/rejected")
    report = files_report(counts, validated, "listings", files, "source_file")
    return report.select("source_file", "rows_ok", "rows_rejected", F.col("all_rejected").cast("int").alias("all_rejected"))


def quality_gate(spark, sf):
    """The gate's verdicts, over files that are good, empty, without a column, and wholly rejected."""
    validated = Q.validate_rows(view(spark, sf, "raw_poi"), Q.POI_RULES, ["event_id"], ["source_file"])
    spoilt = validated.withColumn(Q.REASON, F.when(F.col("poi_type") == "click", "spoilt").otherwise(F.col(Q.REASON)))
    files = validated.select("source_file").distinct().select("source_file", F.lit("").alias("absent"))
    more = spark.createDataFrame([("empty.csv", ""), ("short.csv", "LAT, LON")], "source_file string, absent string")
    return Q.gate_report(Q.quality_report(spoilt), files.unionByName(more))


def read_two_headers(spark, sf):
    """Files of two column orders, one with a column more, separators and quotes inside quoted text."""
    folder = scratch_folder(spark)
    rows = view(spark, sf, "raw_poi").select("event_id", "poi_type", F.concat("Name", F.lit(';"x" ')).alias("Name"), "LAT", "Street")
    writer = lambda df: df.write.option("header", True).option("sep", ";").option("escape", '"').mode("overwrite")
    writer(rows.where("event_id % 2 = 0").select("LAT", "Name", "poi_type", "event_id")).csv(f"{folder}/even.csv")
    writer(rows.where("event_id % 2 = 1").select("event_id", "Street", "Name", "LAT", "poi_type")).csv(f"{folder}/odd.csv")
    back = X.read_delimited(spark, f"{folder}/*.csv", sep=";")
    return back.select(F.col("event_id").cast("long").alias("event_id"), "poi_type", "Name", "LAT", "Street")


def idw_hot_cell(spark, sf):
    from parcelwise.operators.staging import DISTANCE_COLUMNS

    return I.idw_impute(crowded_listings(spark, sf)).select("row_key", *DISTANCE_COLUMNS)


def staged_poi(spark, sf) -> DataFrame:
    from parcelwise.operators.staging import stage_poi

    return stage_poi(view(spark, sf, "raw_poi"))


def nearest_poi(spark, sf):
    """Every place's nearest point of every kind; some places are moved far out, many into one small cell."""
    places = crowded_listings(spark, sf).withColumn("latitude", F.expr("CASE WHEN seq % 977 = 0 THEN latitude + 20 ELSE latitude END"))
    near = N.nearest_poi(places, staged_poi(spark, sf), KINDS)
    rounded = near.select("latitude", "longitude", "poi_type", F.round("dist", 6).alias("dist"), "near.name", "near.street", "near.number")
    rows = places.select("row_key", "latitude", "longitude")
    return rows.join(rounded, ["latitude", "longitude"]).select("row_key", "poi_type", "dist", "name", "street", "number")


def poi_distances(spark, sf):
    """The infrastructure dimension with its distances to points of interest."""
    names = {"busstopdistance": "view", "caffedistance": "click", "parkingdistance": "purchase"}
    rows = N.with_poi_distances(listings(spark, sf), staged_poi(spark, sf), names)
    columns = ["busstopDistance", "caffeDistance", "parkingDistance"]
    dimension = R.dim_infrastructure(R.with_row_id(rows, ["row_key"]))
    return dimension.select("ID_Infrastruktury", "source_id", *[F.round(c, 6).alias(c) for c in columns])


def asof_demography(spark, sf):
    people = D.merge_demography(view(spark, sf, "demography")).withColumn("c", S.normalize_city("glowne_miasto"))
    rows = listings(spark, sf).withColumn("c", S.normalize_city("city"))
    values = ["populacja_ogolna", "przecietne_wynagrodzenie_brutto"]
    found = T.asof_join(rows, people, ["c"], "source_date", "data", values)
    return found.select("row_key", F.col("as_of").cast("string").alias("as_of"), *values)


def snapshot_changes(spark, sf):
    """Every month against the one before: offers new, gone or changed, repeated ones counted."""
    rows = listings(spark, sf).select("source_date", "id", "listing_type", "rooms", "buildyear", "condition")
    before = rows.withColumn("source_date", F.add_months("source_date", 1))
    found = T.snapshot_diff(before, rows, ["source_date", "id", "listing_type"], ["rooms", "buildyear", "condition"])
    return found.withColumn("source_date", F.col("source_date").cast("string"))


def incremental_load(spark, sf):
    """Three slices of months, loaded out of order, one of them wrong at first and then again."""
    folder, rows = scratch_folder(spark), listings(spark, sf)
    early, middle, late = (rows.where(w) for w in ("year(source_date) < 1997", "year(source_date) IN (1997, 1998)", "year(source_date) > 1998"))
    wrong = middle.withColumn("price", F.col("price") * 2).where("rooms IS NOT NULL")
    for part in (late, wrong, early, middle):
        M.load_months(part, folder, ["row_key"])
    facts = M.read_facts(spark, folder)
    return facts.select("row_key", "source_date", F.round("price_deviation", 4).alias("price_deviation"), "location_premium")


def stream_intake(spark, sf):
    """Monthly files in two deliveries, the second of which repeats the first; the stream starts again in between."""
    folder = scratch_folder(spark)
    rows = listings(spark, sf).select("row_key", "id", "price", "rooms", "listing_type", "source_date")
    stem = F.concat(F.lit("apartments_"), F.when(F.col("listing_type") == "rent", "rent_pl_").otherwise("pl_"))
    named = rows.withColumn("file", F.concat(stem, F.date_format("source_date", "yyyy_MM"), F.lit(".csv")))
    columns = ["row_key", "id", "price", "rooms"]
    for k, part in enumerate(("year(source_date) <= 1997", "year(source_date) >= 1997")):
        own = named.where(part).select(*columns, "file").hint("rebalance", "file")
        own.write.mode("overwrite").partitionBy("file").option("header", True).csv(f"{folder}/incoming/{k}")
        stream = intake.monthly_stream(spark, f"{folder}/incoming", columns)
        intake.take_in(stream, f"{folder}/table", f"{folder}/checkpoint", ["row_key", "listing_type", "source_date"], late="4000 days")
    back = spark.read.parquet(f"{folder}/table")
    return back.select("row_key", "id", F.col("price").cast("double").alias("price"), "rooms", "source_date", "listing_type")


def rollup_prices(spark, sf):
    rows = K.with_price_per_sqm(listings(spark, sf)).withColumn("source_date", F.col("source_date").cast("string"))
    sets = [["city", "type"], ["city", "listing_type"], ["listing_type", "source_date"], ["city"], ["rooms"], []]
    found = U.rollup_measures(rows, ["city", "type", "listing_type", "source_date", "rooms"], sets)
    return found.withColumn("mean", F.round("mean", 4))


def interval_periods(spark, sf):
    """Periods in which an offer was listed with the years of its city's demography that they touch."""
    offers = listings(spark, sf).groupBy("id", "listing_type", S.normalize_city("city").alias("c")).agg(
        F.min("source_date").alias("first_day"), F.last_day(F.max("source_date")).alias("last_day")
    )
    years = D.merge_demography(view(spark, sf, "demography")).select(
        S.normalize_city("glowne_miasto").alias("c"), F.trunc(F.col("data").cast("date"), "year").alias("begins"), F.col("data").cast("date").alias("ends"), "populacja_ogolna"
    )
    pairs = T.interval_join(offers, years, ["c"], ("first_day", "last_day"), ("begins", "ends"))
    return pairs.select("id", "listing_type", "c", F.year("ends").alias("year"), "populacja_ogolna")


def approx_city_median(spark, sf):
    """Approximate medians, told by their exact ranks: whether each is within the stated error."""
    rows = listings(spark, sf)
    found = written(U.approx_city_median(rows, "centredistance"), scratch_folder(spark))
    ranks = U.rank_of(rows, ["city"], "centredistance", found, "median")
    slack = F.lit(U.RANK_ERROR) * F.col("n") + 1
    within = (F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)
    return ranks.select("city", "n", within.cast("int").alias("within_error"))


def distinct_listings(spark, sf):
    """Distinct offers per city over two spans from stored monthly sketches, told by whether they are within the error."""
    rows = listings(spark, sf)
    sketches = written(U.distinct_sketches(rows, ["city", "source_date"], "id"), scratch_folder(spark))
    out = []
    for first, last in (("1990-01-01", "2009-12-31"), ("1997-01-01", "1997-12-31")):
        estimated = U.distinct_in_span(sketches, ["city"], "source_date", first, last)
        exact = rows.where(F.col("source_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        exact = exact.groupBy("city").agg(F.count_distinct("id").alias("n"))
        near = F.abs(F.col("items") - F.col("n")) <= F.lit(U.COUNT_ERROR) * F.col("n") + 1
        out.append(estimated.join(exact, "city").select("city", F.lit(first).alias("first_day"), "n", near.cast("int").alias("within_error")))
    return out[0].unionByName(out[1])


def sorted_demography(spark, sf):
    folder = scratch_folder(spark)
    people = D.merge_demography(view(spark, sf, "demography")).select("glowne_miasto", "data", "populacja_ogolna")
    X.write_sorted(people, f"{folder}/people", ["glowne_miasto", "data"], 5)
    return X.read_sorted(spark, f"{folder}/people").select("place", "glowne_miasto", "data", "populacja_ogolna")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        observed_counts, quality_gate, read_two_headers, idw_hot_cell, nearest_poi, poi_distances, asof_demography,
        snapshot_changes, incremental_load, stream_intake, rollup_prices, interval_periods, approx_city_median,
        distinct_listings, sorted_demography,
    )
}
