"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bridge import CROWDED, view
from parcelwise.sources.scratch import scratch_folder, written
from parcelwise.functions import scalars as S
from parcelwise.operators import demography as D
from parcelwise.operators import imputation as I
from parcelwise.operators import kpi as K
from parcelwise.operators import quality as Q
from parcelwise.operators import spatial as P
from parcelwise.operators import staging as G
from parcelwise.operators import star as R
from parcelwise.sources import files as X

ROW_KEY = ["row_key"]


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "listings")


def raw_listings(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "raw_listings")


def raw_listing_columns(df: DataFrame) -> DataFrame:
    return df.drop("row_key", "seq", "source_file")


def dates_as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- scalars ------------------------------------------------------------------------


def price_per_sqm(spark, sf):
    return listings(spark, sf).select(
        "row_key", "id", F.round(S.price_per_sqm("price", "squaremeters"), 2).alias("price_per_sqm")
    )


def normalize_city(spark, sf):
    polish = F.concat(F.lit(" ŁÓDŹ-Ąćęń"), F.col("city"), F.lit("Świt Żar "))
    return raw_listings(spark, sf).select(
        "row_key", S.normalize_city("city").alias("city_norm"), S.normalize_city(polish).alias("polish_norm")
    )


def missing_label(spark, sf):
    return raw_listings(spark, sf).select(
        "row_key",
        *[S.missing_label(c).alias(f"{c}_label") for c in ("city", "type", "hasElevator", "hasBalcony")],
    )


def round_num(spark, sf):
    return raw_listings(spark, sf).select(
        "row_key",
        S.round_num("squareMeters", 0).alias("area_0"),
        S.round_num("price", 1).alias("price_1"),
        S.round_num("latitude", 3).alias("latitude_3"),
    )


def to_int(spark, sf):
    return raw_listings(spark, sf).select(
        "row_key", *[S.to_int(c).alias(f"{c}_int") for c in ("rooms", "floor", "buildYear", "squareMeters")]
    )


def to_decimal(spark, sf):
    return raw_listings(spark, sf).select(
        "row_key",
        S.to_decimal("squareMeters", 10, 1).alias("area_dec"),
        S.to_decimal("price", 15, 2).alias("price_dec"),
        S.to_decimal("buildYear", 10, 2).alias("year_dec"),
    )


def parse_month(spark, sf):
    return raw_listings(spark, sf).select(
        "row_key",
        S.parse_month("source_date").cast("string").alias("month"),
        F.year(S.parse_month("source_date")).alias("year"),
        F.month(S.parse_month("source_date")).alias("month_number"),
    )


def period_end_date(spark, sf):
    return view(spark, sf, "indicator_rows").select(
        "o_orderkey", S.period_end_date("yr", "period").alias("period_end")
    )


def planar_distance(spark, sf):
    centre_lat, centre_lon = F.floor("latitude").cast("double"), F.floor("longitude").cast("double")
    return listings(spark, sf).select(
        "row_key", F.round(S.planar_distance("latitude", "longitude", centre_lat, centre_lon), 6).alias("dist")
    )


def grid_key(spark, sf):
    return listings(spark, sf).select(
        "row_key",
        S.grid_key("latitude", 0.018).alias("cell_lat"),
        S.grid_key("longitude", 0.018).alias("cell_lon"),
        S.grid_key("latitude", 0.018, 4).alias("fine_lat"),
        S.grid_key(-F.col("longitude"), 0.0009).alias("negative_lon"),
    )


# --- staging --------------------------------------------------------------------------


def conform_columns(spark, sf):
    raw = raw_listings(spark, sf)
    return G.conform_columns(
        raw.withColumnRenamed("squareMeters", "area_text"),
        ["row_key", "squaremeters", "floorcount", "busstopdistance", "city"],
        renames={"area_text": "squareMeters"},
        types={"busstopdistance": "double"},
    )


def stage_listings(spark, sf):
    return dates_as_text(G.stage_listings(raw_listing_columns(raw_listings(spark, sf))), "source_date")


def stage_demography(spark, sf):
    # Once as it is and once more for a different unit spelling that must not win.
    raw = view(spark, sf, "demography").drop("yr")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    again = text.withColumn("populacja_mezczyzni", F.lit("7")).withColumn("_file", F.lit(2))
    return G.stage_demography(text.withColumn("_file", F.lit(1)).unionByName(again), ["_file"])


def stage_poi(spark, sf):
    return G.stage_poi(view(spark, sf, "raw_poi"))


# --- quality ----------------------------------------------------------------------------


def validated_listings(spark, sf) -> DataFrame:
    return Q.validate_rows(raw_listings(spark, sf), Q.LISTING_RULES)


def validated_poi(spark, sf) -> DataFrame:
    return Q.validate_rows(view(spark, sf, "raw_poi"), Q.POI_RULES, ["event_id"], ["source_file"])


def validate_rows(spark, sf):
    return validated_listings(spark, sf).select("row_key", "squareMeters", "price", "source_date", Q.REASON)


def validate_poi(spark, sf):
    return validated_poi(spark, sf).select("event_id", "City", "LAT", "LON", Q.REASON)


def flag_duplicates(spark, sf):
    return Q.flag_duplicates(
        listings(spark, sf), ["id", "listing_type", "rooms"], ["source_date", "row_key"]
    ).select("row_key", F.col("is_duplicate").cast("int").alias("is_duplicate"))


def split_rejects(spark, sf):
    good, bad = Q.split_rejects(validated_listings(spark, sf))
    return good.select("row_key", F.lit(1).alias("accepted")).unionByName(
        bad.select("row_key", F.lit(0).alias("accepted"))
    )


def quality_report(spark, sf):
    report = Q.quality_report(validated_poi(spark, sf))
    return report.withColumn("all_rejected", F.col("all_rejected").cast("int"))


def dedup_keep_first(spark, sf):
    rows = listings(spark, sf).select("id", "listing_type", "row_key", "source_date", "price", "rooms")
    return dates_as_text(Q.dedup_keep_first(rows, ["id", "listing_type"], ["source_date", "row_key"]), "source_date")


def quality_recheck(spark, sf):
    return Q.quality_recheck(listings(spark, sf)).select("row_key", "squaremeters", "price")


def month_gaps(spark, sf):
    # Months moved apart by their quarter, as the table itself has no gaps.
    moved = F.add_months("source_date", F.quarter("source_date") * 2)
    return Q.month_gaps(listings(spark, sf).select(moved.alias("source_date")))


# --- sources and sinks ----------------------------------------------------------------------


def read_delimited(spark, sf):
    folder = scratch_folder(spark)
    raw = view(spark, sf, "raw_poi").drop("source_file")
    raw.write.option("header", True).option("sep", ";").mode("overwrite").csv(f"{folder}/poi")
    return X.read_delimited(spark, f"{folder}/poi/*.csv", sep=";", columns=raw.columns)


def union_tagged(spark, sf):
    rows = listings(spark, sf)
    sell = rows.filter("listing_type = 'sell'").select("row_key", "price", "rooms")
    rent = rows.filter("listing_type = 'rent'").select("price", "row_key", "buildyear")
    return X.union_tagged({"sell": sell, "rent": rent}, "kind")


def tag_from_filename(spark, sf):
    rows = listings(spark, sf)
    stem = F.when(F.col("listing_type") == "rent", F.lit("Apartments_RENT_pl_")).otherwise(F.lit("apartments_pl_"))
    name = F.when(F.col("rooms").isNull(), F.concat(stem, F.lit("latest.csv"))).otherwise(
        F.concat(stem, F.date_format("source_date", "yyyy_MM"), F.lit(".csv"))
    )
    return X.tag_from_filename(rows.select("row_key", name.alias("file")), "file")


def write_star(spark, sf):
    folder = scratch_folder(spark)
    rows = listings(spark, sf).select("row_key", "listing_type", "price", "city")
    X.write_star({"units": rows}, folder, {"units": ["listing_type"]})
    return spark.read.parquet(f"{folder}/units").groupBy("listing_type", "city").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("price"), 2).alias("max_price")
    )


def write_rejects(spark, sf):
    folder = scratch_folder(spark)
    _, bad = Q.split_rejects(validated_poi(spark, sf))
    X.write_rejects(bad, f"{folder}/rejected", sep=";")
    back = spark.read.option("header", True).option("sep", ";").csv(f"{folder}/rejected")
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "source_file", Q.REASON)


# --- demography ---------------------------------------------------------------------------------


# Some of these are part of other unit names, so their order decides.
CITY_NAMES = ["nation_12", "NATION_1", "Nation_2", "NATION_7", "NATION_24"]


def match_city(spark, sf):
    return D.match_city(view(spark, sf, "indicator_rows"), "unit", CITY_NAMES, "city").select("o_orderkey", "unit", "city")


def merge_indicators(spark, sf):
    rows = view(spark, sf, "indicator_rows").select(
        F.col("unit").alias("Miasto_GUS"),
        S.normalize_city(F.col("unit")).alias("Glowne_Miasto"),
        S.period_end_date("yr", "period").alias("Data"),
        "indicator", "value", "o_orderkey",
    )
    names = ["Populacja_Mezczyzni", "Populacja_Kobiety", "Przecietne_Wynagrodzenie_Brutto", "Oferty_Pracy"]
    return D.merge_indicators(rows, ["o_orderkey"], names)


def merge_demography(spark, sf):
    return D.merge_demography(view(spark, sf, "demography"))


# --- spatial -----------------------------------------------------------------------------------------


def explode_neighbors(spark, sf):
    cells = listings(spark, sf).select(
        S.grid_key("latitude", 0.018).alias("cell_lat"), S.grid_key("longitude", 0.018).alias("cell_lon")
    )
    return P.explode_neighbors(cells).groupBy("near_lat", "near_lon").agg(F.count(F.lit(1)).alias("n"))


def grid_neighbor_join(spark, sf):
    rows = listings(spark, sf)
    missing, known = rows.filter("centredistance IS NULL"), rows.filter("centredistance IS NOT NULL")
    return P.neighbor_counts(missing, known, ROW_KEY, I.IDW_CELL)


def building_sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    lacking = "buildyear IS NULL OR buildingmaterial = 'brak informacji' OR condition = 'brak informacji'"
    return rows.filter(lacking), rows.filter(f"NOT coalesce({lacking}, false)")


def nearest_within_radius(spark, sf):
    missing, known = building_sides(listings(spark, sf))
    near = P.nearest_within_radius(missing, known, ROW_KEY, I.SAME_BUILDING_RADIUS, order=ROW_KEY)
    return near.select("row_key", "near_row_key", F.round("dist", 6).alias("dist"))


def knn_within_radius(spark, sf):
    missing, known = building_sides(listings(spark, sf))
    near = P.knn_within_radius(missing, known, ROW_KEY, order=ROW_KEY)
    return near.select("row_key", "rank", "near_row_key", F.round("dist", 6).alias("dist"))


def crowded_listings(spark, sf) -> DataFrame:
    """Listings of which a part lies in one small cell, and some at one very point, all in one city."""
    return listings(spark, sf).withColumns({c: F.expr(sql) for c, sql in CROWDED.items()})


def knn_hot_cell(spark, sf):
    missing, known = building_sides(crowded_listings(spark, sf))
    near = P.knn_within_radius(missing, known, ROW_KEY, order=ROW_KEY)
    return near.select("row_key", "rank", "near_row_key", F.round("dist", 6).alias("dist"))


# --- imputation -----------------------------------------------------------------------------------------


def city_median(spark, sf):
    return I.city_median(listings(spark, sf), "centredistance", name="median_distance")


def city_mode(spark, sf):
    rows = listings(spark, sf)
    known = rows.filter("buildingmaterial <> 'brak informacji'")
    years = I.group_median(rows, ["city"], "buildyear", "year", interpolate=True, width=10)
    return I.city_mode(known, "buildingmaterial", name="material").join(
        years.select("city", F.col("year").cast("int").alias("year")), "city", "full"
    )


def idw_impute(spark, sf):
    return I.idw_impute(listings(spark, sf)).select("row_key", *G.DISTANCE_COLUMNS)


def impute_building(spark, sf):
    return I.impute_building(listings(spark, sf)).select("row_key", "buildingmaterial", "condition", "buildyear")


def impute_amenities(spark, sf):
    return I.impute_amenities(listings(spark, sf)).select("row_key", *G.AMENITY_COLUMNS)


# --- star and measures --------------------------------------------------------------------------------------


def price_deviation(spark, sf):
    rows = K.with_price_per_sqm(listings(spark, sf)).withColumn("city_norm", S.normalize_city("city"))
    return K.price_deviation(rows).select("row_key", F.round("price_deviation", 4).alias("price_deviation"))


def wages(spark, sf) -> DataFrame:
    return R.dim_demography(D.merge_demography(view(spark, sf, "demography")))


def rent_to_wage(spark, sf):
    by_year = R.wage_by_city_year(wages(spark, sf))
    rows = listings(spark, sf).withColumns({"_c": S.normalize_city("city"), "_y": F.year("source_date")})
    joined = rows.join(by_year, (F.col("_c") == F.col("_city")) & (F.col("_y") == F.col("_year")), "left")
    return joined.select("row_key", F.round(K.rent_to_wage(wage="_wage"), 4).alias("rent_to_wage"))


def location_premium(spark, sf):
    return K.premium_by_kind(K.with_price_per_sqm(listings(spark, sf)))


def surrogate_key(spark, sf):
    return R.surrogate_key(listings(spark, sf).select("row_key", "price"), "key", ROW_KEY)


def dim_time(spark, sf):
    return R.dim_time(listings(spark, sf))


def numbered(spark, sf) -> DataFrame:
    return R.with_row_id(listings(spark, sf), ROW_KEY)


def dim_unit(spark, sf):
    return R.dim_unit(numbered(spark, sf))


def dim_building(spark, sf):
    return R.dim_building(numbered(spark, sf))


def dim_infrastructure(spark, sf):
    return R.dim_infrastructure(numbered(spark, sf))


def dim_demography(spark, sf):
    return wages(spark, sf)


def fact_offers(spark, sf):
    # As the job runs it: each table is written once, here with what the fact reads, and the branches take their columns of it.
    folder = scratch_folder(spark)
    rows = written(numbered(spark, sf).select(*R.FACT_COLUMNS), f"{folder}/numbered")
    people = written(wages(spark, sf), f"{folder}/demography")
    return R.fact_offers(rows, written(R.dim_time(rows), f"{folder}/time"), people)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        price_per_sqm, price_deviation, normalize_city, missing_label, round_num, to_int, to_decimal,
        parse_month, period_end_date, planar_distance, grid_key, conform_columns, stage_listings,
        stage_demography, stage_poi, validate_rows, validate_poi, flag_duplicates, split_rejects,
        quality_report, dedup_keep_first, quality_recheck, month_gaps, read_delimited, union_tagged,
        tag_from_filename, write_star, write_rejects, match_city, merge_indicators, merge_demography,
        explode_neighbors, grid_neighbor_join, nearest_within_radius, knn_within_radius, knn_hot_cell, city_median,
        city_mode, idw_impute, impute_building, impute_amenities, rent_to_wage, location_premium,
        surrogate_key, dim_time, dim_unit, dim_building, dim_infrastructure, dim_demography, fact_offers,
    )
}
