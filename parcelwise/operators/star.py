"""Star schema: surrogate keys, five dimensions and the fact table of offers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions.scalars import normalize_city, parse_date
from parcelwise.operators.kpi import (
    location_premium,
    premium_by_kind,
    price_deviation,
    rent_to_wage,
    with_price_per_sqm,
)
from parcelwise.sources.scratch import scratch_folder, written

# Output columns of the dimensions, and the stored column each comes from.
UNIT_COLUMNS = {
    "source_id": "id", "listing_type": "listing_type", "latitude": "latitude", "longitude": "longitude",
    "city": "city", "squareMeters": "squaremeters", "rooms": "rooms", "floor": "floor",
    "floorCount": "floorcount", "condition": "condition", "hasElevator": "haselevator",
    "hasParkingSpace": "hasparkingspace", "hasStorageRoom": "hasstorageroom",
    "hasSecurity": "hassecurity", "hasBalcony": "hasbalcony", "price": "price", "ownership": "ownership",
}
BUILDING_COLUMNS = {
    "source_id": "id", "listing_type": "listing_type", "city": "city", "type": "type",
    "buildYear": "buildyear", "buildingMaterial": "buildingmaterial",
}
INFRASTRUCTURE_COLUMNS = {
    "source_id": "id", "listing_type": "listing_type", "centreDistance": "centredistance",
    "schoolDistance": "schooldistance", "clinicDistance": "clinicdistance",
    "postOfficeDistance": "postofficedistance", "collegeDistance": "collegedistance",
    "kindergartenDistance": "kindergartendistance", "busstopDistance": "busstopdistance",
    "caffeDistance": "caffedistance", "parkingDistance": "parkingdistance",
    "restaurantDistance": "restaurantdistance", "pharmacyDistance": "pharmacydistance",
    "poiCount": "poicount",
}
OPTIONAL_COLUMNS = ("busstopdistance", "caffedistance", "parkingdistance")
LISTING_KEY = ("id", "listing_type", "source_date")
CITY_COUNTY = "%m.%"
ROW_ID = "row_id"
# What the fact table reads of the numbered listings.
FACT_COLUMNS = (ROW_ID, "city", "source_date", "rooms", "type", "listing_type", "price", "squaremeters", "poicount")


def surrogate_key(df: DataFrame, name: str, keys: Sequence[str], digits: int = 4) -> DataFrame:
    """Add dense keys 1..n in the order of the MD5 of the key columns.

    The leading ``digits`` hex digits of the hash are a bucket: buckets hold about equal
    shares of the rows whatever the data looks like, rows are numbered inside their
    bucket, and start numbers come from the counts per bucket. That table has at most
    ``16 ** digits`` rows, so it may be broadcast. The keys depend on the data alone, not
    on partitions or runs; rows with equal key columns follow the other columns. Whether a
    hash stands twice is told by the same counts, which are taken when this is called: if none
    does, the other columns order nothing, and a reader of few columns shuffles only those.
    """
    if not 1 <= digits <= 5:
        raise ValueError("digits must be 1 to 5: the table of buckets is broadcast")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]
    digest = F.md5(F.concat_ws("\u001f", *parts).cast("binary"))
    bucket = F.substring("_digest", 1, digits)
    digests = df.select(digest.alias("_digest")).withColumn("_bucket", bucket)
    each = digests.groupBy("_bucket", F.unhex("_digest").alias("_whole")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = written(each.groupBy("_bucket").agg(F.sum("_n").alias("_size"), F.max("_n").alias("_most")), f"{scratch_folder(df.sparkSession)}/sizes")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    repeated = (sizes.agg(F.max("_most")).first()[0] or 0) > 1
    rest = [c for c in df.columns if c not in keys] if repeated else []
    hashed = df.withColumn("_digest", digest).withColumn("_bucket", bucket)
    inside = Window.partitionBy("_bucket").orderBy("_digest", *keys, *rest)
    numbered = hashed.withColumn("_number", F.row_number().over(inside))
    return numbered.join(F.broadcast(starts), "_bucket").select(
        (F.col("_start") + F.col("_number")).cast("bigint").alias(name), *[F.col(c) for c in df.columns]
    )


def dim_time(listings: DataFrame, month: str = "source_date") -> DataFrame:
    """One row per listing month, keyed in order of time.

    The numbering window has no partition key, but sees distinct months only.
    """
    months = listings.select(F.col(month).cast("string").alias("source_date")).filter(
        F.col("source_date").isNotNull()
    ).distinct()
    date = parse_date("source_date")
    return months.select(
        F.row_number().over(Window.orderBy("source_date")).cast("bigint").alias("ID_Czasu"),
        "source_date",
        F.month(date).alias("miesiac"),
        F.year(date).alias("rok"),
        F.month(date).alias("source_date_m"),
        F.year(date).alias("source_date_y"),
    )


def with_row_id(listings: DataFrame, keys: Sequence[str] = LISTING_KEY) -> DataFrame:
    """Number the listing rows once.

    The unit, building and infrastructure dimensions have one row per listing row, so
    this number is their key, and the fact row's foreign key into all three.
    """
    return surrogate_key(listings, ROW_ID, keys)


def _project(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    have = set(df.columns)
    return df.select(
        F.col(ROW_ID).alias(key),
        *[
            F.col(source).alias(target)
            if source in have or source not in OPTIONAL_COLUMNS
            else F.lit(None).cast("decimal(10,2)").alias(target)
            for target, source in columns.items()
        ],
    )


def dim_unit(numbered: DataFrame) -> DataFrame:
    return _project(numbered, "ID_Lokalu", UNIT_COLUMNS)


def dim_building(numbered: DataFrame) -> DataFrame:
    return _project(numbered, "ID_Budynku", BUILDING_COLUMNS)


def dim_infrastructure(numbered: DataFrame) -> DataFrame:
    """Distances and counts; distances to stops, cafes and car parks are NULL if absent."""
    return _project(numbered, "ID_Infrastruktury", INFRASTRUCTURE_COLUMNS)


def dim_demography(merged: DataFrame) -> DataFrame:
    rows = merged.select(
        F.col("miasto_gus").alias("Miasto_GUS"),
        F.col("glowne_miasto").alias("Glowne_Miasto"),
        F.col("data").cast("string").alias("Data"),
        F.col("populacja_ogolna").try_cast("int").alias("Populacja_Ogolna"),
        F.col("zarejestrowani_bezrobotni").try_cast("int").alias("Zarejestrowani_Bezrobotni"),
        F.col("przecietne_wynagrodzenie_brutto").try_cast("decimal(10,2)").alias("Przecietne_Wynagrodzenie_Brutto"),
        F.col("dochody_wlasne_jst").try_cast("decimal(10,2)").alias("Dochody_Wlasne_JST"),
    )
    return surrogate_key(rows, "ID_Demografii", ["Miasto_GUS", "Data"])


def wage_by_city_year(demography: DataFrame) -> DataFrame:
    """City counties only: one row per normalised city and year, the latest date, then name."""
    counties = demography.filter(F.col("Miasto_GUS").like(CITY_COUNTY))
    return counties.groupBy(
        normalize_city("Glowne_Miasto").alias("_city"), F.year(parse_date("Data")).alias("_year")
    ).agg(
        F.max_by(
            F.struct("ID_Demografii", F.col("Przecietne_Wynagrodzenie_Brutto").alias("_wage")),
            F.struct("Data", "Miasto_GUS"),
        ).alias("_demo")
    ).select("_city", "_year", "_demo.ID_Demografii", "_demo._wage")


def fact_offers(numbered: DataFrame, time: DataFrame, demography: DataFrame) -> DataFrame:
    """One fact per listing row, with keys into the five dimensions and the measures.

    ``numbered`` are cleaned listings with their ``row_id``. How the months, the wages per
    city and year and the group means are joined is left to Spark's run-time sizes.
    """
    months = time.select(F.col("source_date").alias("_month"), "ID_Czasu")
    wages = wage_by_city_year(demography)
    month = F.col("source_date").cast("string")
    rows = with_price_per_sqm(numbered).select(
        ROW_ID, normalize_city("city").alias("city_norm"), F.year(parse_date(month)).alias("_y"), "rooms", "type",
        "listing_type", "price", "squaremeters", "poicount", "price_per_sqm", month.alias("_sd"),
    )
    # The means and premiums are taken from the bare rows, before anything is joined on.
    measured = (
        location_premium(price_deviation(rows), premium_by_kind(rows))
        .join(months, F.col("_sd") == F.col("_month"))
        .join(wages, (F.col("city_norm") == F.col("_city")) & (F.col("_y") == F.col("_year")), "left")
    )
    return measured.select(
        F.col(ROW_ID).alias("ID_Faktu"),
        F.col(ROW_ID).alias("ID_Lokalu"),
        F.col(ROW_ID).alias("ID_Budynku"),
        F.col(ROW_ID).alias("ID_Infrastruktury"),
        "ID_Czasu",
        "ID_Demografii",
        F.col("price").try_cast("decimal(15,2)").alias("Cena_Calkowita"),
        F.round("price_per_sqm", 2).try_cast("decimal(10,2)").alias("Cena_Za_M2"),
        F.col("squaremeters").try_cast("decimal(10,2)").alias("Powierzchnia_Lokalu"),
        F.round("price_deviation", 4).try_cast("decimal(8,4)").alias("Odchylenie_Procentowe_Ceny"),
        F.round(rent_to_wage(wage="_wage"), 4).try_cast("decimal(8,4)").alias("Stosunek_Najmu_Do_Wynagrodzenia"),
        F.col("location_premium").try_cast("decimal(10,2)").alias("Premia_Lokalizacyjna"),
    )
