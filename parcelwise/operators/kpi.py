"""Measures of the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalars import price_per_sqm, ratio

# Fixed values.
POI_CUT = 15
SELL, RENT = "sell", "rent"
COMPARABLE = ("city_norm", "rooms", "type", "listing_type")


def price_deviation(
    df: DataFrame,
    by: Sequence[str] = COMPARABLE,
    value: str = "price_per_sqm",
    average: str = "group_average",
    name: str = "price_deviation",
) -> DataFrame:
    """Add (value - group mean) / group mean; NULL where a group column is NULL.

    The means come from an aggregate with map-side combine, joined back by equality, so
    a group with a large share of all rows is never brought together in one task, and
    NULL keys match nothing.
    """
    means = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)])
        .agg(F.avg(value).alias(average))
    )
    joined = df.join(means, [F.col(c) == F.col(f"_g{i}") for i, c in enumerate(by)], "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.col(average),
        F.when(F.col(average) > 0, (F.col(value) - F.col(average)) / F.col(average)).alias(name),
    )


def rent_to_wage(kind="listing_type", price="price", wage="przecietne_wynagrodzenie_brutto"):
    """Price over gross wage for rent offers with a positive wage, else NULL."""
    return F.when(F.col(kind) == RENT, ratio(price, wage))


def premium_by_kind(
    df: DataFrame,
    cut: int = POI_CUT,
    poi: str = "poicount",
    value: str = "price_per_sqm",
    kind: str = "listing_type",
) -> DataFrame:
    """Mean value of offers with many points of interest less that of the others, per kind.

    A side without rows counts as 0; rows without a count are on neither side. At most
    two rows, one per kind of offer.
    """
    high = F.avg(F.when(F.col(poi) > cut, F.col(value)))
    low = F.avg(F.when(F.col(poi) <= cut, F.col(value)))
    return (
        df.filter(F.col(kind).isin(SELL, RENT))
        .groupBy(kind)
        .agg(F.round(F.coalesce(high, F.lit(0.0)) - F.coalesce(low, F.lit(0.0)), 2).alias("location_premium"))
    )


def location_premium(
    df: DataFrame,
    premiums: DataFrame | None = None,
    kind: str = "listing_type",
    name: str = "location_premium",
) -> DataFrame:
    """Add the premium of each row's kind; kinds other than sale take that of rent.

    ``premiums`` comes from :func:`premium_by_kind` (of ``df`` itself by default); it has
    at most two rows, which is why it may be broadcast.
    """
    premiums = premium_by_kind(df, kind=kind) if premiums is None else premiums
    by_kind = premiums.select(F.col(kind).alias("_kind"), F.col("location_premium").alias("_premium"))
    row_kind = F.when(F.col(kind) == SELL, F.lit(SELL)).otherwise(F.lit(RENT))
    joined = df.join(F.broadcast(by_kind), row_kind == F.col("_kind"), "left")
    return joined.select(*[F.col(c) for c in df.columns], F.coalesce("_premium", F.lit(0.0)).alias(name))


def with_price_per_sqm(df: DataFrame, name: str = "price_per_sqm") -> DataFrame:
    return df.withColumn(name, price_per_sqm("price", "squaremeters"))
