"""The nearest point of interest of every kind, however far it is."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.operators.spatial import nearest_neighbors
from parcelwise.sources.observed import RowCounts
from parcelwise.sources.scratch import dropped, scratch_folder, written

#: Width of the first search in degrees (about 2 km).
FIRST_RING = 0.018
# The cells of the second search are cut so finely at first, a power of two: 256 of them.
WIDE_PARTS = 16
# The distance columns of the infrastructure dimension, and the kinds of points they are about.
POI_DISTANCES = {"busstopdistance": "bus_stop", "caffedistance": "cafe", "parkingdistance": "parking"}


def nearest_poi(
    places: DataFrame,
    poi: DataFrame,
    kinds: Sequence[str],
    kind: str = "poi_type",
    order: Sequence[str] = ("name", "street", "number"),
    lat: str = "latitude",
    lon: str = "longitude",
    poi_lat: str = "lat",
    poi_lon: str = "lon",
    first_ring: float = FIRST_RING,
) -> DataFrame:
    """For every distinct place and kind the nearest point: ``lat``, ``lon``, ``kind``, ``dist`` and ``near`` (the ``order`` columns).

    The first search looks within ``first_ring``; what it finds is final, as nothing nearer can lie outside. Only places without any go
    on to a second, which begins with cells as wide as all points, cut into 256, and splits those that may hold the nearest. So there are two
    searches however far the points lie, and the driver makes a plan for every split of two searches instead of for those of every ring.
    Of points at one distance the first by ``order`` counts. Places and points without coordinates take no part; kinds that have no point give no row.
    """
    spark, folder = places.sparkSession, scratch_folder(places.sparkSession)
    located = lambda df, y, x: df.where(F.col(y).isNotNull() & F.col(x).isNotNull())
    known = located(poi, poi_lat, poi_lon).where(F.col(kind).isin(*kinds)).select(
        F.col(kind).alias("_kind"), F.col(poi_lat).cast("double").alias("_y"), F.col(poi_lon).cast("double").alias("_x"), *order
    )
    known = written(known, f"{folder}/known")
    extent = [f(c).alias(f"{f.__name__}{c}") for c in ("_y", "_x") for f in (F.min, F.max)]
    present = known.groupBy("_kind").agg(*extent).collect()  # some of ``kinds``
    asked = located(places, lat, lon).select(F.col(lat).cast("double").alias("_y"), F.col(lon).cast("double").alias("_x")).distinct()
    here = F.explode(F.array(*[F.lit(r["_kind"]) for r in present])) if present else F.lit(None).cast("string")
    seen = RowCounts()
    open_ = seen.watch(asked.select("_y", "_x", here.alias("_kind")).where("_kind IS NOT NULL"), "open", **{k: f(c) for c in ("_y", "_x") for k, f in ((f"min{c}", F.min), (f"max{c}", F.max))})
    open_ = written(open_, f"{folder}/open_0")
    search = lambda open_, cell, radius, at, parts=1: nearest_neighbors(
        open_, known, 1, cell, list(order), group=["_kind"], radius=radius, lat="_y", lon="_x", folder=f"{folder}/search_{at}", keep_steps=False, parts=parts
    ).select("_y", "_x", "_kind", F.col("near")[0].alias("_near"))  # tables already
    found = []
    if seen.of("open")["rows"]:
        ends = [*present, seen.of("open")]
        span = max(max(r[f"max{c}"] for r in ends) - min(r[f"min{c}"] for r in ends) for c in ("_y", "_x"))
        found.append(search(open_, first_ring, first_ring, 0))
        open_ = written(seen.watch(open_.join(found[0], ["_y", "_x", "_kind"], "left_anti"), "left"), f"{folder}/open_1")
        dropped(spark, f"{folder}/open_0")
        if seen.of("left")["rows"]:
            # Wider than all points lie apart, so any two are in neighbouring cells.
            found.append(search(open_, max(span * (1 + 1e-6), first_ring), None, 1, WIDE_PARTS))
    dropped(spark, *[f"{folder}/{name}" for name in ("known", "open_0", "open_1")])
    columns = [F.col("_y").alias(lat), F.col("_x").alias(lon), F.col("_kind").alias(kind), F.col("_near.dist").alias("dist"), F.col("_near.row").alias("near")]
    if not found:
        empty = spark.createDataFrame([], "_y double, _x double, _kind string, dist double")
        row = F.struct(*[F.lit(None).cast(known.schema[c].dataType).alias(c) for c in order])
        return empty.select(F.col("_y").alias(lat), F.col("_x").alias(lon), F.col("_kind").alias(kind), "dist", row.alias("near"))
    return reduce(DataFrame.union, found).select(*columns)


def with_poi_distances(
    listings: DataFrame, poi: DataFrame, distances: Mapping[str, str] = POI_DISTANCES, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """``listings`` with a distance column per kind of point, in the unit of the coordinates, NULL without coordinates or points.

    The columns are those that the infrastructure dimension leaves NULL otherwise; present ones are replaced.
    """
    near = nearest_poi(listings, poi, sorted(set(distances.values())), lat=lat, lon=lon)
    wide = near.groupBy(F.col(lat).alias("_y"), F.col(lon).alias("_x")).agg(
        *[F.max(F.when(F.col("poi_type") == kind, F.col("dist"))).alias(f"_{name}") for name, kind in distances.items()]
    )
    same = (F.col(lat).cast("double") == F.col("_y")) & (F.col(lon).cast("double") == F.col("_x"))
    joined = listings.drop(*distances).join(wide, same, "left")
    return joined.select(*[c for c in listings.columns if c not in distances], *[F.col(f"_{c}").alias(c) for c in distances])


