"""Relational tables through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a table read; with a partition column, one query per stride.

    The bounds only set the strides: rows outside them are still read, by the first and
    last partition.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    strides = (partition_column, lower, upper, partitions)
    if any(s is not None for s in strides):
        if any(s is None for s in strides):
            raise ValueError("partition_column, lower, upper and partitions go together")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A table as DataFrame; see :func:`read_options` for a parallel read."""
    return spark.read.format("jdbc").options(**read_options(url, table, **kwargs)).load()


def dates_as_text(df: DataFrame) -> DataFrame:
    """Date columns as ``yyyy-MM-dd`` text, which no driver shifts by a time zone."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def write_options(
    url: str, table: str, mode: str, batch_size: int = 10_000, properties: Mapping[str, str] | None = None
) -> dict[str, str]:
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(properties or {})}
    if mode == "overwrite":
        options["truncate"] = "true"  # empties the table, keeps its definition and indexes
    return options


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **kwargs) -> None:
    """Fill a table: ``overwrite`` keeps its definition, ``append`` adds rows."""
    options = write_options(url, table, mode, **kwargs)
    dates_as_text(df).write.format("jdbc").options(**options).mode(mode).save()
