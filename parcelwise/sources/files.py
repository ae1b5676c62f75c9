"""Delimited and Parquet sources and sinks."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwise.functions.scalars import as_col
from parcelwise.operators.quality import REASON

# The files of each source.
LISTING_FILES = {"sell": "all_apartments_sell.csv", "rent": "all_apartments_rent.csv"}
DEMOGRAPHY_GLOB = "baza_bi_miasta_*.csv"
POI_FILES = {"cafe": "all_cafes.csv", "parking": "all_parkings.csv", "bus_stop": "all_bus_stops.csv"}


@dataclass(frozen=True)
class TextFile:
    """A delimited file and the column names of its first line; none if it is empty."""

    path: str
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


def _visible(file_system, status) -> Iterator:
    """Files below a path, without hidden ones, as Spark would read them."""
    if status.getPath().getName().startswith(("_", ".")):
        return
    if status.isDirectory():
        for inner in file_system.listStatus(status.getPath()):
            yield from _visible(file_system, inner)
    else:
        yield status


def list_delimited(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> list[TextFile]:
    """The files that paths or globs name, by path, each with its own header.

    The driver lists them and reads one line of each, through Hadoop's file systems, so any
    store that Spark reads will do. A path without a match gives no file.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found = {}
    for path in [paths] if isinstance(paths, str) else paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        file_system = pattern.getFileSystem(conf)
        for status in file_system.globStatus(pattern) or ():
            for file in _visible(file_system, status):
                stream = file_system.open(file.getPath())
                codec = codecs.getCodec(file.getPath())
                lines = jvm.java.io.BufferedReader(
                    jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
                )
                first = lines.readLine()
                lines.close()
                names = next(csv.reader([(first or "").removeprefix("\ufeff")], delimiter=sep), [])
                found[file.getPath().toString()] = tuple(names)
    return [TextFile(path, names) for path, names in sorted(found.items())]


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    columns: Sequence[str] | None = None,
    file_column: str | None = None,
    position_column: str | None = None,
    files: Sequence[TextFile] | None = None,
) -> DataFrame:
    """Text files with a header, every column a string; a glob reads all its matches.

    Each file is read by its own header: files are grouped by header, so there are as many scans as
    different headers, and put together by column name; a column that a file lacks is NULL there. Quotes in
    quoted text are doubled, as spreadsheets and pandas write them. With ``columns`` nothing is looked up
    when the plan is made, and a file whose header differs fails instead.
    ``files`` are those listed already by ``list_delimited``. ``file_column`` adds the name of the file
    each row came from, ``position_column`` a value that orders the rows of a file as they stand in it
    (the block that was read, then the row's turn in it).
    """

    def scan(names: Sequence[str], where: str | list[str]) -> DataFrame:
        twice = sorted({c for c in names if list(names).count(c) > 1})
        if twice:
            raise ValueError(f"columns {twice} stand twice in the header of {where}")
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
        reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
        df = reader.schema(schema).option("enforceSchema", False).csv(where)
        if file_column is not None:
            df = df.withColumn(file_column, F.col("_metadata.file_name"))
        if position_column is not None:
            turn = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
            df = df.withColumn(position_column, turn)
        return df

    if columns is not None:
        return scan(columns, paths if isinstance(paths, str) else list(paths))
    files = list_delimited(spark, paths, sep) if files is None else files
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        if file.columns:
            by_header.setdefault(file.columns, []).append(file.path)
    if not by_header:
        raise FileNotFoundError(f"no file with a header at {paths}")
    scans = [scan(names, where) for names, where in by_header.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def union_tagged(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Rows of all frames by column name, with the frame's key in column ``tag``."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def month_from_filename(name: Column | str) -> Column:
    """``2024-04`` from ``..._2024_04.csv``; empty text where there is no month."""
    return F.replace(F.regexp_extract(as_col(name), r"(\d{4}_\d{2})", 1), F.lit("_"), F.lit("-"))


def kind_from_filename(name: Column | str) -> Column:
    return F.when(F.lower(as_col(name)).contains("rent"), F.lit("rent")).otherwise(F.lit("sell"))


def tag_from_filename(
    df: DataFrame, file_column: str, month: str = "source_date", kind: str = "listing_type"
) -> DataFrame:
    """Add the listing month and kind that a row's file name carries."""
    return df.withColumns({month: month_from_filename(file_column), kind: kind_from_filename(file_column)})


def read_monthly_listings(
    spark: SparkSession, globs: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """All monthly listing files, each by its own header, tagged from their names."""
    return tag_from_filename(read_delimited(spark, globs, columns=columns, file_column="source_file"), "source_file")


def read_listings(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The sale and rent files of a raw folder, tagged ``listing_type``."""
    frames = {
        kind: read_delimited(spark, f"{folder}/{name}", file_column="source_file", **options)
        for kind, name in LISTING_FILES.items()
    }
    return union_tagged(frames, "listing_type")


def read_demography(spark: SparkSession, folder: str, **options) -> DataFrame:
    """All demography files of a raw folder."""
    return read_delimited(spark, f"{folder}/{DEMOGRAPHY_GLOB}", file_column="source_file", **options)


def read_poi(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The point-of-interest files of a raw folder, tagged ``poi_type``."""
    frames = {
        kind: read_delimited(spark, f"{folder}/{name}", sep=";", file_column="source_file", **options)
        for kind, name in POI_FILES.items()
    }
    return union_tagged(frames, "poi_type")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace one Parquet table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sorted(df: DataFrame, path: str, order: Sequence[str], partitions: int | None = None) -> None:
    """Replace one Parquet table by files in order: rows rise by ``order`` inside a file and from file to file by name.

    The columns' ranges are found on a sample by Spark's range partitioning, so no task sorts the table; rows that are equal
    in ``order`` follow by their other columns, and ranges are cut by all of them, so many equal ones are spread as well.
    """
    by = [*order, *[c for c in df.columns if c not in order]]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_table(df.repartitionByRange(n, *by).sortWithinPartitions(*by), path)


def read_sorted(spark: SparkSession, path: str, place: str = "place") -> DataFrame:
    """A table of ``write_sorted`` with every row's ``place``, from 1, in the order of the files and of the rows in them.

    A file's first place comes from the counts of the files before it, one row a file.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_file").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    joined = rows.join(starts, F.col("_file") == F.col("_of"))
    return joined.withColumn(place, F.col("_start") + F.col("_row") + 1).drop("_file", "_row", "_of", "_start")


def write_star(tables: Mapping[str, DataFrame], folder: str, partition_by: Mapping[str, Sequence[str]] | None = None) -> None:
    """Replace the Parquet tables of a star schema, one sub-folder each."""
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", (partition_by or {}).get(name, ()))


def write_rejects(rejected: DataFrame, path: str, sep: str = ",", file_column: str = "source_file") -> None:
    """Rejected rows with their reasons as CSV, one sub-folder per source file."""
    (
        rejected.filter(F.col(REASON) != "")
        .write.mode("overwrite")
        .partitionBy(file_column)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .csv(path)
    )
