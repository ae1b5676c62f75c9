"""Monthly listing files as they arrive, each offer once.

A file stream reads new files only, remembers them in its checkpoint and drops offers that came before within the watermark.
The file sink logs the files of every finished batch beside them, and readers follow that log: a batch that is done again
after a failure doesn't count twice. So nothing but files is needed, and the table can be read while it grows.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.sources.files import kind_from_filename, month_from_filename

OFFER = ("id", "listing_type", "source_date")

#: The state is as large as all keys of the span. Kept in the JVM it fills the heap, and all time goes to collecting garbage; so it
#: is kept in RocksDB, on the executors' disks, with a bounded part in memory. A batch adds its new files to the checkpoint, as a log of
#: changes would be read key by key when the stream starts again; and keys are not counted, which takes another look-up for each.
_STORE = "spark.sql.streaming.stateStore"
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "false",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "300",
}


def _delivered_in(path: Column) -> Column:
    """The file's name and its folder's: a folder of text counts by its name."""
    steps = F.split(F.url_decode(path), "/")
    return F.concat_ws("/", F.element_at(steps, -2), F.element_at(steps, -1))


def monthly_stream(spark: SparkSession, incoming: str, columns: Sequence[str], files_at_once: int | None = None) -> DataFrame:
    """New files under ``incoming``, every column a string, tagged with the month and kind in their names."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    reader = spark.readStream.schema(schema).option("header", True).option("escape", '"').option("recursiveFileLookup", True)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    name = _delivered_in(F.col("_metadata.file_path"))
    rows = reader.csv(incoming)
    return rows.select("*", month_from_filename(name).alias("source_date"), kind_from_filename(name).alias("listing_type"))


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def take_in(
    rows: DataFrame, out: str, checkpoint: str, key: Sequence[str] = OFFER, late: str = "400 days", month: str = "source_date"
) -> int:
    """Works off what has arrived and ends; returns the number of the last batch (-1 if there was none).

    An offer (``key``; NULLs equal) that was delivered before, up to ``late`` earlier than the newest month seen, is dropped, whichever
    of its rows came first stays. Months older than that are too late and left out; so are rows without a month. The state holds the
    keys of that span and no more; a checkpoint that holds its state otherwise goes on so. Called again with the same ``checkpoint`` it goes on where it stopped, also after a failure.
    """
    dated = rows.withColumn("_month", F.try_to_timestamp(F.concat(F.col(month), F.lit("-01")), F.lit("yyyy-MM-dd"))).where("_month IS NOT NULL")
    once = dated.withWatermark("_month", late).dropDuplicatesWithinWatermark(list(key)).drop("_month")

    sink = once.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    with _settings(rows.sparkSession, STATE):  # a query keeps those it starts with
        query = sink.trigger(availableNow=True).start(out)
    query.awaitTermination()
    progress = query.lastProgress
    return progress["batchId"] if progress else -1
