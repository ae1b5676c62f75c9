"""Intermediate tables in a folder that all executors share.

A frame that several later steps read is written once as Parquet instead of being
computed by each of them, and its lineage ends there: losing an executor costs no more
than reading the file again.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


_local: list[tempfile.TemporaryDirectory] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Like checkpoint files, what is written there stays until the cluster clears that
    folder. Only a local session without the setting gets a folder of this machine,
    which goes away with the process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _local:
            _local.append(tempfile.TemporaryDirectory(prefix="parcelwise-", ignore_cleanup_errors=True))
        shared = _local[0].name
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def dropped(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that ``written`` made and nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Spark deletes an execution's shuffle files when it ends, not when the driver happens to collect its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends; the caller's setting stays."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def written(df: DataFrame, path: str) -> DataFrame:
    """The frame, written to ``path`` and read back. The shuffle files of the write go with it; the caller's setting stays."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
