"""Tables that are written once and read by several operators, in a folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's checkpoint folder; only a local master may go without,
    and gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="pagewright-tables-"))
        found = _own[0]
    return found.rstrip("/")


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    def delete() -> None:
        with contextlib.suppress(Exception):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    atexit.register(delete)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own among the written tables. Its files go when the application ends."""
    path = f"{shared_folder(spark)}/pagewright-tables-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _delete_at_exit(spark, path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, written to the shared folder and read from there. What reads them has a short
    plan, and a lost executor costs a read. The files go when the application ends."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
