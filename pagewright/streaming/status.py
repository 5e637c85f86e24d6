"""Streams of job events: latest status per file, and uploads handled once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def event_stream(spark: SparkSession, path: str, schema: StructType | str, files_at_once: int = 100) -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def status_stream(events: DataFrame, key: str = "user_id") -> DataFrame:
    """The latest status of each file as a state that grows with the files, not the events; written
    in update or complete mode. Ties go to the later event id."""
    return events.groupBy(F.col(key).alias("file")).agg(F.max_by(F.col("event_type"), F.struct("ts", "event_id")).alias("status"), F.max("ts").alias("updated_at"))


def uploads_once(events: DataFrame, key: str = "key", late: str = "1 day") -> DataFrame:
    """Each key once within the watermark; all records of an event count, not the first alone."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> None:
    """Runs the stream over what is there now, into an in-memory table of this name (for tests and
    small states; sinks to files use writeStream.parquet in the same way)."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
