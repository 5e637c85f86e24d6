"""Long work in slices under a time budget: an attempt ledger, resumption, and a retry pass.

Items are dealt to slices by a hash of their key. A slice's attempts are one Spark job, whose rows
are written to the ledger as a folder of their own, whole or not at all; a run that is stopped, or
out of time, is taken up by the next one from what the ledger has. After the walk over all slices,
passes over the items that failed go on until each has succeeded or has had its tries. The ledger
says of every attempt when it may begin: the waiting time doubles with each failure, and a part of
it depends on the item, so that retries do not come all at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Attempts of an item, and the first waiting time in seconds, which doubles.
TRIES, BASE_SECONDS = 3, 1
SLICES = 8
LEDGER = "item long, attempt int, slice int, ok boolean, result string, wait_seconds double"

#: (item, attempt) to whether it succeeded, and a result or an error.
Handler = Callable[[int, int], tuple[bool, str | None]]


def waiting(attempt: Column, item: Column) -> Column:
    """Seconds before the attempt after this one: doubled each time, and up to a second more by item."""
    return F.pow(F.lit(2.0), attempt - 1) * BASE_SECONDS + F.pmod(F.xxhash64(item, attempt), F.lit(1000)) / 1000


def ledger_of(spark: SparkSession, path: str) -> DataFrame:
    """All attempts so far. Folders of slices that were not finished have no attempts."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath().toString() for f in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(at, "pass-*/slice-*/_SUCCESS")) or []]
    folders = [p.rsplit("/", 1)[0] for p in done]
    return spark.read.schema(LEDGER).parquet(*folders) if folders else spark.createDataFrame([], LEDGER)


def settled_items(ledger: DataFrame, tries: int = TRIES) -> DataFrame:
    """Per item its attempts, whether it succeeded, its last result and all its waiting."""
    rows = ledger.groupBy("item").agg(F.max("attempt").alias("tries"), F.bool_or("ok").alias("ok"), F.max_by("result", "attempt").alias("result"), F.sum("wait_seconds").alias("waited"))
    return rows.withColumn("settled", F.col("ok") | (F.col("tries") >= tries))


def _attempts(rows: DataFrame, handler: Handler) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, attempt in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    out.append(handler(item, attempt))
                except Exception as e:  # a failure is an attempt's result
                    out.append((False, f"{type(e).__name__}: {e}"))
            ok, result = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ok, pa.bool_()), pa.array(result, pa.string())], names=["item", "attempt", "slice", "ok", "result"])

    done = rows.select("item", "attempt", "slice").mapInArrow(run, "item long, attempt int, slice int, ok boolean, result string")
    return done.withColumn("wait_seconds", F.when(F.col("ok"), 0.0).otherwise(waiting(F.col("attempt"), F.col("item"))))


def work_off(
    items: DataFrame, handler: Handler, path: str, budget_seconds: float | None = None, slices: int = SLICES, tries: int = TRIES, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], Any] | None = None
) -> bool:
    """Works off items (item, each once) into the ledger at path, as far as the budget goes; True if
    all are settled. Between passes it waits, by wait (None: not at all), for the longest waiting time."""
    spark = items.sparkSession
    deadline = None if budget_seconds is None else clock() + budget_seconds
    dealt = items.select(F.col("item").cast("long").alias("item"), F.pmod(F.xxhash64("item"), F.lit(slices)).cast("int").alias("slice")).filter("item is not null")
    for turn in range(tries):
        before = ledger_of(spark, path).filter(F.col("attempt") <= turn)
        if turn:
            if before.filter(~F.col("ok") & (F.col("attempt") == turn)).isEmpty():
                return True
            if wait is not None:
                wait(before.filter(F.col("attempt") == turn).agg(F.max("wait_seconds")).first()[0] or 0.0)
        have = {r["slice"] for r in ledger_of(spark, path).filter(F.col("attempt") == turn + 1).select("slice").distinct().collect()}  # at most slices
        for k in range(slices):
            if k in have:
                continue
            if deadline is not None and clock() >= deadline:
                return False
            mine = dealt.filter(F.col("slice") == k)
            if turn:
                again = before.filter((F.col("attempt") == turn) & ~F.col("ok") & (F.col("slice") == k)).select("item")
                mine = mine.join(again, "item", "left_semi")
            rows = _attempts(mine.withColumn("attempt", F.lit(turn + 1)), handler)
            rows.select("item", "attempt", "slice", "ok", "result", "wait_seconds").write.mode("overwrite").parquet(f"{path.rstrip('/')}/pass-{turn + 1}/slice-{k}")
    return True
