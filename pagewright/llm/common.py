"""What the operators of this subpackage share: columns by name, durable tables, white space."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# The white space and the words of every contract here (space, tab, LF, VT, FF, CR).
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: list[str] = []
_cleaned: set[str] = set()


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    def delete() -> None:
        with contextlib.suppress(Exception):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    atexit.register(delete)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's
    checkpoint folder. Only a local master may go without: it gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="pagewright-"))
        found = _own_dir[0]
    folder = f"{found.rstrip('/')}/pagewright-{spark.sparkContext.applicationId}"
    if folder not in _cleaned:
        _cleaned.add(folder)
        _delete_at_exit(spark, folder)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read from there.

    It cuts lineage: a lost executor costs a read, not the work before. The files go when the
    application ends.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a durable table that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(name)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of few rows, as one text may be long; the session bounds their bytes too."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def position(df: DataFrame, name: str) -> int:
    """Where the column of this name stands: the exact name first, then in any case."""
    if name in df.columns:
        return df.columns.index(name)
    folded = [c.lower() for c in df.columns]
    if name.lower() not in folded:
        raise ValueError(f"no column {name}; there are {', '.join(df.columns)}")
    return folded.index(name.lower())


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns alone, also where other columns' names differ only in case."""
    fresh = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return fresh.select(*[F.col(f"c{position(df, n)}").alias(n) for n in names])


def numbered(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """df with columns c0, c1, ... so that added names can't clash, and those names."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_key(df: DataFrame, columns: list[str]) -> Column:
    """A 128-bit key of a row's whole content, as hex digits; rows that repeat have the same. Maps
    and variants count as their JSON."""
    absent = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    parts = [F.col(f.name) if _hashable(f.dataType) else F.to_json(F.struct(f.name)) for f in df.select(*columns).schema.fields]
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(salt), absent, *parts)), 16, "0") for salt in ("one", "two")]
    return F.concat(*halves)


def one_of_each(keyed: DataFrame, names: list[str]) -> DataFrame:
    """One row of those with the same row_key, which combine in each task before the shuffle."""
    number = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    return keyed.withColumn("copy_no", number).filter("copy_no = 1").select(*names)


#: A key is hot if it holds this share of the rows and at least HOT_ROWS of them, so at most
#: 1 / HOT_SHARE keys are; a hot key is dealt to SALTS places.
HOT_SHARE, HOT_ROWS, SALTS = 1 / 1024, 256, 128


def hot_keys(rows: DataFrame, key: list[str], total: int | None = None) -> DataFrame:
    """The hot keys of rows, of which there are at most 1 / HOT_SHARE."""
    counts = rows.groupBy(*key).agg(F.count("*").alias("hot_n"))
    return counts.filter(F.col("hot_n") >= max((rows.count() if total is None else total) * HOT_SHARE, HOT_ROWS)).select(*key)


def salted_join(rows: DataFrame, facts: DataFrame, key: list[str], salt_by: Column, how: str = "left", hot: DataFrame | None = None) -> DataFrame:
    """rows joined with facts (at most one row per key) so that no key's rows go to one task. Null
    keys meet nothing; where there may be many of them, callers keep them apart.

    The keys of rows are counted, with map-side combining; the hot ones (given, if rows are dear to
    make) are broadcast, their rows dealt to SALTS places by salt_by, and their facts repeated there.
    """
    hot = (hot_keys(rows, key) if hot is None else hot).withColumn("is_hot", F.lit(True))
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("salt", F.when(F.col("is_hot"), F.pmod(salt_by, F.lit(SALTS)).cast("int")).otherwise(0)).drop("is_hot")
    places = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = facts.join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(places)).drop("is_hot")
    return salted.join(spread, [*key, "salt"], how).drop("salt")


def texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column; bytes.split() splits at exactly WHITE."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key in turn, from batches that are sorted by these keys."""
    waiting: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        values = list(zip(*[table.column(k).to_pylist() for k in keys], strict=True))
        begin = 0
        for i, value in enumerate(values):
            if value != last:
                if last is not None:
                    waiting.append(table.slice(begin, i - begin))
                    yield pa.concat_tables(waiting)
                    waiting = []
                begin, last = i, value
        waiting.append(table.slice(begin))
    if waiting:
        yield pa.concat_tables(waiting)
