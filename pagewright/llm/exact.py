"""Exact duplicates by heavy-hitter split.

A frequent-items sketch of the Misra-Gries family (Spark's approx_top_k, which keeps a bounded
number of counters and merges partial sketches) proposes frequent digests. Their true counts and
winners are aggregated with map-side combining, which verifies the proposals; the verified ones,
at most CANDIDATES rows, are broadcast and settle their rows where they lie. The rows of all other
digests go through an ordinary shuffle, in which no group reaches HEAVY_SHARE. Whatever the sketch misses or
overstates changes only which way a digest takes, never the result.

Defined cases: null text counts as empty; texts are equal when identical without white space
(space, tab, LF, VT, FF, CR), so blank ones are equal to empty ones; a null doc_id comes after all
others in a tie; of rows that repeat in full, one stays; an empty table gives an empty result;
further columns, whatever their names, have no influence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WHITE, durable, numbered, one_of_each, pick, position, row_key

#: Digests that the sketch may propose, and so the bound of the broadcast; counters of each sketch,
#: enough for every digest of HEAVY_SHARE to be among them (a sketch of m counters finds all above
#: 3.5 / m of the rows).
CANDIDATES = 4096
COUNTERS = 16384
#: A proposed digest is heavy if it holds at least this share of the rows.
HEAVY_SHARE = 1 / 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def _ranked() -> Column:
    """Orders the rows of a group: most code points, then doc_id (null last), then any one."""
    return F.struct((-F.col("length")).alias("l"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))


def frequent_digests(rows: DataFrame) -> DataFrame:
    """Digest, true row count and winner of each heavy digest: at most CANDIDATES rows."""
    proposed = (
        rows.selectExpr(f"approx_top_k(hex(digest), {CANDIDATES}, {COUNTERS}) AS top", "count(*) AS rows_in_all")
        .selectExpr("inline(top)", "rows_in_all")
        .select(F.unhex("item").alias("digest"), "rows_in_all")
    )
    return (
        rows.join(F.broadcast(proposed), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.min(_ranked()).alias("winner"), F.max("rows_in_all").alias("rows_in_all"))
        .filter((F.col("group_size") > 1) & (F.col("group_size") >= F.col("rows_in_all") * HEAVY_SHARE))
        .select("digest", "group_size", "winner")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256 (and row_key, if key is given)."""
    source = numbered(docs)[0] if key is not None else pick(docs, id_col, text_col).toDF("c0", "c1")
    at = (position(docs, id_col), position(docs, text_col)) if key is not None else (0, 1)
    doc_id, text = F.col(f"c{at[0]}"), F.col(f"c{at[1]}")
    rows = durable(
        source.select(
            doc_id.alias("doc_id"),
            F.length(F.coalesce(text, F.lit(""))).alias("length"),
            F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
            *([key.alias("row_key")] if key is not None else []),
        ),
        "exact-digests",
    )
    heavy = durable(frequent_digests(rows), "exact-heavy")
    by_map = rows.join(F.broadcast(heavy), "digest").select(*rows.columns, "group_size", "winner")
    group = Window.partitionBy("digest")
    by_shuffle = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        *rows.columns, F.count("*").over(group).alias("group_size"), F.min(_ranked()).over(group).alias("winner")
    )
    return by_map.unionByName(by_shuffle).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *(["row_key"] if key is not None else []),
    )


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows that repeat in full, one."""
    plain, names = numbered(docs)
    stay = exact_duplicates(docs, id_col, text_col, row_key(plain, names)).filter("kept").select("row_key")
    keyed = plain.withColumn("row_key", row_key(plain, names))
    return one_of_each(keyed.join(stay, "row_key", "left_semi"), names).toDF(*docs.columns)


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
       text_sha256
FROM d
"""
