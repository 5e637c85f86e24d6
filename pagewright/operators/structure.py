"""Structural joins: elements as intervals (doc_id, ord, end_ord), in which whole subtrees lie.

A pairing of elements with what is around, before or inside them would make a row per pair, which
grows with the square of a page. Here both sides are put in page order once, as events, and a window
carries what is needed along: prefix sums, the last mark seen, or the depth of the open marks. So
each function is linear in its inputs, with one exchange by doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _events(rows: DataFrame, at: str | Column, kind: int, **payload: Column) -> DataFrame:
    """An event of a kind at a place for each row. At one place, lower kinds come first."""
    return rows.select("doc_id", (F.col(at) if isinstance(at, str) else at).alias("at"), F.lit(kind).alias("kind"), *[c.alias(n) for n, c in payload.items()])


def _whole(rows: DataFrame) -> Column:
    return F.struct(*rows.columns)


def nearest(rows: DataFrame, marks: DataFrame, payload: list[str], name: str, after: bool = False) -> DataFrame:
    """rows with name: payload, as a struct, of the last mark before each one in its document, or with
    after of the first one after it; null if there is none. A row is no mark of its own."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("at") if after else F.asc("at"), "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = _events(rows, "ord", 0, row=_whole(rows)).unionByName(_events(marks, "ord", 1, mark=F.struct(*payload)), allowMissingColumns=True)
    return both.withColumn("mark", F.last("mark", ignorenulls=True).over(order)).filter("kind = 0").select("row.*", F.col("mark").alias(name))


def first_inside(intervals: DataFrame, points: DataFrame, payload: list[str], name: str) -> DataFrame:
    """intervals with name: payload of the first point inside each; null if there is none."""
    found = nearest(intervals, points, ["ord", *[p for p in payload if p != "ord"]], "inside_first", after=True)
    return found.select(*intervals.columns, F.when(F.col("inside_first.ord") <= F.col("end_ord"), F.struct(*[F.col(f"inside_first.{p}").alias(p) for p in payload])).alias(name))


def sums_inside(intervals: DataFrame, points: DataFrame, **sums: Column) -> DataFrame:
    """intervals with the sum of each column over the points inside them, as long; 0 if there are
    none. Sums up to an interval's end less those up to its begin are those inside."""
    order = Window.partitionBy("doc_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = _whole(intervals)
    both = _events(points, "ord", 0, **{f"sum_{n}": c.cast("long") for n, c in sums.items()})
    for at, sign in (("ord", -1), ("end_ord", 1)):
        both = both.unionByName(_events(intervals, at, 1, interval=F.col("ord"), sign=F.lit(sign), row=own), allowMissingColumns=True)
    running = both.withColumns({f"sum_{n}": F.coalesce(F.sum(f"sum_{n}").over(order), F.lit(0)) for n in sums}).filter("kind = 1")
    found = running.groupBy("doc_id", "interval").agg(F.first("row").alias("row"), *[F.sum(F.col("sign") * F.col(f"sum_{n}")).alias(n) for n in sums])
    return found.select("row.*", *sums)


def innermost(rows: DataFrame, marks: DataFrame, payload: list[str], name: str) -> DataFrame:
    """rows with name: payload of the innermost of marks (doc_id, ord, end_ord) around each; null if
    there is none. As intervals never cross, the mark around a row under n open ones is the last one
    that began under n - 1."""
    order = Window.partitionBy("doc_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = _events(rows, "ord", 0, step=F.lit(0), row=_whole(rows))
    both = both.unionByName(_events(marks, "ord", 1, step=F.lit(1), mark=F.struct(*payload)), allowMissingColumns=True)
    both = both.unionByName(_events(marks, "end_ord", 2, step=F.lit(-1)), allowMissingColumns=True)
    deep = both.withColumn("depth", F.sum("step").over(order)).filter("kind < 2")
    level = Window.partitionBy("doc_id", "depth").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return deep.withColumn("mark", F.last("mark", ignorenulls=True).over(level)).filter("kind = 0").select("row.*", F.when(F.col("depth") > 0, F.col("mark")).alias(name))


def with_text(rows: DataFrame, e: DataFrame, name: str = "text") -> DataFrame:
    """rows (doc_id, text_in, text_at, text_length) with their whole text, read from the buffers of the
    element table e: a page's own, or that of the script, style or template they are in."""
    pages = e.filter("page_text is not null").select("doc_id", "page_text")
    own = e.filter("own_text is not null").select("doc_id", F.col("ord").alias("text_in"), "own_text")
    names = [c for c in rows.columns if c != name]
    held = rows.select(*names).join(pages, "doc_id", "left").join(own, ["doc_id", "text_in"], "left")
    buffer = F.when(F.col("text_in").isNull(), F.col("page_text")).otherwise(F.col("own_text"))
    return held.select(*names, F.coalesce(F.substring(buffer, F.col("text_at") + 1, F.col("text_length")), F.lit("")).alias(name))
