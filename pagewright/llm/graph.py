"""Connected components of an edge table by alternating star contractions, all in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, HOT_SHARE, discard, durable


def _star(edges: DataFrame, large: bool, size: int) -> DataFrame:
    """Points each node's larger (large star) or smaller (small star) neighbours to the least node
    of its neighbourhood. A node's least neighbour is aggregated map-side and joined back; those of
    nodes with a large share of all arcs, of which size bounds the number, are broadcast, so that a
    hub's arcs are never gathered in one place. The large star may repeat an edge."""
    if large:
        arcs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        arcs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    around = arcs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
    hubs = F.broadcast(around.filter(F.col("n") >= max(size * HOT_SHARE, HOT_ROWS)).select("u", "m"))
    least = around.select("u", "m")
    joined = arcs.join(hubs.select("u"), "u", "left_anti").join(least, "u").unionByName(arcs.join(hubs, "u"))
    if large:
        return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")
    out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, root for every node of edges (a, b); the root is the least node of the component.

    The stars have settled when a large one changes nothing and each node has one smaller neighbour."""
    edges = durable(edges.filter("a <> b").select("a", "b").distinct(), label)
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"), F.count_distinct("a").alias("nodes"))
    before = edges.select(mark.alias("x")).first()["x"]
    while before["n"]:  # each star is written, as the next reads its edges several times
        size = 2 * before["n"]
        pointed = durable(_star(edges, True, size), label)
        now = pointed.select(mark.alias("x")).first()["x"]
        if now == before and now["n"] == now["nodes"]:
            break
        later = durable(_star(pointed, False, size), label)
        discard(edges)
        discard(pointed)
        edges, before = later, later.select(mark.alias("x")).first()["x"]
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
