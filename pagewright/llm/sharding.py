"""Shards by vector bin packing: bytes, tokens and rows are balanced jointly.

Groups are equal texts. A group that holds at least 1/CELLS of any total is an item of its own;
all other groups fall, by a hash of their text, into CELLS cells, each an item. So the driver packs
at most 4 * CELLS items and their pieces, whatever the number of rows: largest first, each into the
shard where the dot product of the item with the shard's residual capacity is highest. A group that
exceeds a shard's capacity in some dimension is split into pieces first, by a number that each row
gets in a durable table, so that rows that repeat, or have no doc_id, are split like all others;
all other groups stay whole. Swaps between the fullest and the emptiest shard then even out what the greedy order
left. Slots number a shard's rows from 0 without gaps, from counts of small sub-cells.

The law that holds is `bytes`: sizes (UTF-8 bytes plus 1) are near equal.

Defined cases: null text has no bytes and is equal to empty text; a null doc_id is a value like any
other and comes first among a sub-cell's slots; rows that repeat each get a slot; an empty table
gives an empty result; further columns have no influence.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, durable, pick

SHARDS = 8
#: Cells of ordinary groups, and so the bound of what the driver packs. Rows of a sub-cell, at most
#: (as shares of all rows), when slots are numbered.
CELLS = 4096
SUB_SHARE = 1 / 1024

GROUP = ("g1", "g2", "g3")
DIMENSIONS = ("bytes", "tokens", "rows")


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item. items: one row of shares (of the totals) per item."""
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    place = np.zeros(len(items), dtype=np.int64)
    for i in np.lexsort((np.arange(len(items)), -items.sum(axis=1), -items.max(axis=1))):
        # a shard that is full in some dimension has a negative residual there, which repels
        place[i] = int(np.argmax(residual @ items[i]))
        residual[place[i]] -= items[i]
    return place


def even_out(items: np.ndarray, place: np.ndarray, shards: int, rounds: int = 200, enough: float = 1e-5) -> np.ndarray:
    """Swaps items between the shards of most and of fewest bytes while that lessens the squared
    deviations of all dimensions, bytes counting most. At most rounds swaps."""
    place = place.copy()
    load = np.zeros((shards, items.shape[1]))
    np.add.at(load, place, items)
    weight = np.array([9.0, 1.0, 1.0])
    for _ in range(rounds):
        high, low = int(np.argmax(load[:, 0])), int(np.argmin(load[:, 0]))
        if load[high, 0] - load[low, 0] <= enough:
            break
        a, b = np.flatnonzero(place == high), np.flatnonzero(place == low)
        if not len(a) or not len(b):
            break
        moved = items[a][:, None, :] - items[b][None, :, :]
        centre = load.mean(axis=0)
        now = (weight * ((load[high] - centre) ** 2 + (load[low] - centre) ** 2)).sum()
        then = (weight * ((load[high] - centre - moved) ** 2 + (load[low] - centre + moved) ** 2)).sum(axis=2)
        i, j = np.unravel_index(int(np.argmin(then)), then.shape)
        if then[i, j] >= now * (1 - 1e-9):
            break
        load[high] -= moved[i, j]
        load[low] += moved[i, j]
        place[a[i]], place[b[j]] = low, high
    return place


def _item(heavy_first: Column, pieces: Column) -> Column:
    piece = F.pmod(F.xxhash64("row", F.lit("piece")), pieces)
    return F.when(heavy_first.isNotNull(), heavy_first + piece).otherwise(F.pmod("g1", F.lit(CELLS))).cast("long")


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, tokens, text_crc32, law, shard, slot, grown_shard for each row of docs."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = durable(
        pick(docs, id_col, text_col).toDF("doc_id", "text").select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(text) + 1).cast("long").alias("bytes"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("g2"),
            F.xxhash64(text).alias("g1"),
            F.xxhash64(text, F.lit("second")).alias("g3"),
        ),
        "shard-rows",
    )
    total = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "tokens")], F.count("*").alias("rows")).first()
    scale = np.array([max(1, total[d]) for d in DIMENSIONS], dtype=float)
    groups = rows.groupBy(*GROUP).agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    over = [F.col(d) >= float(max(2.0, s / CELLS)) for d, s in zip(DIMENSIONS, scale, strict=True)]
    # at most CELLS groups can hold 1/CELLS of a total: at most 3 * CELLS rows come here
    heavy = groups.filter((F.col("rows") > 1) & (over[0] | over[1] | over[2]) | over[0] & (F.col("bytes") > float(scale[0] / CELLS))).collect()
    heavy.sort(key=lambda r: (-r["bytes"], r["g1"], r["g2"], r["g3"]))
    table, first = [], CELLS
    for r in heavy:
        share = max(r[d] / s for d, s in zip(DIMENSIONS, scale, strict=True))
        pieces = 1 if share <= 1 / shards else int(np.ceil(share * shards * 4))
        table.append((r["g1"], r["g2"], r["g3"], first, pieces))
        first += pieces
    known = spark.createDataFrame(table, "g1 long, g2 long, g3 long, first long, pieces long")
    placed = rows.join(F.broadcast(known), list(GROUP), "left").withColumn("item", _item(F.col("first"), F.col("pieces")))
    sums = placed.groupBy("item").agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).collect()
    sums.sort(key=lambda r: r["item"])
    vectors = np.array([[r[d] for d in DIMENSIONS] for r in sums], dtype=float).reshape(len(sums), 3) / scale
    least = max(1.0, scale[2] * SUB_SHARE)
    plan = [(r["item"], int(s), max(1, int(np.ceil(r["rows"] / least)))) for r, s in zip(sums, even_out(vectors, pack(vectors, shards), shards), strict=True)]
    placement = F.broadcast(spark.createDataFrame(plan, "item long, shard int, subs long"))
    dealt = placed.join(placement, "item").withColumn("sub", F.pmod(F.xxhash64("row", F.lit("sub")), F.col("subs")))
    counts = dealt.groupBy("shard", "item", "sub").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("item", "sub").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("item", "sub", F.coalesce(before, F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("item", "sub").orderBy("doc_id", "row")) - 1
    numbered = dealt.select("doc_id", "bytes", "tokens", "g2", "shard", "item", "sub", own.alias("own"))
    return numbered.join(offsets, ["item", "sub"]).select(
        "doc_id",
        F.col("bytes").alias("size"),
        "tokens",
        F.col("g2").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("own") + F.col("offset")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
