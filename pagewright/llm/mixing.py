"""Mixing sources to target weights by balanced sampling with the cube method.

Each source's target is a share of FACTOR times all words, by weight, capped at COPIES times the
source's own words; the excess goes to the others by weight until none is above its cap. A document
of a source with target t and size s is wanted t/s times: the whole part is taken at once, the
fraction is an inclusion probability. The flight phase moves the probabilities of a block of
documents inside the null space of two constraints, words and documents, until all but two are 0
or 1; what is left of all blocks meets again in blocks, until one block per source is left. Its
landing problem, a handful of documents, is settled by trying all choices. So each source's taken
words differ from its target by about one document.

Blocks are a hash of the row and of its number among rows that repeat it, so that one source, or one
row, with a third of all rows is spread over many tasks; each block has its own seed, so reruns
agree whatever the partitions. Sources stay in Spark too, however many there are: the cap of all
sources is found by a few sums over them, and facts about sources reach their rows through a join
that splits the large ones.

Defined cases: null and blank texts have size 0 and no words to take; a null source is a source of
its own and comes last; rows that repeat are separate units; a source without words has target 0;
an empty table gives an empty result; further columns have no influence.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, durable, numbered, one_of_each, pick, position, row_key, salted_join

# The weights of the sources in order, the share of all words, the bound of copies.
WEIGHTS = (3, 1, 2)
FACTOR = 1.5
COPIES = 2

#: Documents of a block of the flight phase.
BLOCK = 512
CONSTRAINTS = 2
EDGE = 1e-9


#: Copies of a repeated row that one row of an intermediate table stands for.
COPIES_EACH = 4096

def flight(probability: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Probabilities after the flight phase: all but at most two are 0 or 1, the sums of
    probability and of probability times size are as before."""
    p = probability.astype(float).tolist()
    x = size.astype(float).tolist()
    draw = np.random.default_rng(seed).random(2 * len(p) + 8).tolist()
    open_units = [i for i, v in enumerate(p) if EDGE < v < 1 - EDGE]
    held, rest, d = open_units[: CONSTRAINTS + 1], open_units[CONSTRAINTS + 1 :][::-1], 0
    while len(held) == CONSTRAINTS + 1:
        a, b, c = held
        # u with u_a + u_b + u_c = 0 and the sizes' sum 0
        u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(held, u, strict=True) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(held, u, strict=True) if v)
        step = up if draw[d % len(draw)] * (up + down) < down else -down
        d += 1
        for i, v in zip(held, u, strict=True):
            p[i] += step * v
        still = []
        for i in held:
            if p[i] <= EDGE:
                p[i] = 0.0
            elif p[i] >= 1 - EDGE:
                p[i] = 1.0
            else:
                still.append(i)
        while len(still) <= CONSTRAINTS and rest:
            still.append(rest.pop())
        held = still
    return np.array(p)


def landing(probability: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0 or 1 for the few that are left: the choice whose words, then documents, are nearest."""
    p = probability.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    words, count = float((p[left] * size[left]).sum()), float(p[left].sum())
    choices = (np.array([(k >> j) & 1 for j in range(len(left))], dtype=float) for k in range(1 << len(left)))
    best = min(choices, key=lambda c: (round(abs(float((c * size[left]).sum()) - words), 6), abs(c.sum() - count), tuple(c)))
    p[left] = best
    return settle(p, size, float((probability * size).sum()))


#: Rounds of settle(): each brings the words nearer, or is the last.
SETTLE_ROUNDS = 16


def settle(chosen: np.ndarray, size: np.ndarray, words: float) -> np.ndarray:
    """Flips one unit of the block, or swaps a taken and an untaken one, while that brings its words nearer."""
    p = chosen.copy()
    for _ in range(SETTLE_ROUNDS):
        inside, outside = np.flatnonzero(p == 1), np.flatnonzero(p == 0)
        error = float((p * size).sum()) - words
        change = np.concatenate([-size[inside], size[outside], (size[outside][None, :] - size[inside][:, None]).ravel()]).astype(float)
        k = int(np.argmin(np.abs(error + change))) if len(change) else 0
        if not len(change) or abs(error + change[k]) >= abs(error):
            break
        single = len(inside) + len(outside)
        flips = [np.concatenate([inside, outside])[k]] if k < single else [inside[(k - single) // len(outside)], outside[(k - single) % len(outside)]]
        p[flips] = 1 - p[flips]
    return p


def _block(last: bool) -> Callable[[pa.Table], pa.Table]:
    """Decides a block; in Arrow, as ids of 64 bits beside a null one would not survive pandas."""

    def decide(block: pa.Table) -> pa.Table:
        block = block.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("key", "ascending")])
        size = block["size"].to_numpy()
        p = flight(block["p"].to_numpy(), size, block["order"][0].as_py() & 0xFFFFFFFF)
        return block.set_column(block.schema.get_field_index("p"), "p", pa.array(landing(p, size) if last else p, pa.float64()))

    return decide


def _ranked(sums: DataFrame) -> DataFrame:
    """sums with place, the sources' place by code point, null last, from 0: a range partition each,
    numbered within it, and the partitions' offsets, of which there are as many as partitions."""
    ordered = durable(sums.withColumn("absent", F.col("source").isNull()).repartitionByRange("absent", "source").withColumn("part", F.spark_partition_id()), "mix-sources")
    within = F.row_number().over(Window.partitionBy("part").orderBy("absent", "source"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("offset"))
    return ordered.withColumn("within", within).join(F.broadcast(offsets), "part").withColumn("place", F.col("within") + F.col("offset") - 1).drop("within", "offset", "part", "absent")


def source_targets(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, factor: float = FACTOR, copies: float = COPIES) -> DataFrame:
    """source, source_size, target, times (target by size): one row per source.

    A source's target is level * weight, but at most copies times its size. The level rises from one
    round to the next as more sources are at their cap; when no further one is, it is the right one.
    Only sums reach the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    known = durable(_ranked(units.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn("weight", weight), "mix-weights")
    cap = copies * F.col("source_size")
    total = factor * float(known.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, at_cap = 0.0, -1
    while True:
        capped = cap <= level * F.col("weight")
        found = known.agg(F.count_if(capped).alias("n"), F.sum(F.when(capped, F.col("source_size")).otherwise(0)).alias("size"), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("free")).first()
        if found["n"] == at_cap or not found["free"]:
            break
        at_cap, level = found["n"], (total - copies * (found["size"] or 0)) / found["free"]
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight")) if found["free"] else cap.cast("double")
    return known.select("source", "source_size", target.alias("target")).withColumn("times", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def by_source(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """rows joined with facts about their sources; the null source is one like all others."""
    key = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("of_source")]
    return salted_join(rows.select("*", *key), facts.select(*key, "*").drop("source"), ["no_source", "of_source"], F.xxhash64("order"), "inner").drop("no_source", "of_source")


def _copies(units: DataFrame) -> DataFrame:
    """units with copy, the number of a row among those that repeat it, and order, a hash of both.
    Repeated rows are counted with map-side combining and dealt out again by COPIES_EACH."""
    counted = units.groupBy(*units.columns).agg(F.count("*").alias("n"))
    lots = counted.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES_EACH))))
    lots = lots.repartition(*units.columns, "lot")
    here = F.sequence(F.col("lot") * COPIES_EACH, F.least(F.col("n"), (F.col("lot") + 1) * COPIES_EACH) - 1)
    return lots.withColumn("copy", F.explode(here)).drop("n", "lot").withColumn("order", F.xxhash64("doc_id", "key", "copy", F.lit(7)))


def sample(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, factor: float = FACTOR, copies: float = COPIES) -> DataFrame:
    """units (doc_id, source, size, key) with source_size, target and how often each is taken.

    Units are written once with their probabilities; every level reads what the one before left open.
    """
    units = durable(_copies(units), "mix-units")
    whole = F.floor(F.col("times") + EDGE)
    flying = by_source(units, source_targets(units, weights, factor, copies)).withColumns({"whole": whole.cast("int"), "p": F.greatest(F.col("times") - whole, F.lit(0.0))})
    names = ("doc_id", "source", "size", "key", "source_size", "target", "whole", "p", "order")
    schema = "doc_id long, source string, size long, key string, source_size long, target double, whole int, p double, order long, block long"
    is_open = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    started = durable(flying.select(*names), "mix-start")
    settled, flying, level = [started.filter(~is_open)], started.filter(is_open), 0
    while True:
        counted = durable(flying.groupBy("source").agg(F.count("*").alias("open")), "mix-open")
        last = (counted.agg(F.max("open")).first()[0] or 0) <= BLOCK
        blocks = counted.select("source", F.ceil(F.col("open") / BLOCK).alias("blocks"))
        dealt = by_source(flying, blocks).withColumn("block", F.pmod(F.xxhash64("order", F.lit(level)), F.col("blocks")))
        flown = durable(dealt.select(*names, "block").groupBy("source", "block").applyInArrow(_block(last), schema).select(*names), f"mix-{level}")
        if last:
            settled.append(flown)
            break
        settled.append(flown.filter(~is_open))
        flying = flown.filter(is_open)
        level += 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    times = F.when(F.col("size") > 0, F.col("whole") + F.round("p").cast("int")).otherwise(0)
    return out.select("doc_id", "source", "size", "key", "source_size", "target", times.alias("times"))


def units_of(rows: DataFrame, doc_id: Column, source: Column, text: Column, key: Column) -> DataFrame:
    return rows.select(
        doc_id.cast("long").alias("doc_id"), source.alias("source"), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long").alias("size"), key.alias("key")
    )


def mix_report(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of docs."""
    rows = pick(docs, id_col, source_col, text_col).toDF("doc_id", "source", "text")
    units = units_of(rows, F.col("doc_id"), F.col("source"), F.col("text"), row_key(rows, rows.columns))
    return sample(units).select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of docs that the mix takes, a row taken twice being there twice, with all columns."""
    plain, names = numbered(docs)
    at = {c: F.col(f"c{position(docs, c)}") for c in (id_col, source_col, text_col)}
    keyed = plain.withColumn("row_key", row_key(plain, names))
    units = units_of(keyed, at[id_col], at[source_col], at[text_col], F.col("row_key"))
    times = sample(units).groupBy("key").agg(F.sum("times").alias("times")).filter("times > 0").select(F.col("key").alias("row_key"), "times")
    joined = one_of_each(keyed.join(times, "row_key"), [*names, "times"])
    again = joined.select(*names, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return again.select(*names).toDF(*docs.columns)
