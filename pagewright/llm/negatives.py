"""Hard negatives by inverted lists with centroid radii, pruned by Cauchy-Schwarz bounds.

K-means on a bounded sample gives centroids. Each vector goes to its nearest one, and a list's
vectors into blocks of about BLOCK, each with its radius, the largest distance from the centroid. For
an anchor q, no score in a block lies beyond q.c + |q| r, nor below q.c - |q| r. Anchors are a stated
query set; they meet the lists in chunks of about CHUNK that share near lists, each sent to all
tasks. An anchor first visits the PROBES lists of the highest upper bound, and the kth score found
there rules out all lists, and then blocks, whose upper bound is strictly below it; those that are
left are visited in a second round. Negatives are searched in the same way, in the windows that the
positives' scores open: lists outside a window are skipped. As nothing is skipped that could hold a
result, the result is the one of a full search whatever the centroids.

A task keeps the first k per anchor of all that it visits, so what is shuffled grows with the anchors
and not with the lists. Only the current chunk, its kth scores and the centroids reach the driver.

Scores are exact where the largest squared norm is below 2 ** 53, as for any vectors of moderate
components; beyond, they are nearest doubles, held to 64 bits.

Defined cases: rows with a null label, a null vector, or a component that is null or not finite take
no part; a null vec_id is no anchor, keeps its label and comes last in ties; of rows that repeat each
is a row, and only the anchor's own is not its positive; vectors that are shorter than others count
as if zeros followed; an anchor without other rows of its label has no rows in the result; an empty
table gives an empty result; further columns, whatever their names, have no influence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, pick, shared_path

#: Rows that the centroids are fitted on, at most; centroids, at most; rounds of the fit.
SAMPLE, LISTS, FIT_ROUNDS = 8192, 256, 8
#: Vectors of a block, anchors of a chunk, about; lists of the first round; anchors scored at once.
BLOCK, CHUNK, PROBES, TILE = 2048, 4096, 4, 256
#: Positives of an anchor, negatives of a positive, and the window in hundredths of its score.
POSITIVES, NEGATIVES, LEAST, MOST = 5, 5, 80, 100
#: Components are multiplied by this and rounded down.
SCALE = 256.0
#: What rounding may add to a bound, as a share of it.
SLACK = 1e-9


def relabelled() -> Column:
    """The label, one further (of ten) where 7 divides vec_id."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))


def whole(vectors: list, dim: int) -> np.ndarray:
    """The vectors as rows of whole numbers, filled up with zeros."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(SCALE * np.asarray(v, dtype=np.float64))
    return out


def fit(points: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of k-means from spread first ones."""
    points = np.unique(points, axis=0)
    draw = np.random.default_rng(0)
    chosen = points[draw.permutation(len(points))[: min(lists, len(points))]]
    for _ in range(FIT_ROUNDS):
        own = nearest(points, chosen)[0]
        sums = np.zeros_like(chosen)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(chosen))
        chosen = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], chosen)
    return chosen


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, and the distance from it."""
    own = np.argmax(points @ centroids.T - (centroids**2).sum(axis=1) / 2, axis=1)
    return own, np.sqrt(((points - centroids[own]) ** 2).sum(axis=1))


@dataclass
class Anchors:
    """A chunk of anchors, and what they still ask for: in slot s of anchor a, scores from low[a, s] to
    high[a, s]; visit says of which lists."""

    vectors: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    visit: np.ndarray
    same: bool
    k: int


def first_k(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first k of each anchor and slot: highest score, smallest vec_id (null last)."""
    found = found.sort_values(["anchor", "slot", "score", "absent", "vec_id", "row"], ascending=[True, True, False, True, True, True])
    return found[found.groupby(["anchor", "slot"]).cumcount() < k]


FOUND = "anchor int, slot int, score double, absent boolean, vec_id long, row long"
FOUND_COLUMNS = ["anchor", "slot", "score", "absent", "vec_id", "row"]


def reach(anchors: np.ndarray, centroids: np.ndarray, radius: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """Below and above what no score of a list can lie, by Cauchy-Schwarz."""
    dots, spread = anchors @ centroids.T, np.sqrt((anchors**2).sum(axis=1))[:, None] * radius
    slack = SLACK * (np.abs(dots) + spread) + SLACK
    return dots - spread - slack, dots + spread + slack


def _search(asked: Anchors, centroids: np.ndarray, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def tile(part: np.ndarray, block: dict, low: np.ndarray) -> pd.DataFrame:
        vectors, labels = block["vectors"], block["labels"]
        scores = asked.vectors[part] @ vectors.T
        fits = (scores >= low[part].min(axis=1)[:, None]) & (scores <= asked.high[part].max(axis=1)[:, None])
        fits &= (labels[None, :] == asked.labels[part][:, None]) == asked.same
        a, b = np.nonzero(fits)
        out = []
        for slot in range(low.shape[1]):
            s = scores[a, b]
            ok = (s >= low[part[a], slot]) & (s <= asked.high[part[a], slot])
            if asked.same:
                ok &= block["rows"][b] != asked.rows[part[a]]
            out.append(pd.DataFrame({"anchor": part[a[ok]].astype(np.int32), "slot": np.int32(slot), "score": s[ok], "absent": block["absent"][b[ok]], "vec_id": block["ids"][b[ok]], "row": block["rows"][b[ok]]}))
        return pd.concat(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, state = asked.low.copy(), None
        for batch in batches:
            for r in batch.to_pylist():
                c = r["list"]
                least, most = (x[:, 0] for x in reach(asked.vectors, centroids[c : c + 1], r["radius"]))
                open_ = ((most[:, None] >= low) & (least[:, None] <= asked.high)).any(axis=1)
                who = np.flatnonzero(asked.visit[:, c] & open_)
                if not len(who):
                    continue
                block = {"ids": np.frombuffer(r["ids"], "<i8"), "rows": np.frombuffer(r["rows"], "<i8"), "labels": np.frombuffer(r["labels"], "<i8"), "absent": np.frombuffer(r["absent"], "?")}
                block["vectors"] = np.frombuffer(r["vectors"], kind).reshape(len(block["ids"]), -1).astype(np.float64)
                for k in range(0, len(who), TILE):
                    more = tile(who[k : k + TILE], block, low)
                    if not len(more):
                        continue
                    state = first_k(more if state is None else pd.concat([state, more]), asked.k)
                    n = state.groupby(["anchor", "slot"])["score"].agg(["size", "min"]).reset_index()
                    n = n[n["size"] == asked.k]
                    at = n["anchor"].to_numpy(), n["slot"].to_numpy()
                    low[at] = np.maximum(low[at], n["min"].to_numpy())
        if state is not None and len(state):
            yield pa.RecordBatch.from_pandas(state[FOUND_COLUMNS], preserve_index=False)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and slot, numbered from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "absent", "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass
class Index:
    """The lists' blocks (list, radius, ids, absent, rows, labels, vectors), their centroids and radii,
    the rows with their lists, and the type of a stored component."""

    blocks: DataFrame
    rows: DataFrame
    centroids: np.ndarray
    radii: np.ndarray
    kind: str


def _packed(kind: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["absent", "vec_id", "row"])
        out = {"list": int(pdf["list"].iloc[0]), "radius": float(pdf["distance"].max()), "ids": pdf["vec_id"].to_numpy("<i8").tobytes(), "absent": pdf["absent"].to_numpy("?").tobytes()}
        out |= {"rows": pdf["row"].to_numpy("<i8").tobytes(), "labels": pdf["label"].to_numpy("<i8").tobytes(), "vectors": b"".join(pdf["vector"])}
        return pd.DataFrame([out])

    return pack


def index_of(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Index | None:
    """The inverted lists of all vectors that take part; None if there are none."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = pick(vectors, id_col, vector_col, label_col).toDF("vec_id", "embedding", "label").filter("label is not null and embedding is not null")
    rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>")).filter(finite)
    rows = durable(rows.select(F.col("vec_id").cast("long").alias("vec_id"), relabelled().alias("label"), "embedding", F.monotonically_increasing_id().alias("row")), "negatives-rows")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"), F.max(F.coalesce(F.array_max(F.transform("embedding", lambda x: F.abs(x))), F.lit(0.0))).alias("most")).first()
    if not facts["n"]:
        return None
    dim, most = max(1, facts["dim"]), SCALE * facts["most"] + 1
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
    sample = rows.select("embedding", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE).collect()
    centroids = fit(whole([r["embedding"] for r in sample], dim), min(LISTS, int(np.ceil(np.sqrt(facts["n"])))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = whole([v.values.to_numpy(zero_copy_only=False) for v in batch.column("embedding")], dim)
            own, distance = nearest(points, centroids)
            ids = batch.column("vec_id")
            packed = pa.array([v.tobytes() for v in points.astype(kind)], pa.binary())
            yield pa.RecordBatch.from_arrays([ids.fill_null(0), ids.is_null(), batch.column("label"), batch.column("row"), pa.array(own.astype(np.int32)), pa.array(distance), packed], names=["vec_id", "absent", "label", "row", "list", "distance", "vector"])

    placed = durable(rows.mapInArrow(assign, "vec_id long, absent boolean, label long, row long, list int, distance double, vector binary"), "negatives-placed")
    lists = placed.groupBy("list").agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
    known = {r["list"]: r for r in lists.collect()}  # at most LISTS
    radii = np.array([known[c]["radius"] if c in known else 0.0 for c in range(len(centroids))])
    pieces = F.ceil(F.col("n") / BLOCK)
    blocks = placed.join(F.broadcast(lists.select("list", pieces.alias("pieces"))), "list").withColumn("block", F.pmod(F.xxhash64("row"), F.col("pieces")))
    schema = "list int, radius double, ids binary, absent binary, rows binary, labels binary, vectors binary"
    return Index(durable(blocks.groupBy("list", "block").applyInPandas(_packed(kind), schema), "negatives-lists"), placed, centroids, radii, kind)


def _chunks(index: Index, every: int) -> tuple[DataFrame, int]:
    """The anchors with a chunk each, about CHUNK of one: lists in turn fill chunks, large lists are
    dealt to several by hash. And the number of chunks."""
    anchors = index.rows.filter((~F.col("absent")) & (F.col("vec_id") % every == 0))
    plan, chunk, room = [], -1, 0
    for r in sorted(anchors.groupBy("list").agg(F.count("*").alias("n")).collect()):  # at most LISTS
        if r["n"] > room:
            chunk, room = chunk + 1, CHUNK
        parts = -(-r["n"] // CHUNK)
        plan.append((r["list"], chunk, parts))
        chunk, room = chunk + parts - 1, (room - r["n"] if parts == 1 else 0)
    table = F.broadcast(anchors.sparkSession.createDataFrame(plan, "list int, chunk long, parts long"))
    dealt = anchors.join(table, "list").withColumn("chunk", F.col("chunk") + F.pmod(F.xxhash64("row", F.lit("chunk")), F.col("parts")))
    return durable(dealt.select("vec_id", "label", "row", "vector", "chunk"), "negatives-anchors"), chunk + 1


def _rounds(index: Index, asked: Anchors, label: str) -> DataFrame:
    """The first k of every slot: the PROBES lists of the highest upper bound first, then the others
    that may still hold one."""
    least, most = reach(asked.vectors, index.centroids, index.radii[None, :])

    def visited(visit: np.ndarray) -> DataFrame:
        asked.visit = visit
        lists = [int(c) for c in np.flatnonzero(visit.any(axis=0))]
        return durable(index.blocks.filter(F.col("list").isin(lists)).mapInArrow(_search(asked, index.centroids, index.kind), FOUND), label)

    def may(low: np.ndarray) -> np.ndarray:
        out = np.zeros(most.shape, dtype=bool)
        for s in range(low.shape[1]):
            out |= (most >= low[:, s : s + 1]) & (least <= asked.high[:, s : s + 1])
        return out

    wanted = may(asked.low)
    best = np.argsort(-np.where(wanted, most, -np.inf), axis=1, kind="stable")[:, :PROBES]
    probes = np.zeros_like(wanted)
    np.put_along_axis(probes, best, True, axis=1)
    found = visited(probes & wanted)
    kth = _ranked(found, asked.k).filter(F.col("rank") == asked.k).select("anchor", "slot", "score").toPandas()  # one row per slot of the chunk
    at = kth["anchor"].to_numpy(), kth["slot"].to_numpy()
    asked.low = asked.low.copy()
    asked.low[at] = np.maximum(asked.low[at], kth["score"].to_numpy())
    rest = may(asked.low) & ~probes
    if rest.any():
        found = found.unionByName(visited(rest))
    return _ranked(found, asked.k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id every divides; their positives are the first rows of their label;
    each positive's negatives are the first rows of other labels whose scores are from least to most
    hundredths of its score."""
    spark = vectors.sparkSession
    index = index_of(vectors, id_col, vector_col, label_col)
    anchors, chunks = _chunks(index, every) if index else (None, 0)
    if not chunks:
        return spark.createDataFrame([], RESULT)
    out = shared_path(spark, "negatives")
    for chunk in range(chunks):
        mine = anchors.filter(F.col("chunk") == chunk).orderBy("row").toPandas()
        if not len(mine):
            continue
        points = np.frombuffer(b"".join(mine["vector"]), index.kind).reshape(len(mine), -1).astype(np.float64)
        n, never = len(mine), np.zeros((0, 0), dtype=bool)
        asked = Anchors(points, mine["label"].to_numpy(), mine["row"].to_numpy(), np.full((n, 1), -np.inf), np.full((n, 1), np.inf), never, True, positives)
        pos = durable(_rounds(index, asked, "negatives-same"), "negatives-positives")
        known = pos.select("anchor", "rank", "score").toPandas()  # positives per anchor of the chunk
        at = known["anchor"].to_numpy(), known["rank"].to_numpy() - 1
        low, high = np.full((n, positives), np.inf), np.full((n, positives), -np.inf)
        scores = known["score"].to_numpy()
        low[at], high[at] = np.ceil(np.where(scores < 2.0**53, least * scores / 100, scores)), np.floor(most * scores / 100)
        asked = Anchors(points, asked.labels, asked.rows, low, high, never, False, negatives)
        neg = _rounds(index, asked, "negatives-other")
        ids = F.broadcast(spark.createDataFrame([(i, int(v)) for i, v in enumerate(mine["vec_id"])], "anchor int, anchor_id long"))
        own = pos.select("anchor", (F.col("rank") - 1).alias("slot"), F.when(~F.col("absent"), F.col("vec_id")).alias("positive_id"), F.col("score").cast("long").alias("positive_score"))
        other = neg.select("anchor", "slot", "rank", F.when(~F.col("absent"), F.col("vec_id")).alias("negative_id"), F.col("score").cast("long").alias("negative_score"))
        own.join(other, ["anchor", "slot"]).join(ids, "anchor").selectExpr("anchor_id", "positive_id", "cast(rank as int) as rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(out)
    return spark.read.schema(RESULT).parquet(out)


OP13_SQL = """
WITH e AS (SELECT vec_id, row_number() OVER () AS row, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.row AS anchor, b.row, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.row <> b.row WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS n FROM s WHERE same QUALIFY n <= 5),
q AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM q WHERE rank <= 5
"""
