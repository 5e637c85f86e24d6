"""Merkle manifest of a table: a tree per group, a tree over the groups' roots, and a proof per row.

Leaves are digests that Spark computes once and writes; from then on no text is read. They are
range-partitioned by group, order and digest, so a group of any size is spread over many tasks.
Each task tells its first and last group and their counts, which give every partition's offset in
its group; the driver holds a few numbers per partition, never any of a row. Knowing its offset, a
task builds the complete aligned subtrees of its leaves. Nodes whose sibling lies in another
partition, at most two per level, are shuffled by coordinate: STEP levels at a time, all nodes
below one ancestor meet, at most 2 ** STEP. The groups' roots, numbered in order, are the leaves of
one more tree, which the same rounds finish. A second pass over the sorted leaves gives each its
siblings in its task, and a join on the coordinate of its subtree the ones above.

H is SHA-256 of the concatenated inputs, digests as lowercase hex text. Two consecutive nodes
become their H, the last one of an odd level alone its own, until one is left.

Defined cases: a null field is "-" in its leaf; rows with null order come first in their group,
those with a null group are a group that comes first; ties of group and order stand by leaf, and
rows that repeat have equal leaves, each with a proof of its own place; a group of one row has its
leaf as root; texts of any length are hashed whole; an empty table gives an empty result; further
columns, whatever their names, have no influence.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, pick

#: Leaves of a partition, at most about; levels that a round of the boundary nodes climbs.
LEAVES_EACH, STEP = 1 << 18, 16
#: Boundary nodes that may be broadcast (each about a kilobyte at most); more are joined by shuffle.
BROADCAST_NODES = 4096
#: Bytes of a step of a path: the side of the sibling (0: none, 1: left, 2: right) and its digest.
STEP_BYTES = 33
NONE = bytes(STEP_BYTES)

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*digests: bytes) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def leaf_of(*fields: Column) -> Column:
    """The digest of fields: each "-" if null, else its UTF-8 bytes' count, a colon and its value."""
    parts = [F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Place(NamedTuple):
    """What a partition must know: the number of its first group, how many of that group's leaves
    come before, and the sizes of its first and last group."""

    group: int
    offset: int
    first_size: int
    last_size: int


Edges = tuple[int, bytes, int, bytes, int, int]


def edges_of(part: int, rows: Iterable) -> Iterator[Edges]:
    """part, and its first and last group's key and count, and the number of its groups."""
    found: list[tuple[bytes, int]] = []
    n = 0
    for group, members in itertools.groupby(rows, key=lambda r: r["tree"]):
        n += 1
        key = b"" if group is None else hashlib.sha256(group.encode()).digest()
        found[1:] = [(key, sum(1 for _ in members))]
    if n:
        yield part, *found[0], *found[-1], n


def places(edges: list[Edges]) -> tuple[dict[int, Place], int]:
    """The Place of each partition that has rows, and the number of groups."""
    group, before = -1, 0
    last: bytes | None = None
    sizes: dict[int, int] = {}
    begun: list[tuple[int, int, int, int]] = []
    for part, first, n_first, end, n_end, groups in sorted(edges):
        if first != last:
            group, before = group + 1, 0
        begun.append((part, group, before, group + groups - 1))
        sizes[group] = sizes.get(group, 0) + n_first
        if groups > 1:
            group += groups - 1
            sizes[group] = n_end
        before, last = sizes[group], end
    return {p: Place(g, b, sizes[g], sizes[e]) for p, g, b, e in begun}, group + 1


class Piece:
    """Consecutive leaves of a tree of size leaves, from offset on, and what they determine."""

    def __init__(self, leaves: list[bytes], offset: int, size: int) -> None:
        self.size, self.runs = size, [(offset, leaves)]
        n = size
        while n > 1:
            begin, nodes = self.runs[-1]
            end = begin + len(nodes)
            first, past = (begin + 1) // 2, (end + 1) // 2 if end == n else end // 2
            if past <= first:
                break
            self.runs.append((first, [h(*nodes[2 * p - begin : 2 * p + 2 - begin]) for p in range(first, past)]))
            n = (n + 1) // 2

    def tops(self) -> Iterator[tuple[int, int, bytes]]:
        """Level, place and digest of the nodes whose parents are not determined here."""
        for level, (begin, nodes) in enumerate(self.runs):
            above, parents = self.runs[level + 1] if level + 1 < len(self.runs) else (0, [])
            ends = {begin, begin + len(nodes) - 1} if parents else range(begin, begin + len(nodes))
            for at in sorted(ends):
                if not above <= at // 2 < above + len(parents):
                    yield level, at, nodes[at - begin]

    def path(self, at: int) -> tuple[int, int, bytes]:
        """Level and place of the top over a leaf, and the steps up to it."""
        steps, level = [], 0
        while level + 1 < len(self.runs):
            above, parents = self.runs[level + 1]
            if not above <= at // 2 < above + len(parents):
                break
            begin, nodes = self.runs[level]
            other = (at ^ 1) - begin
            steps.append((b"\1" if at & 1 else b"\2") + nodes[other] if other < len(nodes) else NONE)
            at, level = at // 2, level + 1
        return level, at, b"".join(steps)


def _pieces(place: Place, rows: Iterable) -> Iterator[tuple[int, list, Piece]]:
    """Each group of a partition: its number, its rows, and their piece of its tree."""
    waiting: tuple[int, list] | None = None
    number = place.group

    def piece(number: int, members: list, last: bool) -> tuple[int, list, Piece]:
        first = number == place.group
        size = place.first_size if first else place.last_size if last else len(members)
        return number, members, Piece([bytes(r["leaf"]) for r in members], place.offset if first else 0, size)

    for _, members in itertools.groupby(rows, key=lambda r: r["tree"]):
        if waiting:
            yield piece(*waiting, False)
        waiting = (number, list(members))
        number += 1
    if waiting:
        yield piece(*waiting, True)


def _tops(known: dict[int, Place]) -> Callable[[int, Iterable], Iterator[tuple]]:
    def run(part: int, rows: Iterable) -> Iterator[tuple]:
        if part in known:
            for number, _, piece in _pieces(known[part], rows):
                for level, at, digest in piece.tops():
                    yield number, piece.size, level, at, bytearray(digest)

    return run


def _paths(known: dict[int, Place], carried: list[str]) -> Callable[[int, Iterable], Iterator[tuple]]:
    def run(part: int, rows: Iterable) -> Iterator[tuple]:
        if part in known:
            for number, members, piece in _pieces(known[part], rows):
                begin = piece.runs[0][0]
                for k, row in enumerate(members):
                    level, at, steps = piece.path(begin + k)
                    yield number, level, at, bytearray(steps), begin + k, row["leaf"], *[row[c] for c in carried]

    return run


NODE = "tree long, size long, level int, at long, digest binary"
LINK = f"{NODE}, up_level int, up_at long, steps binary"


def climb(nodes: list[tuple[int, int, bytes]], size: int, height: int) -> tuple[dict[tuple[int, int], bytes], tuple[int, int, bytes]]:
    """From the nodes (level, place, digest) that cover one ancestor's leaves: the steps from each up
    to the ancestor, at this height or the root, and the ancestor."""
    known = {(level, at): digest for level, at, digest in nodes}
    height = min(height, (size - 1).bit_length())
    order = [sorted(a for lv, a in known if lv == level) for level in range(height)]
    for level in range(height):
        n = -(-size >> level)
        made = sorted({a // 2 for a in order[level]})
        for p in made:
            pair = [known[level, a] for a in (2 * p, 2 * p + 1) if a < n]
            known[level + 1, p] = h(*pair)
        if level + 1 < height:
            order[level + 1] = sorted({*order[level + 1], *made})
    steps: dict[tuple[int, int], bytes] = {}
    for level, at, _ in nodes:
        path, a = [], at
        for lv in range(level, height):
            path.append((b"\1" if a & 1 else b"\2") + known[lv, a ^ 1] if (lv, a ^ 1) in known else NONE)
            a //= 2
        steps[level, at] = b"".join(path)
    (top,) = {at >> (height - level) for level, at, _ in nodes}
    return steps, (height, top, known[height, top])


def _round(height: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, size = int(pdf["tree"].iloc[0]), int(pdf["size"].iloc[0])
        nodes = [(int(lv), int(a), bytes(d)) for lv, a, d in zip(pdf["level"], pdf["at"], pdf["digest"], strict=True)]
        steps, (up, at, digest) = climb(nodes, size, height)
        return pd.DataFrame([(tree, size, lv, a, digest, up, at, path) for (lv, a), path in steps.items()], columns=["tree", "size", "level", "at", "digest", "up_level", "up_at", "steps"])

    return run


def finished(nodes: DataFrame, label: str) -> DataFrame:
    """tree, level, at of each node with the steps from it to its tree's root, and the root.

    nodes (tree, size, level, at, digest) cover every tree's leaves once, each place once.
    """
    nodes = durable(nodes, f"{label}-nodes")
    largest = nodes.agg(F.max("size")).first()[0] or 0
    paths = nodes.select("tree", "level", "at", F.col("level").alias("up_level"), F.col("at").alias("up_at"), F.lit(b"").alias("steps"), F.col("digest").alias("root"))
    height, top = 0, (largest - 1).bit_length() if largest else 0
    while height < top:
        height += STEP
        # nodes at or above this height, and roots, wait or are done; size <= 2 ** level says root
        low = F.expr(f"level < {height} and size > shiftleft(1L, level)")
        ancestor = F.expr(f"shiftright(at, {height} - level)")
        links = durable(nodes.filter(low).withColumn("ancestor", ancestor).groupBy("tree", "ancestor").applyInPandas(_round(height), LINK), f"{label}-{height}")
        link = links.select("tree", F.col("level").alias("up_level"), F.col("at").alias("up_at"), F.col("up_level").alias("l"), F.col("up_at").alias("a"), F.col("steps").alias("s"), F.col("digest").alias("d"))
        paths = paths.join(link, ["tree", "up_level", "up_at"], "left").select(
            "tree", "level", "at", F.coalesce("l", "up_level").alias("up_level"), F.coalesce("a", "up_at").alias("up_at"), F.concat("steps", F.coalesce("s", F.lit(b""))).alias("steps"), F.coalesce("d", "root").alias("root")
        )
        made = links.select("tree", "size", F.col("up_level").alias("level"), F.col("up_at").alias("at"), "digest").distinct()
        nodes = durable(nodes.filter(~low).unionByName(made), f"{label}-{height}-nodes")
    return paths.select("tree", "level", "at", "steps", "root")


def path_column(steps: Column) -> Column:
    """The steps as an array of (side, digest): the sibling's side, none, left or right, and its hex."""
    def step(i: Column) -> Column:
        side = F.hex(F.substring(steps, i * STEP_BYTES + 1, 1))
        return F.struct(F.when(side == "01", "left").when(side == "02", "right").otherwise("none").alias("side"), F.lower(F.hex(F.substring(steps, i * STEP_BYTES + 2, F.lit(STEP_BYTES - 1)))).alias("digest"))

    n = (F.octet_length(steps) / STEP_BYTES).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), step)).otherwise(F.expr("cast(array() as array<struct<side:string,digest:string>>)"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give, as hex: equal to the manifest's if the row is unchanged."""
    def up(node: Column, step: Column) -> Column:
        pair = F.when(step["side"] == "left", F.concat(step["digest"], node)).when(step["side"] == "right", F.concat(node, step["digest"])).otherwise(node)
        return F.sha2(pair, 256)

    return F.aggregate(path, F.lower(F.hex(leaf)), up)


def proof(path: Column) -> Column:
    """The siblings of a path, from the leaf to the root."""
    return F.transform(F.filter(path, lambda s: s["side"] != "none"), lambda s: s["digest"])


def manifest(leaves: DataFrame) -> DataFrame:
    """The rows of leaves (tree string, place long, leaf binary, and others that are carried) with
    tree_no, position in the tree, subroot, root (hex) and path."""
    carried = [c for c in leaves.columns if c not in ("tree", "leaf")]
    leaves = durable(leaves.withColumn("leaf_row", F.monotonically_increasing_id()), "merkle-leaves")
    spark = leaves.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // LEAVES_EACH))
    order = [F.col("tree").asc_nulls_first(), F.col("place").asc_nulls_first(), F.col("leaf"), F.col("leaf_row")]
    rows = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("leaf_row").rdd
    known, trees = places(rows.mapPartitionsWithIndex(edges_of).collect())
    tops = spark.createDataFrame(rows.mapPartitionsWithIndex(_tops(known)), NODE, verifySchema=False)
    below = durable(finished(tops, "merkle"), "merkle-below")
    subroots = below.groupBy("tree").agg(F.min("root").alias("digest"))
    above = finished(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("size"), F.lit(0).alias("level"), F.col("tree").alias("at"), "digest"), "merkle-roots")
    above = above.select(F.col("at").alias("tree"), F.col("steps").alias("above"), F.lower(F.hex("root")).alias("root"))
    upper = _upper(below, above)
    types = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    schema = "tree long, level int, at long, steps binary, position long, leaf binary" + "".join(f", {c} {types[c]}" for c in carried)
    found = spark.createDataFrame(rows.mapPartitionsWithIndex(_paths(known, carried)), schema, verifySchema=False)
    if upper.count() <= BROADCAST_NODES:
        upper = F.broadcast(upper)
    joined = found.join(upper, ["tree", "level", "at"])
    return joined.select(F.col("tree").alias("tree_no"), "position", "leaf", "subroot", "root", path_column(F.concat("steps", "upper")).alias("path"), *carried)


def _upper(below: DataFrame, above: DataFrame) -> DataFrame:
    """What is above each top: the steps to the root of all, its tree's root and the root of all."""
    here = below.select("tree", "level", "at", "steps", F.lower(F.hex("root")).alias("subroot"))
    return durable(here.join(above, "tree").select("tree", "level", "at", F.concat("steps", "above").alias("upper"), "subroot", "root"), "merkle-upper")


def document_leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """tree, place and leaf of each row of docs."""
    rows = pick(docs, *fields, group, order).toDF(*[f"f{i}" for i in range(len(fields))], "tree", "place")
    return rows.select(F.col("tree").cast("string").alias("tree"), "place", leaf_of(*[F.col(f"f{i}") for i in range(len(fields))]).alias("leaf"))


def merkle_report(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of docs. A row of
    every seven by the CRC of its doc_id is checked as if its n_chars had been changed."""
    rows = pick(docs, *FIELDS).toDF(*FIELDS)
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    more = (n_chars.cast("decimal(20,0)") + 1).cast("string")
    tampered = F.crc32(doc_id.cast("string")) % 7 == 0
    leaves = rows.select(
        lang.alias("tree"), doc_id.cast("long").alias("place"), leaf_of(doc_id, source, lang, n_chars, text).alias("leaf"), F.when(tampered, leaf_of(doc_id, source, lang, more, text)).alias("changed")
    )
    made = manifest(leaves).withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return made.select(
        F.col("place").alias("doc_id"), F.lower(F.hex("leaf")).alias("leaf"), "subroot", "root", F.sha2(F.array_join(proof(F.col("path")), ""), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _field(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


_LEAF = "sha256(" + " || ".join(_field(c) for c in FIELDS) + ")"
_CHANGED = "sha256(" + " || ".join(_field(c, "CAST(n_chars AS HUGEINT) + 1" if c == "n_chars" else None) for c in FIELDS) + ")"
# CRC-32 of the decimal digits, a bit at a time
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"

OP11_SQL = f"""
WITH RECURSIVE
f AS (SELECT doc_id, lang, {_LEAF} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_CHANGED} ELSE {_LEAF} END AS seen FROM documents),
g AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY lang) AS n FROM f),
t(tree, lvl, pos, h, n) AS (SELECT tree, 0, pos, leaf, n FROM g UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY tree, lvl, pos // 2),
s AS (SELECT tree, h, count(*) OVER () AS trees FROM t WHERE n = 1),
u(lvl, pos, h, n) AS (SELECT 0, tree, h, trees FROM s UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, pos // 2),
k AS (SELECT g.*, unnest(range(0, 64)) AS lvl FROM g),
p AS (SELECT k.doc_id, k.leaf, k.tree, k.pos, 0 AS part, k.lvl, t.h, (k.pos >> k.lvl) & 1 AS bit FROM k JOIN t ON t.tree = k.tree AND t.lvl = k.lvl AND t.pos = xor(k.pos >> k.lvl, 1)
      UNION ALL
      SELECT k.doc_id, k.leaf, k.tree, k.pos, 1, k.lvl, u.h, (k.tree >> k.lvl) & 1 FROM k JOIN u ON u.lvl = k.lvl AND u.pos = xor(k.tree >> k.lvl, 1)),
q AS (SELECT tree, pos, string_agg(h, '' ORDER BY part, lvl) AS proof FROM p GROUP BY tree, pos),
d AS (SELECT tree, max(lvl) AS top FROM t GROUP BY tree), e AS (SELECT max(lvl) AS top FROM u),
r(tree, pos, part, lvl, h) AS (SELECT tree, pos, 0, 0, seen FROM g UNION ALL
  SELECT r.tree, r.pos, CASE WHEN r.part = 0 AND r.lvl >= d.top THEN 1 ELSE r.part END, CASE WHEN r.part = 0 AND r.lvl >= d.top THEN 0 ELSE r.lvl + 1 END,
         CASE WHEN r.part = 0 AND r.lvl >= d.top THEN r.h WHEN p.h IS NULL THEN sha256(r.h) WHEN p.bit = 1 THEN sha256(p.h || r.h) ELSE sha256(r.h || p.h) END
  FROM r JOIN d ON d.tree = r.tree CROSS JOIN e LEFT JOIN p ON p.tree = r.tree AND p.pos = r.pos AND p.part = r.part AND p.lvl = r.lvl
  WHERE NOT (r.part = 1 AND r.lvl >= e.top))
SELECT g.doc_id, g.leaf, s.h AS subroot, w.h AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, r.h AS folded_root, r.h = w.h AS verified
FROM g JOIN s ON s.tree = g.tree JOIN (SELECT h FROM u WHERE n = 1) w ON true LEFT JOIN q ON q.tree = g.tree AND q.pos = g.pos
JOIN r ON r.tree = g.tree AND r.pos = g.pos AND r.part = 1 JOIN e ON r.lvl = e.top
"""
