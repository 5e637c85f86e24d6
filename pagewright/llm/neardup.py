"""Near duplicates by MinHash and a multi-index Hamming join over b-bit signatures.

A document's set is its distinct word shingles. Documents with the same set form one class. A
class's signature is chunks of CHUNK symbols of BITS bits, each from a MinHash. Two signatures that
differ in at most 2 * chunks - 1 symbols have, by the pigeonhole principle, a chunk with at most one
differing symbol; so each chunk is entered once for each symbol that may be wrong, without it
(36 keys for 9 chunks), and every pair below the distance meets under a key. The number of chunks
follows from the similarity threshold: a pair just at it exceeds the distance with a probability of
at most MISS.

Keys held by one class go at once. Under the other keys signatures are compared; what is written is
a spanning forest of the pairs within the distance, not the pairs. Its components are clusters, and
within a cluster the links are decided on the full sets, which are made once for each class.

Groups too large for one task, keys and clusters alike, are cut into blocks. All blocks are compared
with the first one, which is sent to each of them. Members whom that has joined need no comparison
among themselves; the others, outside the largest component of their group, are compared with all.
So every link between different sets is decided, no row per pair is made, no task holds a group, and
a group of copies costs in proportion to its size.

Defined cases: A-Z is lower-cased and nothing else; words are runs without white space (space, tab,
LF, VT, FF, CR); null and blank texts have empty sets and are linked with nothing; with fewer words
than a shingle has, the whole sequence is the one shingle; a null doc_id is never a component's
smallest, and is the component's id only if all of it is null, and rows without one are told apart by
their texts; rows that repeat share a class; an
empty table gives an empty result; further columns have no influence; texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, hot_keys, numbered, one_of_each, pick, position, row_key, runs, salted_join, small_batches, texts
from .graph import components

CHUNK, BITS = 4, 16
MISS = 1e-6
#: Classes of a block of a key; classes and shingles of a block of a cluster.
KEY_BLOCK = 2048
SET_BLOCK, SHINGLE_BLOCK = 256, 400_000

# Odd multipliers.
M1, M2, M3 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def chunks_for(threshold: float) -> int:
    """The fewest chunks with which a pair of this similarity differs in 2 * chunks or more of its
    symbols with a probability of at most MISS."""
    q = 1 - threshold
    for m in range(2, 40):
        n = CHUNK * m
        if sum(math.comb(n, k) * q**k * (1 - q) ** (n - k) for k in range(2 * m, n + 1)) <= MISS:
            return m
    raise ValueError(f"similarity {threshold} is too low for this signature")


class Hashes(dict):
    """64-bit hashes of words, kept for as long as there is room."""

    room = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.room:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(M2)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(M3)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, width: int, hashes: Hashes) -> np.ndarray:
    """The distinct shingles' 64-bit hashes, sorted."""
    words = (text or b"").lower().split()  # bytes: A-Z alone become lower, and only ASCII white space splits
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(h))
    n = len(h) - width + 1
    x = np.full(n, np.uint64(width))
    for j in range(width):
        x = (x ^ h[j : j + n]) * np.uint64(M1)
        x ^= x >> np.uint64(32)
    return np.unique(_mixed(x))


class Signer:
    def __init__(self, chunks: int) -> None:
        salt = np.random.default_rng(20).integers(1, 1 << 63, size=(2, chunks * CHUNK, 1), dtype=np.uint64)
        self.multiply, self.add = salt[0] * np.uint64(2) + np.uint64(1), salt[1]
        self.chunks = chunks

    def __call__(self, shingles: np.ndarray) -> list[int]:
        """The signature: per chunk its symbols in one 64-bit number."""
        least = np.full(self.chunks * CHUNK, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(shingles), 8192):
            part = shingles[None, i : i + 8192] * self.multiply + self.add
            np.minimum(least, (part ^ (part >> np.uint64(29))).min(axis=1), out=least)
        symbols = (_mixed(least) >> np.uint64(64 - BITS)).reshape(self.chunks, CHUNK)
        packed = np.zeros(self.chunks, np.uint64)
        for j in range(CHUNK):
            packed = (packed << np.uint64(BITS)) | symbols[:, j]
        return packed.view(np.int64).tolist()


SKETCH = "doc_id long, row_key string, at long, node binary, n_shingles long, signature array<long>"


def _sketch(width: int, chunks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kinds = pa.schema([("doc_id", pa.int64()), ("row_key", pa.string()), ("at", pa.int64()), ("node", pa.binary()), ("n_shingles", pa.int64()), ("signature", pa.list_(pa.int64()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = Hashes(), Signer(chunks)
        for batch in batches:
            nodes, sizes, signatures = [], [], []
            for text in texts(batch, "text"):
                s = shingle_set(text, width, hashes)
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sizes.append(len(s))
                signatures.append(signer(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.list_(pa.int64()))], schema=kinds)

    return each


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


EDGES = "a binary, b binary"


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"])


def _near_signatures(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each key's block pair: a spanning forest of the pairs within the distance."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        told: set[tuple[bytes, bytes]] = set()
        for table in runs(batches, ["group", "i", "j"]):
            nodes = table.column("node").to_pylist()
            if len(nodes) < 2:
                continue
            flat = table.column("signature").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            symbols = flat.reshape(len(nodes), -1).view(np.uint16)
            unseen = np.arange(len(nodes))
            while len(unseen):  # search breadth first; each step compares with the unseen only
                queue, unseen = [int(unseen[0])], unseen[1:]
                while queue and len(unseen):
                    at = queue.pop()
                    near = (symbols[unseen] != symbols[at]).sum(axis=1) <= most
                    for other in unseen[near].tolist():
                        queue.append(other)
                        pair = (min(nodes[at], nodes[other]), max(nodes[at], nodes[other]))
                        if pair not in told:
                            if len(told) > 500_000:
                                told.clear()
                            told.add(pair)
                            out.append(pair)
                    unseen = unseen[~near]
            if len(out) >= 10_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return each


def linked(sets: list[np.ndarray], first: int, within: bool, threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (100 * intersection >= threshold * union). Compared are the
    sets before first with those from first on, or all with each other if within."""
    forest, found = Forest(len(sets)), []
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        n = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * n >= threshold * (len(sets[0]) + len(sets[1]) - n) else []
    tokens, code = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(tokens), np.int32)
    for i in range(len(sets) if within else first):
        start = i + 1 if within else first
        if start >= len(sets):
            break
        own = code[begin[i] : begin[i + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[code[begin[start] :]], begin[start:-1] - begin[start])
        mark[own] = 0
        for j in np.flatnonzero(100 * both >= threshold * (size[start:] + size[i] - both)).tolist():
            if forest.join(i, start + j):
                found.append((i, start + j))
    return found


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The shingles of each class, in place of the text of one of its rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, done = Hashes(), set()
        for batch in batches:
            at, sets = [], []
            for k, (node, text) in enumerate(zip(batch.column(batch.schema.get_field_index("node")).to_pylist(), texts(batch, "text"), strict=True)):
                if node in done:
                    continue  # a row that repeats
                s = shingle_set(text, width, hashes)
                if xxhash.xxh3_128_digest(s.tobytes()) == node:
                    done.add(node)
                    at.append(k)
                    sets.append(s.view(np.int64))
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array(sets, pa.list_(pa.int64()))], names=[*kept.schema.names[:-1], "shingles"])

    return each


def _confirmed(threshold: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each cluster's block pair: a spanning forest of the links on full sets."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        for table in runs(batches, ["group", "i", "j"]):
            held: dict[bytes, tuple[int, np.ndarray]] = {}
            sets = table.column("shingles").combine_chunks()
            flat, ends = sets.values.to_numpy().view(np.uint64), sets.offsets.to_numpy()
            for k, (node, block) in enumerate(zip(table.column("node").to_pylist(), table.column("block").to_pylist(), strict=True)):
                held.setdefault(node, (block, flat[ends[k] : ends[k + 1]]))
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            names = sorted(held, key=lambda n: (held[n][0] != i, n))
            if len(names) < 2:
                continue
            first = sum(held[n][0] == i for n in names)
            out += [tuple(sorted((names[x], names[y]))) for x, y in linked([held[n][1] for n in names], first, i == j, threshold)]
            if len(out) >= 10_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return each


def _blocks(members: DataFrame, loads: DataFrame) -> DataFrame:
    """members (group, node) with their group's blocks, from loads, and their own block."""
    placed = salted_join(members, loads, ["group"], F.xxhash64("node"), "inner")
    return placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def _compared(members: DataFrame, pairs: Column, compare: Callable, label: str) -> DataFrame:
    """The edges that compare finds in members, each of which takes part in pairs of blocks (i, j)."""
    names = [c for c in members.columns if c not in ("blocks", "weight")]
    dealt = members.select(*names, F.explode(pairs).alias("p")).select(*names, "p.i", "p.j")
    return durable(dealt.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j").mapInArrow(compare, EDGES), label)


def _pair(a: Column | str, b: Column | str) -> Column:
    return F.struct(F.least(a, b).alias("i"), F.greatest(a, b).alias("j"))


def joined_up(members: DataFrame, compare: Callable, most: int, label: str) -> DataFrame:
    """node, root: the components of what compare finds among the members of each group. members is
    a durable table (group, node, weight, block, blocks and what compare reads); a block of the
    second round has at most most members, or weight, on average."""
    none = F.lit(0).cast("int")
    first_block = F.transform(F.sequence(none, F.col("blocks") - 1), lambda k: _pair(none, k))
    edges = _compared(members, F.when(F.col("block") == 0, first_block).otherwise(F.array(_pair(none, F.col("block")))), compare, label)
    found = durable(components(edges, label), label)
    apart = members.filter("blocks > 1 and block > 0").select("group", "node", "weight")
    if apart.isEmpty():  # no group has a second block
        return found
    rooted = durable(apart.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), label)
    core = rooted.groupBy("group", "root").agg(F.count("*").alias("n")).groupBy("group").agg(F.max(F.struct("n", "root")).alias("m")).select("group", F.col("m.root").alias("core"))
    sided = durable(salted_join(rooted, core, ["group"], F.xxhash64("node"), "inner").select("group", "node", "weight", (F.col("root") != F.col("core")).alias("outside")), label)
    parts = [F.greatest(F.ceil(F.count_if(c) / most), F.ceil(F.sum(F.when(c, F.col("weight")).otherwise(0)) / SHINGLE_BLOCK)).cast("int").alias(n) for c, n in ((F.col("outside"), "outer"), (~F.col("outside"), "inner"))]
    loads = durable(sided.groupBy("group").agg(*parts).filter("outer > 0"), label)
    if loads.isEmpty():
        return found
    again = salted_join(sided, loads, ["group"], F.xxhash64("node"), "inner")
    hashed = F.xxhash64("node", F.lit(2))
    again = again.withColumn("block", F.when(F.col("outside"), F.pmod(hashed, F.col("outer"))).otherwise(F.col("outer") + F.pmod(hashed, F.greatest("inner", F.lit(1)))).cast("int"))
    full = members.drop("block", "blocks", "weight").join(again.select("group", "node", "block", "outside", "outer", "inner"), ["group", "node"])
    last = F.when(F.col("outside"), F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1
    more = _compared(full, F.transform(F.sequence(none, last), lambda k: _pair(F.col("block"), k)), compare, label)
    return durable(components(edges.unionByName(more), label), label)


def _keys(chunks: int) -> Column:
    keys = []
    for c in range(chunks):
        for d in range(CHUNK):
            keep = ((1 << 64) - 1) ^ (((1 << BITS) - 1) << (BITS * d))
            mask = keep - (1 << 64) if keep >> 63 else keep
            keys.append(F.xxhash64(F.lit(c * CHUNK + d), F.element_at("signature", c + 1).bitwiseAND(F.lit(mask).cast("long"))))
    return F.explode(F.array(*keys))


def placed(rows: DataFrame) -> DataFrame:
    """rows with at, a hash of their id and text by which a text is found again."""
    return rows.withColumn("at", F.xxhash64("doc_id", "text"))


def sketched(rows: DataFrame, width: int, chunks: int) -> DataFrame:
    small_batches(rows.sparkSession)
    return durable(placed(rows).select("doc_id", "row_key", "at", "text").mapInArrow(_sketch(width, chunks), SKETCH), "near-sketch")


def clusters(classes: DataFrame, chunks: int) -> DataFrame:
    """node, root: the components of the classes whose signatures are within the distance."""
    keyed = classes.select("node", _keys(chunks).alias("group"))
    shared = keyed.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    held = _blocks(durable(keyed.join(shared, "group").select("group", "node", "n"), "near-keys"), shared.select("group", F.ceil(F.col("n") / KEY_BLOCK).cast("int").alias("blocks")))
    signed = held.select("group", "node", F.lit(0).alias("weight"), "block", "blocks").join(classes.select("node", "signature"), "node")
    return joined_up(durable(signed, "near-signed"), _near_signatures(2 * chunks - 1), KEY_BLOCK, "near-clusters")


def linked_classes(rows: DataFrame, sketch: DataFrame, classes: DataFrame, found: DataFrame, width: int, threshold: int) -> DataFrame:
    """node, root: the components of the links between the classes of each cluster."""
    members = durable(found.join(classes.select("node", "at", F.col("n_shingles").alias("weight")), "node").withColumnRenamed("root", "group"), "near-members")
    loads = members.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / SET_BLOCK), F.ceil(F.sum("weight") / SHINGLE_BLOCK)).cast("int").alias("blocks"))
    named = _blocks(members, loads).select("at", "group", "node", "weight", "block", "blocks")
    texts_of = salted_join(placed(rows).select("at", "text"), named, ["at"], F.xxhash64("at", F.monotonically_increasing_id()), "inner", hot_keys(sketch, ["at"]))
    names = ["group", "node", "weight", "block", "blocks"]
    sets = texts_of.select(*names, "text").mapInArrow(_sets(width), "group binary, node binary, weight long, block int, blocks int, shingles array<long>")
    return joined_up(durable(sets, "near-sets"), _confirmed(threshold), SET_BLOCK, "near-links")


def near_components(rows: DataFrame, width: int, threshold: int) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id for each of rows (doc_id, row_key, text)."""
    chunks = chunks_for(threshold / 100)
    sketch = sketched(rows, width, chunks)
    full = sketch.filter("node is not null")
    least_row = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "at")).alias("r")
    classes = full.groupBy("node").agg(least_row, F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = durable(classes.select("node", F.col("r.doc_id").alias("rep"), F.col("r.at").alias("at"), "n_shingles", "signature"), "near-classes")
    links = linked_classes(rows, sketch, classes, clusters(classes, chunks), width, threshold)
    rooted = durable(classes.select("node", "rep").join(links, "node", "left").withColumn("root", F.coalesce("root", "node")), "near-rooted")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_node = durable(salted_join(rooted, least, ["root"], F.xxhash64("node"), "inner").select("node", "component_id"), "near-components")
    names = ["doc_id", "row_key", "n_shingles", "component_id"]
    some = salted_join(full, of_node, ["node"], F.xxhash64("at", F.monotonically_increasing_id()), "inner").select(*names, F.lit(False).alias("alone"))
    return some.unionByName(sketch.filter("node is null").withColumn("component_id", F.col("doc_id")).select(*names, F.lit(True).alias("alone")))


def near_report(docs: DataFrame, width: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row; links are similarities of threshold
    hundredths or more between sets of width-word shingles."""
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("row_key", F.lit(""))
    found = near_components(rows, width, threshold)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, with all its columns; texts without words all stay."""
    plain, names = numbered(docs)
    doc_id = F.col(f"c{position(docs, id_col)}")
    keyed = plain.withColumn("row_key", row_key(plain, names))
    rows = keyed.select(doc_id.cast("long").alias("doc_id"), F.col(f"c{position(docs, text_col)}").alias("text"), "row_key")
    found = near_components(rows, width, threshold)
    group = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))
    winners = found.filter(~F.col("alone")).groupBy("component_id").agg(F.min(group).alias("w")).select(F.col("w.row_key").alias("row_key"))
    stay = winners.unionByName(found.filter("alone").select("row_key")).distinct()
    return one_of_each(keyed.join(stay, "row_key", "left_semi"), names).toDF(*docs.columns)
