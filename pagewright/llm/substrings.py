"""Substring dedup by a compacted de Bruijn graph of token k-mers.

The edges of the graph are k-mers of WINDOW words, from the node of their first WINDOW - 1 words to
that of their last; nodes are named by 64-bit hashes, so an edge has 128 bits. An edge can only
repeat if its minimizer does (the least hash of its ANCHOR-word parts, the same wherever the edge
stands), so a first pass names only minimizers, about one word in sixteen, and a second one only the
edges whose minimizer occurs in two documents.

Each edge that two documents have gets its source: the least document and place where it starts,
which also identify it from then on. Counts of the edges into and out of a node give its degrees.
Where a node has one edge in and one out, and the two follow each other in their source, a join on
the node compacts them into one path; paths are cut every PATH places of the source, so that no task
holds a long document. A path only names what a task gathers: spans would be the same with any cut
of the source. A join of all places on their edge threads documents through the paths, and
gives spans with source coordinates. Those are then verified: the words of the source's text at
its coordinates must be those of the span, by a digest of both. The verified spans' words go.

Texts whose whole word sequence is that of a smaller document are settled by a digest beforehand.
A task that holds an edge several times sends its first occurrence on alone: later documents there
become spans at once, and an edge that a document repeats refers back to its place before. So
copies, passages that very many documents share, and loops do not gather under one key: an edge has
at most one row for each CHUNK_EDGES edges.

Defined cases: null and blank texts have no words; rows with a null doc_id are no source and keep
all words; rows that repeat a doc_id, whatever their texts, do not remove words from each other;
an empty table gives an empty result; further columns have no influence; texts are read whole. If
two different edges had one hash, their spans fail the verification and their words stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import HOT_ROWS, HOT_SHARE, discard, durable, hot_keys, pick, salted_join, small_batches, texts
from .neardup import Hashes, _mixed

WINDOW, ANCHOR = 50, 20
#: Edges that a task holds at once to find those that it has several times.
CHUNK_EDGES = 1_500_000
#: Places of a path in its source, at most.
PATH = 4096
#: Words that are hashed at once; with the place of a minimizer in 24 bits.
STRETCH = 1 << 22
#: Several texts under one doc_id are told apart by the high bits of places.
PART = 1 << 40

# Fixed value: an odd multiplier of the rolling hash, and its inverse.
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Rolling:
    """Hashes of all windows of a sequence, from prefix sums modulo 2^64."""

    def __init__(self) -> None:
        self.base, self.inverse = np.uint64(BASE), np.uint64(INVERSE)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(4096, 2 * n)
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.base)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.inverse)]), dtype=np.uint64)

    def sums(self, h: np.ndarray) -> np.ndarray:
        self._powers(len(h) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.up[: len(h)], dtype=np.uint64)])

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return _mixed((sums[size:] - sums[:n]) * self.down[:n])


class Sketcher:
    def __init__(self) -> None:
        self.hashes, self.rolling = Hashes(), Rolling()

    def words(self, text: bytes | None) -> tuple[list[bytes], np.ndarray]:
        words = (text or b"").split()
        return words, np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))

    def minimizers(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the windows of h (at most STRETCH words): the place of each one's minimizer, and the
        hashes of the anchors at all places."""
        anchor = self.rolling.windows(self.rolling.sums(h), ANCHOR)
        packed = (anchor & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(anchor), dtype=np.uint64)
        span, width = WINDOW - ANCHOR + 1, 1
        while 2 * width <= span:
            packed = np.minimum(packed[:-width], packed[width:])
            width *= 2
        rest = span - width
        least = np.minimum(packed[: len(packed) - rest], packed[rest:]) if rest else packed
        return (least & np.uint64(0xFFFFFF)).astype(np.int64), anchor

    def stretches(self, h: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Parts of h that together hold every window once."""
        for begin in range(0, max(0, len(h) - WINDOW + 1), STRETCH):
            yield begin, h[begin : begin + STRETCH + WINDOW - 1]

    def anchors(self, h: np.ndarray) -> np.ndarray:
        found = [a[np.unique(m)] for _, part in self.stretches(h) for m, a in [self.minimizers(part)]]
        return np.unique(np.concatenate(found)).view(np.int64) if found else np.empty(0, np.int64)

    def edges(self, h: np.ndarray, repeated: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The two nodes and the place of each edge whose minimizer is among repeated (sorted)."""
        for begin, part in self.stretches(h):
            least, anchor = self.minimizers(part)
            mine = anchor[least].view(np.int64)
            at = np.searchsorted(repeated, mine)
            hit = np.flatnonzero(repeated[np.minimum(at, len(repeated) - 1)] == mine)
            if len(hit):
                nodes = self.rolling.windows(self.rolling.sums(part), WINDOW - 1)
                yield nodes[hit], nodes[hit + 1], hit + begin


def _digest(words: list[bytes]) -> tuple[bytes, str]:
    joined = b" ".join(words)
    return xxhash.xxh3_128_digest(joined), hashlib.sha256(joined).hexdigest()


META = "doc_id long, text_key long, n_words long, digest binary, sha string, anchors array<long>, n_anchors int"


def _meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketcher = Sketcher()
    for batch in batches:
        rows: list[tuple] = []
        for text in texts(batch, "text"):
            words, h = sketcher.words(text)
            found = sketcher.anchors(h)
            rows.append((len(words), *_digest(words), found, len(found)))
        n, digest, sha, anchors, counts = zip(*rows, strict=True) if rows else ((), (), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(batch.schema.get_field_index("text_key")), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sha, pa.string()), pa.array(anchors, pa.list_(pa.int64())), pa.array(counts, pa.int32())],
            names=["doc_id", "text_key", "n_words", "digest", "sha", "anchors", "n_anchors"],
        )


#: A span of length places of doc_id from at on, whose words also start at source_at in source, or,
#: where source is doc_id, whose edges were there before; or, with tail and head, an edge whose source
#: is to be found.
SPANS = "tail long, head long, doc_id long, at long, length long, source long, source_at long"


def compacted(doc: np.ndarray, at: np.ndarray, source: np.ndarray, source_at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edges that follow each other in document and source, as spans."""
    order = np.lexsort((at, doc))
    doc, at, source, source_at = doc[order], at[order], source[order], source_at[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (source[1:] != source[:-1]) | (at[1:] != at[:-1] + 1) | (source_at[1:] != source_at[:-1] + 1)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(doc)))
    return doc[begin], at[begin], length, source[begin], source_at[begin]


def _resolve(tail: np.ndarray, head: np.ndarray, doc: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Settles edges that were here before; the first ones stay open."""
    order = np.lexsort((at, doc, head, tail))
    tail, head, doc, at = tail[order], head[order], doc[order], at[order]
    first = np.ones(len(tail), bool)
    first[1:] = (tail[1:] != tail[:-1]) | (head[1:] != head[:-1])
    source = np.flatnonzero(first)[np.cumsum(first) - 1]
    same = ~first  # the text of the row before, and where at is too, a row that repeats
    same[1:] &= (doc[1:] == doc[:-1]) & (at[1:] // PART == at[:-1] // PART)
    again = same.copy()
    again[1:] &= at[1:] != at[:-1]
    later = ~same & (doc > doc[source])
    still = ~same & ~later
    before = np.flatnonzero(again) - 1
    shared = compacted(doc[later], at[later], doc[source][later], at[source][later])
    back = compacted(doc[again], at[again], doc[again], at[before])
    d, a, n, s, sa = (np.concatenate(x) for x in zip(shared, back, strict=True))
    k, m = int(still.sum()), len(d)

    def column(open_part: np.ndarray | None, span_part: np.ndarray | None) -> pa.Array:
        left = pa.array(open_part, pa.int64()) if open_part is not None else pa.nulls(k, pa.int64())
        right = pa.array(span_part, pa.int64()) if span_part is not None else pa.nulls(m, pa.int64())
        return pa.concat_arrays([left, right])

    return pa.RecordBatch.from_arrays(
        [
            column(tail[still].view(np.int64), None),
            column(head[still].view(np.int64), None),
            column(doc[still], d),
            column(at[still], a),
            column(np.ones(k, np.int64), n.astype(np.int64)),
            column(None, s),
            column(None, sa),
        ],
        names=["tail", "head", "doc_id", "at", "length", "source", "source_at"],
    )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketcher, held, count = Sketcher(), [], 0
    for batch in batches:
        ids, digests, parts = (batch.column(i).to_pylist() for i in (0, 2, 3))
        repeated = batch.column(4)
        for k, text in enumerate(texts(batch, "text")):
            words, h = sketcher.words(text)
            if xxhash.xxh3_128_digest(b" ".join(words)) != digests[k]:
                continue  # another text under the same doc_id
            for tail, head, at in sketcher.edges(h, np.sort(repeated[k].values.to_numpy())):
                held.append((tail, head, np.full(len(at), ids[k], np.int64), at + parts[k] * PART))
                count += len(at)
                if count >= CHUNK_EDGES:
                    yield _resolve(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, count = [], 0
    if held:
        yield _resolve(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _passage(words: list[bytes], at: int, length: int) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words[at : at + length + WINDOW - 1]))


PASSAGES = "source long, source_digest binary, source_at long, length long, passage binary"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the words at the places of sources that spans tell of."""
    for batch in batches:
        ids, digests, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
        for k, text in enumerate(texts(batch, "text")):
            words = (text or b"").split()
            if xxhash.xxh3_128_digest(b" ".join(words)) == digests[k]:  # else another text under the same doc_id
                wanted = batch.column(3)[k].values
                for at, length in zip(wanted.field(0).to_pylist(), wanted.field(1).to_pylist(), strict=True):
                    out.append((ids[k], digests[k], at, length, _passage(words, at, length)))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["source", "source_digest", "source_at", "length", "passage"])


KEPT = "doc_id long, digest binary, n_removed long, kept string"


def covered(words: list[bytes], spans: list[tuple[int, int, int | None, bytes | None]]) -> np.ndarray:
    """Which words go. A span (at, length, back, passage) has the words of a smaller document if they
    are those of the passage; with back, its edges go if those from back on do."""
    edges = np.zeros(len(words), bool)
    for at, length, back, passage in spans:
        if back is None and _passage(words, at, length) == passage:
            edges[at : at + length] = True
    for at, length, back, _ in sorted((s for s in spans if s[2] is not None), key=lambda s: s[0]):
        for i in range(0, length, at - back):
            n = min(at - back, length - i)
            edges[at + i : at + i + n] |= edges[back + i : back + i + n]
    step = np.zeros(len(words) + WINDOW, np.int64)
    starts = np.flatnonzero(edges)
    step[starts] += 1
    step[starts + WINDOW] -= 1
    return np.cumsum(step)[: len(words)] > 0


def _kept(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
            for k, text in enumerate(texts(batch, "text")):
                words = (text or b"").split()
                if xxhash.xxh3_128_digest(b" ".join(words)) != digests[k]:
                    continue
                spans = batch.column(3)[k].values
                gone = covered(words, list(zip(*[spans.field(i).to_pylist() for i in range(4)], strict=True)))
                left = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])
                out.append((ids[k], digests[k], int(gone.sum()), left.decode() if whole else hashlib.sha256(left).hexdigest()))
            doc, digest, n, kept = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "digest", "n_removed", "kept"])

    return each


def paths_of(known: DataFrame) -> DataFrame:
    """The distinct edges of known by their source coordinates, each with path_at, the place in the
    source where its path begins."""
    edges = known.filter("doc_id = source and at = source_at").select("tail", "head", "source", "source_at").distinct()
    into = edges.groupBy(F.col("head").alias("node")).agg(F.count("*").alias("ways_in"), F.min(F.struct("source", "source_at")).alias("edge_in"))
    out = edges.groupBy(F.col("tail").alias("node")).agg(F.count("*").alias("ways_out"))
    nodes = into.join(out, "node")
    linked = salted_join(edges.withColumnRenamed("tail", "node"), nodes, ["node"], F.xxhash64("head"))
    follows = (F.col("ways_in") == 1) & (F.col("ways_out") == 1) & (F.col("edge_in.source") == F.col("source")) & (F.col("edge_in.source_at") + 1 == F.col("source_at"))
    along = Window.partitionBy("source", F.floor(F.col("source_at") / PATH)).orderBy("source_at")
    begin = F.when(~F.coalesce(follows, F.lit(False)), F.col("source_at"))
    return linked.select("source", "source_at", F.coalesce(F.max(begin).over(along), F.min("source_at").over(along)).alias("path_at"))


def _runs(places: Column) -> Column:
    """Sorted places as an array of runs of consecutive ones (at, length)."""
    start = F.struct(F.expr("cast(array() as array<struct<at:bigint,length:bigint>>)").alias("done"), F.lit(None).cast("long").alias("at"), F.lit(0).cast("long").alias("length"))

    def add(acc: Column, place: Column) -> Column:
        goes_on = acc["at"] + acc["length"] == place
        closed = F.when(acc["at"].isNull() | goes_on, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["at"].alias("at"), acc["length"].alias("length")))))
        return F.struct(closed.alias("done"), F.when(goes_on, acc["at"]).otherwise(place).alias("at"), F.when(goes_on, acc["length"] + 1).otherwise(F.lit(1).cast("long")).alias("length"))

    return F.aggregate(places, start, add, lambda acc: F.concat(acc["done"], F.array(F.struct(acc["at"].alias("at"), acc["length"].alias("length")))))


def threaded(known: DataFrame) -> DataFrame:
    """Spans (doc_id, at, length, source, source_at) of the documents along the paths."""
    places = known.filter("doc_id > source").select("doc_id", "at", "source", "source_at")
    on_path = salted_join(places, paths_of(known), ["source", "source_at"], F.xxhash64("doc_id", "at"), "inner").withColumn("shift", F.col("at") - F.col("source_at"))
    # a path's places in a document, of which PATH bounds the number; rows that repeat count once
    of_path = on_path.groupBy("doc_id", "source", "path_at", "shift").agg(F.array_sort(F.collect_set("at")).alias("places"))
    runs = of_path.select("doc_id", "source", "shift", F.explode(_runs(F.col("places"))).alias("run"))
    return runs.select("doc_id", "run.at", "run.length", "source", (F.col("run.at") - F.col("shift")).alias("source_at"))


def _of_texts(rows: DataFrame, facts: DataFrame, hot: DataFrame, names: list[str]) -> DataFrame:
    """facts (doc_id, text_key, names) with the texts they are about. An id with many texts sends each
    text to its own facts alone; a row that repeats often, told by hot, is dealt to many tasks."""
    return salted_join(rows, facts, ["doc_id", "text_key"], F.monotonically_increasing_id(), "inner", hot).select("doc_id", "text", *names)


def repeated_spans(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The meta table of rows (doc_id, text, text_key), with first (the least doc_id of the same words);
    and spans: doc_id, digest, text_key, at, length, and either source, source_digest, source_key and
    source_at, or back; and the hot (doc_id, text_key)."""
    small_batches(rows.sparkSession)
    meta = durable(rows.mapInArrow(_meta, META), "substring-meta")
    hot_texts = durable(hot_keys(meta, ["doc_id", "text_key"]), "substring-hot")
    same = durable(meta.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first")), "substring-firsts")
    slim = salted_join(meta.drop("anchors"), same, ["digest"], F.xxhash64("doc_id"))
    part = F.row_number().over(Window.partitionBy("doc_id").orderBy("digest")) - 1
    leaders = salted_join(meta.filter(f"n_words >= {WINDOW}"), same, ["digest"], F.xxhash64("doc_id"), "inner").filter("doc_id = first")
    one = F.min_by(F.struct("text_key", "anchors"), "text_key").alias("one")  # of texts that differ in white space
    leaders = leaders.groupBy("doc_id", "digest").agg(one).select("doc_id", "digest", "one.text_key", "one.anchors")
    leaders = durable(leaders.withColumn("part", part), "substring-leaders")
    text = ["doc_id", "text_key", "digest", "part"]
    anchored = leaders.select(*text, F.explode("anchors").alias("anchor"))
    shared = anchored.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).filter("low < high")
    least = max((meta.agg(F.sum("n_anchors")).first()[0] or 0) * HOT_SHARE, HOT_ROWS)
    work = salted_join(anchored, shared.select("anchor"), ["anchor"], F.xxhash64("doc_id"), "inner", shared.filter(F.col("n") >= least).select("anchor"))
    work = work.groupBy(*text).agg(F.collect_list("anchor").alias("repeated"))
    found = durable(_of_texts(rows, work, hot_texts, ["digest", "part", "repeated"]).mapInArrow(_edges, SPANS), "substring-edges")
    edges = found.filter("tail is not null").select("tail", "head", "doc_id", "at")
    sources = edges.groupBy("tail", "head").agg(F.min(F.struct("doc_id", "at")).alias("s"), F.max("doc_id").alias("last"), F.count("*").alias("n")).filter("last > s.doc_id")
    sources = durable(sources.select("tail", "head", "n", F.col("s.doc_id").alias("source"), F.col("s.at").alias("source_at")), "substring-sources")
    hot = sources.filter(F.col("n") >= max(edges.count() * HOT_SHARE, HOT_ROWS)).select("tail", "head")
    known = durable(salted_join(edges, sources.drop("n"), ["tail", "head"], F.xxhash64("doc_id", "at"), "inner", hot), "substring-known")
    spans = found.filter("tail is null").select("doc_id", "at", "length", "source", "source_at").unionByName(threaded(known))
    within = [F.floor(F.col(c) / PART).cast("int").alias(p) for c, p in (("at", "part"), ("source_at", "source_part"))]
    spans = spans.select("doc_id", (F.col("at") % PART).alias("at"), "length", "source", (F.col("source_at") % PART).alias("source_at"), *within)
    named = leaders.select(*text)
    spans = durable(spans.join(named, ["doc_id", "part"]).drop("part"), "substring-spans")
    discard(found)
    discard(known)
    origin = named.select(F.col("doc_id").alias("source"), F.col("digest").alias("source_digest"), F.col("text_key").alias("source_key"), F.col("part").alias("source_part"))
    of_source = spans.filter("source < doc_id")
    told = salted_join(of_source, origin, ["source", "source_part"], F.xxhash64("doc_id", "at"), "inner").drop("source_part")
    back = spans.filter("source = doc_id").select("doc_id", "digest", "text_key", "at", "length", F.col("source_at").alias("back"))
    return slim, told.unionByName(back, allowMissingColumns=True), hot_texts


def verified(rows: DataFrame, spans: DataFrame, hot: DataFrame) -> DataFrame:
    """spans with passage, the digest of the source's words at the span's source coordinates."""
    passage, text = ["source", "source_digest", "source_at", "length"], ["doc_id", "digest", "text_key", "at", "length"]
    told = durable(spans.filter("back is null").drop("back"), "substring-told")
    places = told.select(*passage, "source_key").distinct().groupBy(F.col("source").alias("doc_id"), F.col("source_key").alias("text_key"), F.col("source_digest").alias("digest"))
    wanted = places.agg(F.collect_list(F.struct("source_at", "length")).alias("wanted"))
    read = _of_texts(rows, wanted, hot, ["digest", "wanted"]).mapInArrow(_passages, PASSAGES).dropDuplicates(passage)
    checked = salted_join(told, read, passage, F.xxhash64("doc_id", "at"), "inner").select(*text, "passage")
    return checked.unionByName(spans.filter("back is not null").select(*text, "back"), allowMissingColumns=True)


def _cleaned(rows: DataFrame, whole: bool) -> DataFrame:
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    meta, spans, hot = repeated_spans(rows)
    lists = verified(rows, spans, hot).groupBy("doc_id", "text_key", "digest").agg(F.collect_list(F.struct("at", "length", "back", "passage")).alias("spans"))
    cut = _of_texts(rows, lists, hot, ["digest", "spans"]).mapInArrow(_kept(whole), KEPT)
    cut = cut.dropDuplicates(["doc_id", "digest"])
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= WINDOW)
    joined = meta.join(cut, ["doc_id", "digest"], "left")
    return joined.select(
        "doc_id",
        "digest",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit("" if whole else EMPTY_SHA)).otherwise(F.col("kept") if whole else F.coalesce("kept", "sha")).alias("kept"),
    )


def substring_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of docs."""
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text")
    return _cleaned(rows, False).select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_removed and kept_text (null: nothing was removed, the text stays as it is)."""
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text")
    return _cleaned(rows, True).select("doc_id", "n_removed", F.col("kept").alias("kept_text"))
