"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A piece of text starts as its bytes. The leaves of the tree are the ranks of the merges of adjacent
symbols (none: larger than all), each inner node keeps the least of its children, the left one in a
tie; so the root is the leftmost lowest-rank merge. A merge changes at most three leaves, each
updated on its path to the root, until no mergeable pair remains: n log n for a piece of n bytes.
The pieces that are new in a group of texts are merged together, the trees being rows of a matrix;
ids are kept in a bounded table, as most pieces repeat.

Vocabulary and merges are read from a public tokenizer file whose path is a parameter; the driver
reads it and sends it to the executors once, so they need not see the file.

Defined cases: null text is encoded as empty text: no ids, empty text back; a special token's string
in a text is that token; rows that repeat are encoded one by one; an empty table gives an empty
result; further columns have no influence; texts and pieces of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, small_batches, texts

# Fixed value: the public pattern that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pieces whose ids are kept by a Python worker; characters of the longest piece that is kept.
ROOM, LONGEST = 400_000, 64
#: Characters of texts whose new pieces are merged together.
GROUP = 4_000_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files of this kind: printable Latin-1
    bytes stand for themselves, the others for letters from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Vocabulary:
    """Merges and ids of a tokenizer file, in the form that encoding needs."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            found = json.load(f)
        model = found["model"]
        if model["type"] != "BPE" or found["pre_tokenizer"]["type"] != "ByteLevel" or found["pre_tokenizer"]["add_prefix_space"] or found["normalizer"]:
            raise ValueError("not a byte-level BPE file without normalisation and prefix space")
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        ids = model["vocab"]
        self.bytes_of = {i: bytes(of_letter[c] for c in t) for t, i in ids.items()}
        self.first = [ids[c] for c in letters]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges.setdefault(ids[left] << 32 | ids[right], (rank, ids[left + right]))
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one piece, by a segment tree over its adjacent pairs' ranks."""
        symbol = [self.first[b] for b in piece]
        n = len(symbol)
        if n < 2:
            return symbol
        merges, shift = self.merges.get, n.bit_length()
        none = 1 << 62
        width = 1 << (n - 2).bit_length()  # a leaf for each adjacent pair
        tree = [none] * (2 * width)
        for i in range(n - 1):
            if hit := merges(symbol[i] << 32 | symbol[i + 1]):
                tree[width + i] = hit[0] << shift | i  # rank, then place: the least is the leftmost lowest
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        mask = (1 << shift) - 1
        while tree[1] != none:
            i = tree[1] & mask
            j = after[i]
            symbol[i] = merges(symbol[i] << 32 | symbol[j])[1]
            symbol[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                hit = merges(symbol[i] << 32 | symbol[k])
                changed = [(i, hit[0] << shift | i if hit else none)]
            else:
                changed = [(i, none)]
            if j < n - 1:
                changed.append((j, none))
            h = before[i]
            if h >= 0:
                hit = merges(symbol[h] << 32 | symbol[i])
                changed.append((h, hit[0] << shift | h if hit else none))
            for leaf, value in changed:
                at = width + leaf
                if tree[at] == value:
                    continue
                tree[at] = value
                at >>= 1
                while at:
                    a, b = tree[2 * at], tree[2 * at + 1]
                    least = a if a < b else b
                    if tree[at] == least:
                        break
                    tree[at] = least
                    at >>= 1
        return [s for s in symbol if s >= 0]


class Forests:
    """The segment trees of many pieces at once: row by row what Vocabulary.merged() does for one.

    Pieces whose trees have the same number of leaves are rows of one matrix. Each step merges at
    the root of every tree that has one left and updates three leaves' paths in all of them.
    """

    WIDEST = 64  # leaves; longer pieces get a tree of their own
    NONE = 1 << 62

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pairs = np.array(sorted(vocabulary.merges), np.int64)
        hits = [vocabulary.merges[p] for p in self.pairs.tolist()]
        self.rank = np.array([h[0] for h in hits], np.int64)
        self.made = np.zeros(max(self.rank, default=0) + 1, np.int64)
        self.made[self.rank] = [h[1] for h in hits]
        self.first = np.array(vocabulary.first, np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank, then place, of the merges of these pairs; symbol -1 merges with nothing."""
        if not len(self.pairs):
            return np.full(left.shape, self.NONE)
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.rank[at] * self.WIDEST + place, self.NONE)

    def grown(self, pieces: list[bytes], width: int) -> list[bytes]:
        """The ids of pieces of at most width + 1 bytes, four bytes each."""
        rows, wide = len(pieces), width + 2  # a column more than symbols: what lies after the last
        size = np.array([len(p) for p in pieces])
        filled = np.arange(wide)[None, :] < size[:, None]
        symbol = np.full((rows, wide), -1, np.int64)
        symbol[filled] = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, wide + 1), (rows, 1))
        before = np.tile(np.arange(-1, wide - 1), (rows, 1))
        tree = np.full((rows, 2 * width), self.NONE)
        tree[:, width:] = self.leaves(symbol[:, :width], symbol[:, 1 : width + 1], np.arange(width)[None, :])
        half = width >> 1
        while half:
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
            half >>= 1
        live = np.arange(rows)
        while True:
            root = tree[live, 1]
            live, root = live[root != self.NONE], root[root != self.NONE]
            if not len(live):
                break
            i = root % self.WIDEST
            j = after[live, i]
            k = after[live, j]
            h = before[live, i]
            symbol[live, i], symbol[live, j] = self.made[root // self.WIDEST], -1
            after[live, i] = k
            before[live, k] = i
            own = self.leaves(symbol[live, i], symbol[live, k], i)
            tree[live, width + i] = own
            inner = j < width  # the last symbol begins no pair
            tree[live[inner], width + j[inner]] = self.NONE
            j = np.where(inner, j, i)
            led = h >= 0
            tree[live[led], width + h[led]] = self.leaves(symbol[live[led], h[led]], symbol[live[led], i[led]], h[led])
            h = np.where(led, h, i)
            paths = [width + i, width + j, width + h]
            for _ in range(width.bit_length() - 1):
                paths = [p >> 1 for p in paths]
                for p in paths:
                    tree[live, p] = np.minimum(tree[live, 2 * p], tree[live, 2 * p + 1])
        there = symbol >= 0
        ids = symbol[there].astype("<u4").tobytes()
        ends = (4 * np.cumsum(there.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def __call__(self, pieces: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        of_width: dict[int, list[str]] = {}
        for piece in pieces:
            n = len(piece.encode())
            width = 1 << max(n - 2, 0).bit_length()
            if width > self.WIDEST:
                found[piece] = np.array(self.vocabulary.merged(piece.encode()), "<u4").tobytes()
            else:
                of_width.setdefault(width, []).append(piece)
        for width, alike in of_width.items():
            for i in range(0, len(alike), 1 << 14):
                part = alike[i : i + (1 << 14)]
                found.update(zip(part, self.grown([p.encode() for p in part], width), strict=True))
        return found


class Codec:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.forests = Forests(vocabulary)
        self.pieces: dict = {}
        self.split = regex.compile(PATTERN).findall
        #: Special tokens are pieces in a tuple, so that no plain piece is taken for one.
        self.special = {(s,): np.array([i], "<u4").tobytes() for s, i in vocabulary.special.items()}
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True))) if self.special else None
        top = max(vocabulary.bytes_of) + 1
        self.out = [vocabulary.bytes_of.get(i, b"") for i in range(top)]

    def parts(self, text: str) -> list:
        """The pieces and special tokens of a text."""
        if self.cut is None or not self.cut.search(text):
            return self.split(text)
        found, at = [], 0
        for m in self.cut.finditer(text):
            found += self.split(text[at : m.start()])
            found.append((m[0],))
            at = m.end()
        return found + self.split(text[at:])

    def _coded(self, split: list[list]) -> list[bytes]:
        wanted = set().union(*split)
        fresh = wanted.difference(self.pieces, self.special)
        if len(self.pieces) + len(fresh) > ROOM:
            self.pieces.clear()
            fresh = wanted.difference(self.special)
        self.pieces |= self.special | self.forests(list(fresh))
        piece = self.pieces.__getitem__
        coded = [b"".join(map(piece, s)) for s in split]
        for p in fresh:
            if len(p) > LONGEST:
                del self.pieces[p]
        return coded

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each; new pieces of a group of texts are merged together."""
        out: list[bytes] = []
        group, chars = [], 0
        for text in texts:
            group.append(self.parts(text))
            chars += len(text)
            if chars >= GROUP:
                out += self._coded(group)
                group, chars = [], 0
        return out + (self._coded(group) if group else [])

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.out.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


ENCODED = "doc_id long, ids binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _each(vocabulary, digests: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value)
        for batch in batches:
            coded = codec.encode_all([(t or b"").decode() for t in texts(batch, "text")])
            if not digests:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded, pa.binary())], names=["doc_id", "ids"])
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(c) // 4 for c in coded], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(c).encode()).hexdigest() for c in coded], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return each


def _run(docs: DataFrame, file: str, digests: bool, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(file))  # one tokenizer file: a few MB
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_each(vocabulary, digests), DIGESTS if digests else ENCODED)


def encoded(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (unsigned 32-bit little-endian integers) for each row of docs."""
    return _run(docs, file, False, id_col, text_col)


def coding_report(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them, for each row."""
    return _run(docs, file, True, id_col, text_col)


def decoded(coded: DataFrame, file: str) -> DataFrame:
    """doc_id and text for each row of coded (doc_id, ids)."""
    spark = coded.sparkSession
    vocabulary = spark.sparkContext.broadcast(Vocabulary(file))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary.value)
        for batch in batches:
            back = [codec.decode(b or b"") for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(each, "doc_id long, text string")
