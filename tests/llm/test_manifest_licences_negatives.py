"""Merkle manifest, license scans and hard negatives against plain Python and their SQL, and their
defined cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagewright.llm import licences, merkle, negatives
from pagewright.llm.oracles import ORACLES

FIELDS = "doc_id long, source string, lang string, n_chars long, text string, LANG2 string, Tree string, leaf string, place int"
LONG = "long text " * 40_000


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def plain_manifest(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified by plain recursion."""
    def leaf(r, more=0):
        parts = [r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4]]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            now = levels[-1]
            levels.append([sha("".join(now[i : i + 2])) for i in range(0, len(now), 2)])
        return levels

    def path(levels, at):
        out = []
        for now in levels[:-1]:
            out.append((at & 1, now[at ^ 1] if (at ^ 1) < len(now) else None))
            at //= 2
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(tree([leaf(r) for r in groups[g]]))
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            steps = path(trees[k], at) + path(top, k)
            node = leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf(r)
            for right, other in steps:
                node = sha(node if other is None else other + node if right else node + other)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], sha("".join(s for _, s in steps if s)), node, node == top[-1][0]))
    return out


def as_counter(df):
    return Counter(tuple(r) for r in df.collect())


def random_rows(n, langs, seed):
    r = random.Random(seed)
    rows = [(r.randrange(3 * n), r.choice(["a", None]), r.choice(langs), r.choice([None, 5, 2**63 - 1]), r.choice([None, "", "é😀", f"t{i}"]), "x", "y", "z", 1) for i in range(n)]
    return rows + [(None, None, None, None, None, None, None, None, None)] * 2 + rows[:7] + [(n + 7, "s", langs[0], 1, LONG, "x", "y", "z", 1)]


@pytest.mark.parametrize(("n", "langs"), [(3, ["en"]), (150, ["en"] * 5 + ["de", None, "ö", "", "zz"]), (61, [f"l{i}" for i in range(70)])])
def test_manifest_against_plain(spark, n, langs):
    rows = random_rows(n, langs, n)
    assert as_counter(merkle.merkle_report(spark.createDataFrame(rows, FIELDS).repartition(5))) == Counter(plain_manifest(rows))


def test_manifest_in_several_rounds_and_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STEP", 2)
    monkeypatch.setattr(merkle, "BROADCAST_NODES", 0)
    monkeypatch.setattr(merkle, "LEAVES_EACH", 9)
    rows = random_rows(200, ["en"] * 6 + ["de"], 8)
    assert as_counter(merkle.merkle_report(spark.createDataFrame(rows, FIELDS))) == Counter(plain_manifest(rows))


def test_manifest_of_a_repeated_row_and_of_nothing(spark):
    rows = [(7, "s", "en", 3, "abc", "x", "y", "z", 1)] * 333 + [(i, "s", "de", 3, "abc", "x", "y", "z", 1) for i in range(10)]
    assert as_counter(merkle.merkle_report(spark.createDataFrame(rows, FIELDS).repartition(3))) == Counter(plain_manifest(rows))
    none = merkle.merkle_report(spark.createDataFrame([], FIELDS))
    assert none.count() == 0 and none.columns[:3] == ["doc_id", "leaf", "subroot"]


def test_manifest_paths_prove_rows(spark):
    rows = random_rows(40, ["en", "de", "fr"], 2)
    docs = spark.createDataFrame(rows, FIELDS)
    made = merkle.manifest(merkle.document_leaves(docs))
    assert made.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    other = F.unhex(F.sha2(F.lit("other"), 256))
    assert made.filter(merkle.folded(other, F.col("path")) == F.col("root")).count() == 0


def test_pieces_cover_every_place():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(45)]
    for cut in (0, 1, 8, 13, 44):
        known = {}
        for begin, end in ((0, cut), (cut, 45)):
            if begin < end:
                for level, at, digest in merkle.Piece(leaves[begin:end], begin, 45).tops():
                    known[level, at] = digest
        covered = sorted(i for level, at in known for i in range(at << level, min(45, (at + 1) << level)))
        assert covered == list(range(45))
        _, (_, _, root) = merkle.climb([(*k, v) for k, v in known.items()], 45, 16)
        assert root == merkle.Piece(leaves, 0, 45).runs[-1][1][0]


# licences

LICENCE_TEXTS = [
    None, "", " \n", "MIT License", "the mit-license; MIT\tLICENSE mit license mit", "xmit license", "mit licenses", "émit license é", "GNU General Public License v3, mit license general public license",
    "SPDX-License-Identifier: MIT OR Apache-2.0 AND BSD-3-Clause", "// spdx-license-identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR MIT */ Mit License", "License-Expression:(MIT",
    "License-Expression: (MIT) AND", "License-Expression: Foo-1.0 OR MIT", "License-Expression: MIT OR Foo-1.0", "SPDX-License-Identifier: GPL-3.0+\nSPDX-License-Identifier: cc-by-nc-4.0 and isc",
    "Licensed under CC BY-NC 4.0. All rights reserved.", "a licence is mentioned", "Copyright 2024", "SPDX-License-Identifier:", "MIT WITH MIT-exception WITH MIT-exception", "SPDX-License-Identifier: MIT WITH x-exception WITH y-exception",
    "SPDX-License-Identifier: ((MIT) OR (ISC AND (Zlib)))) OR GPL-2.0", "apache license " * 30_000, "SPDX-License-Identifier: " + "MIT OR " * 2_000 + "ISC",
]


def test_licences_against_sql_and_plain(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(LICENCE_TEXTS)] + [(3, "MIT License", "x", 1), (None, "Apache License", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, TEXT2 string, n_words int").repartition(3)
    got = licences.licence_report(docs).collect()
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    want = con.sql(ORACLES["op12_license_scan"])
    assert Counter(tuple(r[c] for c in want.columns) for r in got) == Counter(want.fetchall())
    one = {r["doc_id"]: r for r in got}
    assert one[4][1:7] == (8, 3, 1, 5, "mit", "mit") and one[5]["n_base"] == 0 and one[7]["n_base"] == 0
    assert one[9]["labels"] == "apache,bsd,mit" and one[9]["score"] == 1.0 and one[9]["base_labels"] == ""
    assert one[10]["labels"] == "gpl,mit" and one[11]["labels"] == "" and one[12]["labels"] == "mit" and one[13]["labels"] == "" and one[14]["labels"] == "mit"
    assert one[0][1:] == (0, 0, None, None, "", "", 0.0, 0) and one[17]["score"] == licences.MENTION
    assert one[23]["n_base"] == 30_000 and one[23]["last_word"] == 59_998


def brute(expression):
    """permissive by recursive descent over and, or, with and parentheses."""
    tokens = licences.TOKEN.findall(expression.lower())

    def atom():
        t = tokens.pop(0)
        if t == "(":
            value = either()
            assert tokens.pop(0) == ")"
            return value
        value = licences.label_of(t) in licences.PERMISSIVE
        if tokens and tokens[0] == "with":
            del tokens[:2]
        return value

    def both():
        value = atom()
        while tokens and tokens[0] == "and":
            tokens.pop(0)
            value = atom() and value
        return value

    def either():
        value = both()
        while tokens and tokens[0] == "or":
            tokens.pop(0)
            value = both() or value
        return value

    return either()


def test_shunting_yard_against_recursive_descent():
    r = random.Random(5)

    def make(depth):
        if depth == 0 or r.random() < 0.3:
            return r.choice(["MIT", "GPL-2.0", "Apache-2.0", "MPL-2.0 WITH a-exception-1.0", "ISC"])
        inner = f"{make(depth - 1)} {r.choice(['AND', 'OR'])} {make(depth - 1)}"
        return f"({inner})" if r.random() < 0.5 else inner

    for _ in range(300):
        e = make(4)
        got = licences.parsed(e.lower())
        assert got.text == e.lower() and got.permissive == brute(e)
    assert licences.parsed("mit or gpl-2.0 and isc with z-exception").canonical == "(mit or (gpl-2.0 and (isc with z-exception)))"


def test_licences_of_nothing(spark):
    assert licences.licence_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# negatives


def plain_negatives(rows):
    live = []
    for i, (vec_id, vector, label, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not np.isfinite(np.float32(x)) for x in vector):
            continue
        v = [int(np.floor(256 * np.float64(np.float32(x)))) for x in vector]
        live.append((i, vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, v))
    out = []
    for i, a, label, v in live:
        if a is None or a % 100:
            continue
        score = [(-sum(x * y for x, y in zip(v, w, strict=False)), b is None, b or 0, b, lb) for j, b, lb, w in live if j != i]
        score.sort(key=lambda t: t[:3])
        for s, _, _, b, lb in [t for t in score if t[4] == label][:5]:
            fit = [t for t in score if t[4] != label and 80 * -s <= 100 * -t[0] <= 100 * -s][:5]
            out += [(a, b, rank, t[3], -s, -t[0]) for rank, t in enumerate(fit, 1)]
    return out


def vectors(n, dim, seed, spread=0.4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[r.integers(6)] + spread * r.normal(size=dim)
        rows.append((i * 10, [float(x) for x in np.float32(v / np.linalg.norm(v))], int(r.integers(4)), "x", 1))
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, Label2 string, row int"


@pytest.mark.parametrize("sizes", [(2048, 4096, 4), (16, 5, 1)])
def test_negatives_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "CHUNK", "PROBES"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, value)
    monkeypatch.setattr(negatives, "TILE", 3)
    rows = vectors(300, 8, 1)
    same = rows[30][1]
    rows += [(700 + i, same, 1 + i % 2, "x", 1) for i in range(60)] + rows[20:23]  # a common vector, repeated rows
    rows += [(800, None, 1, None, None), (900, [1.0, None], 1, "x", 1), (1000, [float("nan")] * 8, 1, "x", 1), (1100, [float("inf")] * 8, 1, "x", 1), (1200, same, None, "x", 1), (None, same, 2, "x", 1), (1300, [], 1, "x", 1), (1400, same[:3], 1, "x", 1)]
    got = as_counter(negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(4)))
    assert got == Counter(plain_negatives(rows)) and len(got) > 100


def test_negatives_of_nothing_and_of_loners(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(3, [1.0], 1, "x", 1)], VECTORS)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(100, [1.0], 1, "x", 1), (101, [1.0], 2, "x", 1)], VECTORS)).count() == 0


def test_bounds_hold_and_prune():
    r = np.random.default_rng(2)
    points = np.floor(256 * r.normal(size=(500, 16)))
    centroids = negatives.fit(points, 20)
    own, distance = negatives.nearest(points, centroids)
    radius = np.array([distance[own == c].max(initial=0) for c in range(len(centroids))])
    least, most = negatives.reach(points, centroids, radius[None, :])
    scores = points @ points.T
    for c in range(len(centroids)):
        assert (scores[:, own == c] <= most[:, [c]]).all() and (scores[:, own == c] >= least[:, [c]]).all()
