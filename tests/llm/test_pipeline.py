"""The pipeline's stages against plain Python, each on its own input."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from pagewright.llm.common import durable
from tests.llm.test_operators import LONG, ODD, SCHEMA, SF, library, measures, near_plain, plain  # noqa: F401

WORDY = " ".join(f"the word{i} of" for i in range(60))
CASES = [
    *ODD,
    (20, WORDY, "a", "x", 1, 1), (20, WORDY, "a", "x", 1, 1), (21, WORDY, "a", "y", 1, 1), (22, WORDY + " ", None, "x", 1, 1), (23, WORDY.replace("word7 ", "other "), "b", None, None, None),
    (None, WORDY + " and more of the same", "b", "x", 1, 1), (None, LONG, None, None, None, 2), (24, WORDY[::-1], "c", "x", 1, 1),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, SCHEMA).repartition(3)


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_quality_stage_in_defined_cases(spark, cases):
    kept = corpus_pipeline.keep_quality(spark, cases, SF)
    assert kept.columns == cases.columns
    left = as_rows(kept)
    assert not left - Counter(CASES)
    assert not any(measures(r[1])[-1] for r in left) and left[CASES[13]] == 2  # rows that repeat are judged alike
    assert {r[0] for r in left} >= {20, 21, 22, 23} and not {1, 2, 3, 8} & {r[0] for r in left}


def test_exact_stage_in_defined_cases(spark, cases):
    once = corpus_pipeline.drop_copies(spark, cases, SF)
    assert once.columns == cases.columns
    groups = {}
    for r in CASES:
        groups.setdefault("".join(plain(r[1])), []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, r))
    left = as_rows(once)
    assert set(left.values()) == {1} and len(left) == len(groups)
    assert all(any(x[3] in left and x[:3] == min(g, key=lambda y: y[:3])[:3] for x in g) for g in groups.values())


def test_near_stage_in_defined_cases(spark, cases):
    far = corpus_pipeline.drop_near_copies(spark, cases, SF)
    assert far.columns == cases.columns
    left = as_rows(far)
    assert set(left.values()) == {1} and not left - Counter(CASES)
    components = near_plain([r[:2] for r in CASES], 5, 80)
    with_words = {c for (_, n, c) in components if n}
    assert {r[0] for r in left if plain(r[1])} == with_words
    assert sum(1 for r in left if not plain(r[1])) == 3  # texts without words all stay


def test_mixing_stage_in_defined_cases(spark, cases):
    mix = corpus_pipeline.mix_sources(spark, cases, SF)
    assert mix.columns == cases.columns
    took, had = as_rows(mix), Counter(CASES)
    assert not set(took) - set(had) and all(n <= 2 * had[r] for r, n in took.items())
    assert not any(not plain(r[1]) for r in took)
    assert took == as_rows(corpus_pipeline.mix_sources(spark, cases.repartition(5), SF))


def test_bpe_stage_in_defined_cases(spark, cases, library):  # noqa: F811
    got = Counter((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.encode(spark, cases, SF).collect())
    assert got == Counter((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in CASES)


def test_stages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0 and (name == "bpe" or out.columns == empty.columns)


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "exact_dedup", "minhash_near_dedup", "mixing", "bpe"]
    good = durable(steps["quality_rules"](spark, docs, SF), "t")
    assert good.columns == docs.columns and not any(measures(r["text"])[-1] for r in good.collect())
    once = durable(steps["exact_dedup"](spark, good, SF), "t")
    texts = Counter("".join(plain(r["text"])) for r in once.collect())
    assert max(texts.values()) == 1 and set(texts) == {"".join(plain(r["text"])) for r in good.collect()}
    far = durable(steps["minhash_near_dedup"](spark, once, SF), "t")
    expected = {c for _, _, c in near_plain([(r["doc_id"], r["text"]) for r in once.collect()], 5, 80)}
    assert {r["doc_id"] for r in far.collect()} == expected
    mix = durable(steps["mixing"](spark, far, SF), "t")
    words = sum(len(plain(r["text"])) for r in far.collect())
    assert abs(sum(len(plain(r["text"])) for r in mix.collect()) - 1.5 * words) < 0.05 * words
    assert max(Counter(r["doc_id"] for r in mix.collect()).values()) <= 2
    assert steps["bpe"](spark, mix, SF).count() == mix.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
