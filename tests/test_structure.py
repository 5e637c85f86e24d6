"""Structural joins against plain walks over pairs, whole texts, and what stays linear."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from pagewright.operators import findings as fs
from pagewright.operators import optional_rules, rules
from pagewright.operators.structure import first_inside, innermost, nearest, sums_inside, with_text
from pagewright.plans import catalog
from pagewright.sources.html_tree import COLUMNS, element_rows, elements

PAGE = "<div><p>one<b>two</b> three<script>var x</script></p><template><p>in <i>template</i></p></template></div><p>four<style>s</style>"


def tree(seed, n):
    """Random nested intervals (ord, end_ord, tag)."""
    r = random.Random(seed)
    rows, open_ = [], []
    for i in range(n):
        while open_ and r.random() < 0.4:
            open_.pop()
        for k in open_:
            rows[k][1] = i
        rows.append([i, i, r.choice("abc")])
        open_.append(i)
    return rows


@pytest.fixture(scope="module")
def forest(spark):
    rows = [(d, *x) for d in range(4) for x in tree(d, 60)]
    return rows, spark.createDataFrame(rows, "doc_id long, ord int, end_ord int, tag string").repartition(3)


def test_nearest_and_first_inside(forest):
    rows, df = forest
    a, b = df.filter("tag = 'a'"), df.filter("tag = 'b'")
    for after in (False, True):
        got = {(r["doc_id"], r["ord"]): r["m"] and r["m"]["ord"] for r in nearest(a, b, ["ord"], "m", after).collect()}
        for d, o, _, t in rows:
            if t == "a":
                there = [x[1] for x in rows if x[0] == d and x[3] == "b" and (x[1] > o if after else x[1] < o)]
                assert got[d, o] == (min(there) if after else max(there)) if there else got[d, o] is None
    got = {(r["doc_id"], r["ord"]): r["m"] and r["m"]["ord"] for r in first_inside(a, b, ["ord"], "m").collect()}
    assert got == {(d, o): min((x[1] for x in rows if x[0] == d and x[3] == "b" and o < x[1] <= e), default=None) for d, o, e, t in rows if t == "a"}


def test_sums_inside_and_innermost(forest):
    rows, df = forest
    a, b = df.filter("tag = 'a'"), df.filter("tag <> 'a'")
    got = {(r["doc_id"], r["ord"]): (r["n"], r["s"]) for r in sums_inside(a, b, n=F.lit(1), s=F.col("ord")).collect()}
    for d, o, e, t in rows:
        if t == "a":
            inside = [x[1] for x in rows if x[0] == d and x[3] != "a" and o < x[1] <= e]
            assert got[d, o] == (len(inside), sum(inside))
    got = {(r["doc_id"], r["ord"]): r["m"] and r["m"]["ord"] for r in innermost(df, a, ["ord"], "m").collect()}
    assert got == {(d, o): max((x[1] for x in rows if x[0] == d and x[3] == "a" and x[1] < o <= x[2]), default=None) for d, o, _, _ in rows}


def test_texts_by_place(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<script>only</script><p>x</p>"), (3, ""), (4, None)], "page_id long, html string")
    e = elements(pages).persist()
    got = {(r["doc_id"], r["ord"]): (r["tag"], r["text"]) for r in with_text(e.select("doc_id", "ord", "tag", "text_in", "text_at", "text_length"), e).collect()}
    assert got[1, 0] == ("div", "onetwothree") and got[1, 1] == ("p", "onetwothree") and got[1, 2] == ("b", "two") and got[1, 3] == ("script", "var x")
    assert got[1, 4] == ("template", "intemplate") and got[1, 6] == ("i", "template") and got[1, 7] == ("p", "four") and got[1, 8] == ("style", "s")
    assert got[2, 0] == ("script", "only") and got[2, 1] == ("p", "x") and len(got) == 11


def test_titles_decode_ended_references_alone(spark, tmp_path):
    titles = ["a &amp;&lt;b&gt; &amp;lt;", "cut &amp;&amp", "cut &am", "&quot;q&quot; &#39;n &lt"]
    spark.createDataFrame([(k, f"<html><head><title>{t}</title></head><body>&copy;</body></html>") for k, t in enumerate(titles)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    rows = catalog.queries()["title_texts_by_place"](spark, str(tmp_path)).collect()
    texts = ["a &<b> &lt;", "cut &&amp", "cut &am", "&quot;q&quot; &#39;n &lt"]
    assert sorted(map(tuple, rows)) == [(k, t, len(t)) for k, t in enumerate(texts)]


def test_duplicate_blocks_read_whole_texts(spark):
    long = "word " * 900
    source = f"<p>{long}one</p><p>{long}two</p><p>{long}<b>one</b></p><p>{long[:-5]}w<i>ord one</i></p><div>{long}one</div><p></p>"
    e = elements(spark.createDataFrame([(1, source)], "page_id long, html string"), columns=["doc_id", "ord", "tag", "text_length", "text_digest"])
    got = {r["ord"]: r["is_duplicate"] for r in fs.duplicate_blocks(e.filter("tag in ('p', 'div')")).collect()}
    # pieces are stripped before they are joined, so the third is another text, and the fourth the first one's
    assert got == {0: False, 1: False, 2: False, 4: True, 6: False}
    same = f"<p>{long}<b>one</b></p><p>{long.strip()}one</p><p>x</p><p>{long}<i>one</i></p>"
    e = elements(spark.createDataFrame([(1, same)], "page_id long, html string"), columns=["doc_id", "ord", "tag", "text_length", "text_digest"])
    assert {r["ord"]: r["is_duplicate"] for r in fs.duplicate_blocks(e.filter("tag = 'p'")).collect()} == {0: False, 2: True, 3: False, 4: True}


def test_texts_with_digests_stay_linear():
    names = ("doc_id", "ord", "tag", "text_at", "text_length", "text_digest")

    def seconds(n):
        source = "".join(f"<p>text {i}" for i in range(n))
        begin = time.perf_counter()
        assert sum(1 for _ in element_rows(1, source, names)) == n
        return time.perf_counter() - begin

    seconds(500)
    assert seconds(20_000) < 12 * max(seconds(4_000), 0.02)


def test_a_large_table_stays_linear(spark):
    rows = "".join("<tr>" + f"<td>{i}</td>" * 5 + "</tr>" for i in range(20_000))
    source = f"<table><tr>{'<th>h</th>' * 5}</tr>{rows}</table>"
    e = elements(spark.createDataFrame([(1, source)], "page_id long, html string"), columns=rules.columns_of(["table_headers", "table_structure"])).persist()
    facts = rules.table_facts(e).collect()
    assert len(facts) == 1 and facts[0]["rows"] == 20_001 and facts[0]["first_cells"] == 5 and facts[0]["header_rows"] == 1 and facts[0]["complex"] and not facts[0]["layout"]


def test_nested_tables_count_for_both(spark):
    source = "<table><tr><th>a</th><td><table><caption>c</caption><tr><td colspan='2'>x</td></tr></table></td></tr><tr><td>b</td></tr></table>"
    e = elements(spark.createDataFrame([(1, source)], "page_id long, html string")).persist()
    outer, inner = rules.table_facts(e).orderBy("ord").collect()
    assert (outer["rows"], outer["ths"], outer["captions"], outer["first_cells"], outer["merged"], outer["column_ths"]) == (3, 1, 1, 3, True, 1)
    assert (inner["rows"], inner["ths"], inner["captions"], inner["first_cells"]) == (1, 0, 1, 1)


def test_a_bad_span_ends_the_check(spark):
    good = "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>"
    bad = "<table><tr><th colspan='x'>1</th><th>2</th></tr><tr><td>3</td><td>4</td></tr></table>"
    before = "<table><tr><td colspan='2'>1</td><td>2</td></tr><tr><td rowspan='x'>3</td></tr></table>"
    pages = spark.createDataFrame([(1, good + bad + good), (2, before + good)], "page_id long, html string")
    e = elements(pages).persist()
    found = rules.audit(pages.selectExpr("page_id AS doc_id"), e, ["table_headers"]).collect()
    assert sorted((r["doc_id"], r["type"]) for r in found) == [(1, "table-missing-headers"), (1, "table-missing-scope"), (1, "table-missing-scope"), (2, "table-missing-caption"), (2, "table-missing-headers"), (2, "table-missing-headers")]


def test_many_images_stay_linear(spark):
    source = "<h2>head</h2>" + "".join(f"<p>para {i}</p><img src='a{i}.png' data-element-id='e'>" for i in range(5_000)) + "<p>" + "x " * 1500 + "Figure 7 shows</p>"
    e = elements(spark.createDataFrame([(1, source)], "page_id long, html string")).persist()
    images = optional_rules.images_with_context(e).filter("complex").collect()
    assert [r["ord"] for r in images] == [10_000]  # only the last one's paragraph has it, past 2,000 characters
    contexts = optional_rules.image_context(e).orderBy("ord").collect()
    assert len(contexts) == 5_000
    assert contexts[0]["context"].splitlines()[0] == "Text before image: headpara 0" and "Nearest heading: head" in contexts[4_999]["context"]
    assert contexts[4_998]["context"].splitlines()[1].startswith("Text after image: para 4999x x x")


def test_rules_name_what_they_read(spark):
    pages = spark.createDataFrame([(1, PAGE + "<table><tr><td>1</td></tr></table><form><input type='radio' name='a'></form><a href='/x' target='_blank'>x</a><img src='a'>")], "page_id long, html string")
    docs = pages.selectExpr("page_id AS doc_id")
    for name, rule in rules.REGISTRY.items():
        assert set(rule.columns) <= set(COLUMNS)
        rules.audit(docs, elements(pages, columns=rules.columns_of([name])), [name]).collect()
