"""The audit library: golden snippets, properties, sources, streams and fixes."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright import config
from pagewright.functions import colour, text
from pagewright.operators import findings as fs
from pagewright.operators import images, jobs, layout, remediate, rules
from pagewright.operators.dims import wcag_rows
from pagewright.plans import catalog
from pagewright.plans.golden import FAMILIES
from pagewright.sources import files
from pagewright.sources.html_tree import COLUMNS, element_rows, elements
from pagewright.streaming import status

SF = "/root/testdata/sf0.001"


def test_registry_has_all_types():
    assert len(rules.REGISTRY) == 17
    assert len({t for r in rules.REGISTRY.values() for t in r.types}) == 56
    assert len(wcag_rows()) == 77 or len(wcag_rows()) == 78


@pytest.mark.parametrize("family", ["tables", "rest"])
def test_golden_snippets(spark, family):
    chosen = {k: v for k, v in FAMILIES.items() if k.startswith("table") == (family == "tables")}
    cases = [(i, check, h, types) for i, (check, h, types) in enumerate((c, h, t) for c, cs in chosen.values() for h, t in cs)]
    pages = spark.createDataFrame([(i, h) for i, _, h, _ in cases], "page_id long, html string").coalesce(1)
    e = elements(pages).persist()
    docs = pages.select(F.col("page_id").alias("doc_id"))
    got: dict = {}
    for r in rules.audit(docs, e, sorted({c for _, c, _, _ in cases})).join(docs, "doc_id").select("doc_id", "check_no", "type").collect():
        got.setdefault((r["doc_id"], r["check_no"]), []).append(r["type"])
    for i, check, h, types in cases:
        assert sorted(got.get((i, rules.REGISTRY[check].number), [])) == sorted(types), h


def _place(rows, k):
    """An element's text, from the page's buffer."""
    at, length, page = list(COLUMNS).index("text_at"), list(COLUMNS).index("text_length"), list(COLUMNS).index("page_text")
    return rows[0][page][rows[k][at] : rows[k][at] + rows[k][length]]


def test_paths_and_context():
    rows = list(element_rows(1, '<html><body><div id="a"><p>x</p><p class="k page_7">y<b>z</b></p></div></body></html>'))
    paths = [r[11] for r in rows]
    assert paths[3] == "div#a > p" and paths[4] == "div#a > p.k.page_7"
    assert _place(rows, 4) == "yz" and rows[4][14] == 7 and rows[5][14] == 7


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="<>/ab p=\"'&;!-\n", max_size=60))
def test_parser_takes_anything(source):
    rows = list(element_rows(1, source))
    assert [r[1] for r in rows] == list(range(len(rows)))
    assert all(r[3] >= r[1] and (r[2] is None or r[2] < r[1]) for r in rows)


def test_unclosed_elements_stay_linear():
    source = "".join(f"<p>text {i}" for i in range(5000))
    rows = list(element_rows(1, source, tuple(c for c in COLUMNS if c not in ("css_path", "snippet"))))
    assert len(rows) == 5000 and rows[0][3] == 4999
    # only the first row holds text, the page's; the others say where theirs stands in it
    named = [dict(zip([c for c in COLUMNS if c not in ("css_path", "snippet")], r, strict=True)) for r in rows]
    page = named[0]["page_text"]
    assert page.startswith("text 0text 1") and all(r["text"] is None and (r["page_text"] is None) == (r["ord"] > 0) for r in named)
    assert all(page[r["text_at"] : r["text_at"] + r["text_length"]] == "".join(f"text {i}" for i in range(r["ord"], 5000)) for r in named[::500])
    fixed = remediate.fixed(f"<!-- kept -->{source}<a href='/x-y'>learn more</a>", ["missing-title", "generic-link-text"])
    assert "<!-- kept -->" in fixed[0] and "text 4999" in fixed[0] and ">Link to x y</a>" in fixed[0]


def test_contrast_fix_reads_the_background_around():
    source = '<div style="background-color:#000000"><p style="color:#222222">a</p><p style="color: #ffffff">b</p></div><p style="color:#333333">c</p><p style="background-color:#FFFF00;color:#ffffff">d</p>'
    out, done, _, _ = remediate.fixed(source, ["insufficient-color-contrast"])
    assert done and out.count("#ffffff") == 3 and 'color:#333333' in out and 'style="color: #000000; background-color:#FFFF00"' in out


@pytest.mark.parametrize("phrase", rules.GENERIC_LINKS)
def test_link_fix_knows_all_phrases(phrase):
    out, done, _, _ = remediate.fixed(f'<a href="https://www.site.com/a">{phrase}</a><a href="/{phrase}">see example.com</a>', ["generic-link-text"])
    assert done and ">Link to site</a>" in out and "example.com</a>" not in out


def test_contrast_is_symmetric(spark):
    df = spark.createDataFrame([("#FFFFFF", "#000000"), ("#777777", "#FFFFFF"), ("#123456", "#123456")], "a string, b string")
    got = df.select(colour.contrast(F.col("a"), F.col("b")), colour.contrast(F.col("b"), F.col("a")), colour.normalised(F.lit("rgb( 1, 20,255)")), colour.normalised(F.lit("#abc"))).collect()
    assert [round(r[0], 2) for r in got] == [21.0, 4.48, 1.0] and all(abs(r[0] - r[1]) < 1e-9 for r in got)
    assert got[0][2] == "#0114FF" and got[0][3] == "#AABBCC"


def test_threshold_and_limits(spark):
    df = spark.createDataFrame([(1, 1, i, f"t{i}", s, "needs_remediation") for i, s in enumerate(("critical", "minor", "odd", "major"))] + [(1, 2, 9, "compliant-x", "info", "compliant")], "doc_id long, check_no int, emit_no long, type string, severity string, status string")
    assert {r["type"] for r in fs.over_threshold(df, "major").collect()} == {"t0", "t3", "compliant-x"}
    assert {r["type"] for r in fs.over_threshold(df, "nonsense").collect()} == {"t0", "t1", "t3", "compliant-x"}
    assert {r["type"] for r in fs.to_remediate(df, None, "minor", 3).collect()} == {"t0", "t1", "t2"}


def test_frontier_moves_by_one(spark):
    got = spark.range(1).select(jobs.frontier(F.array(*map(F.lit, (0, 2, 1, 2, 5)))).alias("a"), jobs.frontier(F.array(F.lit(2)), F.lit(2)).alias("b"), jobs.frontier(F.array(F.lit(5)), F.lit(3)).alias("c")).first()
    assert (got["a"], got["b"], got["c"]) == (3, 3, 3)


def test_chunks_cover_all_pages(spark):
    got = jobs.chunk_plan(spark.createDataFrame([(1, "a/b.pdf", 401), (2, "c.pdf", 200), (3, "d.pdf", 0)], "doc_id long, key string, pages int")).orderBy("doc_id", "chunk").collect()
    assert [(r["doc_id"], r["first_page"], r["last_page"], r["name"]) for r in got] == [(1, 1, 200, "b_chunk_1.pdf"), (1, 201, 400, "b_chunk_2.pdf"), (1, 401, 401, "b_chunk_3.pdf"), (2, 1, 200, "c_chunk_1.pdf")]


def test_text_rules(spark):
    row = spark.range(1).select(
        text.clean_alt(F.lit(' "image of a cat..." ')).alias("alt"), text.header_id(F.lit("Total Amount"), F.lit(2)).alias("slug"), text.header_id(F.lit("2 x"), F.lit(2)).alias("odd"),
        text.reply_map(F.lit("```json\n{\"42\":\"hello\"}\n```"))["42"].alias("reply"), text.merged_key(F.lit("a/b.pdf")).alias("key"),
    ).first()
    assert tuple(row) == ("A cat", "th-total-amount", "header-2", "hello", "a/FINAL_b.pdf")


def test_long_glyph_codes_stay_whole(spark, tmp_path):
    spark.createDataFrame([(10,), (65535,), (65536,), (1200000,)], "p_partkey long").write.parquet(str(tmp_path / "part.parquet"))
    rows = catalog.queries()["glyph_pairs"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == {(10, "000A=A"), (65535, "FFFF=A"), (65536, "10000=A"), (1200000, "124F80=A")}


def test_boxes_are_matched_once(spark):
    images = spark.createDataFrame([(1, 1, 1, 10.0, 10.0, 5.0, 5.0), (1, 2, 2, 12.0, 10.0, 5.0, 5.0)], "file long, image_id long, image_no long, x double, top double, width double, height double")
    boxes = spark.createDataFrame([(1, 7, 1, 17.0, 10.0, 5.0, 5.0), (1, 8, 2, 19.4, 17.5, 5.0, 5.0), (1, 9, 3, 19.0, 17.0, 5.0, 5.0)], "file long, box_id long, box_no long, x double, top double, width double, height double")
    got = {(r["image_id"], r["box_id"]) for r in layout.one_to_one(layout.box_candidates(images, boxes)).collect()}
    assert got == {(1, 7), (2, 9)}


def test_bbox_match_takes_the_whole_table(spark):
    images, boxes = {}, {}
    for r in spark.read.parquet(f"{SF}/lineitem.parquet").collect():
        box = (r["l_partkey"] % 97, r["l_suppkey"] % 89, round(r["l_quantity"]), r["l_linenumber"] * 5)
        kind = images if r["l_returnflag"] == "R" else boxes
        kind.setdefault(r["l_orderkey"], []).append((r["l_orderkey"] * 10 + r["l_linenumber"], box))
    expected = set()
    for file, some in images.items():
        near = sorted({(i, o) for i, a in some for o, b in boxes.get(file, []) if all(abs(x - y) <= layout.TOLERANCE for x, y in zip(a, b, strict=True))})
        taken_images, taken_boxes = set(), set()
        for i, o in near:
            if i not in taken_images and o not in taken_boxes:
                taken_images.add(i)
                taken_boxes.add(o)
                expected.add((file, i, o))
    got = [tuple(r) for r in catalog.bbox_match(spark, SF).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_fixes_leave_nothing_behind(spark):
    source = '<html><head></head><body><p>Some text</p><img src="red-bridge.png"><a href="/a">here</a><table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table><input name="q"></body></html>'
    pages = spark.createDataFrame([(1, source)], "page_id long, html string")
    docs = pages.select(F.col("page_id").alias("doc_id"))

    def left(p):
        return {r["type"] for r in rules.audit(docs, elements(p).persist()).filter("status = 'needs_remediation'").collect()}

    before = left(pages)
    assert {"missing-alt-text", "generic-link-text", "table-missing-headers", "missing-main-landmark", "no-headings"} <= before
    out = remediate.remediated(pages, rules.audit(docs, elements(pages).persist())).select(F.col("doc_id").alias("page_id"), "html").persist()
    assert not left(out) & {"missing-alt-text", "generic-link-text", "table-missing-headers", "missing-main-landmark", "no-headings", "missing-title", "missing-skip-link", "form-control-missing-label"}


def test_files_and_reports(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "page-2.html").write_text("<h1>b</h1>")
    (tmp_path / "in" / "page-10.html").write_text("<h1>a</h1>")
    (tmp_path / "in" / "deep" / "other.html").write_text("<p>")
    assert [r["page_number"] for r in files.by_page(files.html_files(spark, str(tmp_path / "in"))).collect()] == [2, 10]
    found = files.html_files(spark, str(tmp_path / "in"), recursive=True)
    assert found.count() == 3
    pages = found.select(F.monotonically_increasing_id().alias("page_id"), "html").persist()
    e = elements(pages).persist()
    full = fs.numbered(fs.enriched(rules.audit(pages.select(F.col("page_id").alias("doc_id")), e), e)).persist()
    for kind in ("json", "csv", "text", "html", "odd"):
        files.write_report(full, str(tmp_path / kind), kind)
    assert spark.read.json(str(tmp_path / "json")).count() == full.count() == spark.read.option("header", True).csv(str(tmp_path / "csv")).count()


def test_places_have_no_gaps(spark):
    """Also where ranges are found by samples, and the files have more columns than their order."""
    files_ = spark.range(60_000).selectExpr("id", "concat('out/', CASE WHEN id % 3 = 0 THEN 'other' ELSE 'page-' END, id, '.html') AS file", "repeat(id, 9) AS html").withColumn("page_number", text.page_number(F.col("file")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    try:
        rows = files.placed(files_).select("place", "id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    order = sorted(range(60_000), key=lambda k: (999, f"out/other{k}.html") if k % 3 == 0 else (k, ""))
    assert sorted(map(tuple, rows)) == [(n + 1, k) for n, k in enumerate(order)]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = status.status_stream(status.event_stream(spark, str(tmp_path / "in"), events.schema, 2))
    status.run_to_table(stream, "latest_files", str(tmp_path / "state"))
    log = events.select(F.col("user_id").alias("file"), "ts", "event_id", F.col("event_type").alias("status"))
    assert {tuple(r) for r in spark.table("latest_files").select("file", "status").collect()} == {tuple(r) for r in jobs.latest_status(log).collect()}


def test_image_places(spark):
    files_ = spark.createDataFrame([("out/assets/a.png",), ("out/page/x/a.png",), ("out/page/b-1.JPG",), ("else/c.png",)], "path string")
    wanted = spark.createDataFrame([("a.png",), ("b.png",), ("c.png",), ("a.png",)], "name string")
    bases = spark.createDataFrame([("out/page", 0)], "base string, base_no int")
    assert {tuple(r) for r in images.resolved(wanted, bases, files_).collect()} == {("a.png", "out/assets/a.png"), ("b.png", "out/page/b-1.JPG"), ("c.png", None)}


def test_image_files_and_names_are_not_broadcast(spark):
    """However small Spark takes them for. Of files whose names begin alike, the first path stays."""
    files_ = spark.range(60).selectExpr("concat('out/page/', CASE WHEN id < 30 THEN 'x/' ELSE '' END, 'n', id, '.png') AS path")
    wanted = spark.range(1, 8).selectExpr("concat('n', id, CASE WHEN id < 4 THEN '.webp' ELSE '.png' END) AS name").unionByName(spark.range(1).selectExpr("'else.png' AS name"))
    rows = images.resolved(wanted, spark.createDataFrame([("out/page", 0)], "base string, base_no int"), files_)
    alike = {("n1.webp", "out/page/x/n1.png"), ("n2.webp", "out/page/x/n2.png"), ("n3.webp", "out/page/n30.png")}
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(alike | {(f"n{k}.png", f"out/page/x/n{k}.png") for k in range(4, 8)} | {("else.png", None)}, key=str)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BuildLeft" not in plan
    assert "BroadcastHashJoin [name" not in plan and "BroadcastHashJoin [stem" not in plan


def test_layout_matches_by_page_alone(spark):
    elements_ = spark.createDataFrame([(1, 0, 7, 0, "<img src='x.png'>"), (1, 0, 8, 1, "<p>t</p>"), (1, 1, 9, 0, "<p>only</p>"), (2, 0, 5, 0, "<img src='x.png'>")], "doc_id int, page int, id int, list_no int, html string")
    issues = spark.createDataFrame([(1, 1, 0, "p > img:nth-of-type(1)", None, "t"), (2, 1, 1, None, None, "t"), (3, 1, 0, None, "src='x.png'", "t"), (4, 1, 0, None, "none", "t"), (5, 1, 0, None, "none", "long-alt-text")], "issue_id int, doc_id int, page int, path string, context string, type string")
    assert {tuple(r) for r in layout.issue_elements(issues, elements_).collect()} == {(1, 1, 7, 0), (1, 2, 9, 2), (1, 3, 7, 1), (1, 4, None, None), (1, 5, 7, 5)}
    # ids begin anew in each document
    again = issues.filter("issue_id = 1").unionByName(spark.createDataFrame([(1, 2, 0, None, "src='x.png'", "t")], issues.schema))
    assert {tuple(r) for r in layout.issue_elements(again, elements_).collect()} == {(1, 1, 7, 0), (2, 1, 5, 1)}


def test_captions_come_later_in_the_reading_order(spark):
    rows = spark.createDataFrame([(1, 0, 1, 0, 5, "FIGURE", ""), (1, 0, 2, 1, 2, "TEXT", "Figure 1"), (1, 0, 3, 2, 9, "TEXT", "Figure 2"), (1, 0, 4, 3, 6, "TEXT", "Figure 3")], "doc_id int, page int, id int, list_no int, reading_order int, type string, text string")
    assert layout.captions(rows).first()["caption"] == "Figure 2"


def test_steps_and_cells(spark):
    row = spark.range(1).select(
        text.spoken_step(F.lit("2) [Cl-] ! (x )")).alias("step"), text.prose_rows(F.lit("The first row contains 'A' under 'Transporter', 'b' under 'Tissue Expression', and 'c' under 'Biological Role'.")).alias("rows"),
        text.spoken_formula(F.lit("Cl-/HCO3- Antiporter")).alias("bare"), text.needs_encoding_repair(F.lit(None).cast("string")).alias("none"),
    ).first()
    assert row["step"] == "Step 2. open bracket chloride, Cl minus, close bracket increased open parenthesis x close parenthesis"
    assert row["rows"] == [["A", "b", "c"]] and "exchanging" not in row["bare"] and row["none"] is False


def test_settings_by_precedence(tmp_path, monkeypatch):
    (tmp_path / "c.json").write_text('{"audit": {"level": "AA", "limit": 5}, "name": "file"}')
    monkeypatch.setenv("DOC_ACCESS_AUDIT__LIMIT", "7")
    got = config.settings({"audit": {"level": "A", "limit": 1, "deep": True}, "name": "x"}, str(tmp_path / "c.json"), {"name": "given"})
    assert got == {"audit": {"level": "AA", "limit": 7, "deep": True}, "name": "given"}
    assert config.problems(got, {"name": str}, {"audit": dict, "more": int}) == []
    assert config.problems({"name": 3}, {"name": str, "path": str}, {}) == ["name: must be str, is int", "path: is missing"]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
