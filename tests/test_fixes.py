"""Fixes at their own elements, outcomes, undo, states, retries, matching in rounds."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from pagewright.functions import table_functions, text
from pagewright.operators import findings as fs
from pagewright.operators import jobs, layout, remediate, rules
from pagewright.operators.remediate import Document, settled
from pagewright.plans.further import TWO_DAYS, job_moves
from pagewright.sources import files
from pagewright.sources.html_tree import elements
from pagewright.streaming import job_state, retries, status

SF = "/root/testdata/sf0.001"


def at(source: str, tag: str, n: int = 0) -> int:
    return [x.ord for x in Document(source).nodes if x.tag == tag][n]


def one(source: str, kind: str, tag: str, n: int = 0) -> tuple[str, remediate.Result]:
    out, (result,) = settled(source, [(kind, at(source, tag, n))])
    return out, result


def test_a_fix_is_made_at_its_element_alone():
    source = "<a href='/a-b'>here</a><a href='/c'>here</a><img src='x-y.png'><img src='z.png'>"
    out, result = one(source, "generic-link-text", "a", 1)
    assert out.startswith('<a href="/a-b">here</a><a href="/c">Link to c</a>') and result.outcome == "remediated" and result.changes == 1
    out, _ = one(source, "missing-alt-text", "img", 0)
    assert 'alt="Figure: x y"' in out and out.endswith('<img src="z.png">')


def test_handles_lead_to_moved_and_removed_nodes():
    source = "<body><p>Figure 3 shows</p><img id='i' src='a.png'><p>Figure 4 is next</p><h4></h4></body>"
    findings = [("missing-main-landmark", None), ("improper-figure-structure", at(source, "img")), ("missing-alt-text", at(source, "img")), ("empty-heading", at(source, "h4")), ("generic-link-text", at(source, "p", 1)), ("no-such-kind", 0)]
    out, results = settled(source, findings)
    assert [r.outcome for r in results] == ["remediated"] * 4 + ["failed", "skipped"]
    assert out == (
        '<body><main id="main-content"><p>Figure 3 shows</p><figure role="group" class="content-figure" id="i" aria-label="Figure 4 is next"><figcaption>Figure 4 is next</figcaption>'
        '<img src="a.png" alt="Figure: a"></figure><h4>Section</h4></main></body>'
    )


def test_an_earlier_fix_settles_a_later_finding():
    source = "<p>x</p>"
    _, results = settled(source, [("missing-skip-link", None), ("missing-main-landmark", None)])
    assert [(r.outcome, r.changes) for r in results] == [("remediated", 1), ("remediated", 0)]


def test_a_breaking_provider_fails_alone():
    def ask(purpose: str, context: str) -> str:
        raise OSError("no model")

    source = "<img src='a.png'><table><tr><td>1</td><td>2</td></tr><tr><td>1</td><td>2</td></tr></table>"
    out, results = settled(source, [("missing-alt-text", 0), ("table-missing-headers", 1)], ask)
    assert [r.outcome for r in results] == ["failed", "remediated"] and results[0].note == "OSError: no model" and "<th" in out


@pytest.mark.parametrize("table", ['<table role="presentation"><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>', '<table class="Grid"><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>', "<table><tr><td>1</td></tr><tr><td>3</td></tr></table>"])
def test_layout_tables_stay(table):
    for kind in ("table-missing-headers", "table-missing-caption", "table-missing-tbody", "table-missing-headers-id", "table-irregular-headers", "table-missing-thead"):
        out, result = one(table, kind, "table")
        assert out == table and result.outcome == "skipped"
    assert remediate.fixed(table, ["table-missing-headers", "table-missing-tbody"])[0] == table


def test_named_controls_and_warned_links_stay():
    named = '<span id="n">Name</span><input aria-labelledby="n"><input title="Town"><label for="q">Q</label><input id="q"><label>R <input></label><input aria-label="S">'
    for n in range(5):
        out, result = one(named, "form-control-missing-label", "input", n)
        assert out == named and (result.outcome, result.changes) == ("remediated", 0)
    out, _ = one('<input aria-labelledby="gone" name="first_name">', "form-control-missing-label", "input")
    assert out == '<label for="control-0">First Name</label><input aria-labelledby="gone" name="first_name" id="control-0">'
    for link in ('<a target="_blank" aria-label="Site, new tab">x</a>', '<a target="_blank" title="external">x</a>', '<a target="_blank">x<span class="sr-only">opens in new window</span></a>', '<a target="_blank">x<i class="fa-external-link"></i></a>'):
        out, result = one(link, "new-window-link-no-warning", "a")
        assert out == link and result.changes == 0


def test_tables_get_what_they_lack():
    source = "<h2>Sales</h2><table><tr><th>A</th><th scope='row'>B</th></tr><tr><td>1</td><td>2</td></tr></table>"
    table = at(source, "table")
    out, results = settled(source, [("table-missing-scope", at(source, "th")), ("table-missing-thead", table), ("table-missing-tbody", table), ("table-missing-caption", table), ("table-missing-headers-id", table)])
    assert all(r.changes == 1 for r in results)
    assert out == (
        '<h2>Sales</h2><table><caption>Sales</caption><thead><tr><th scope="col" id="th-a">A</th><th scope="row" id="th-b">B</th></tr></thead>'
        '<tbody><tr><td headers="th-a">1</td><td headers="th-b">2</td></tr></tbody></table>'
    )


def test_decorative_images_and_captions():
    out, _ = one('<img src="spacer.gif" alt="">', "empty-alt-text", "img")
    assert out == '<img src="spacer.gif" alt="" role="presentation">'
    out, _ = one('<img src="a.gif" alt="" width="5" height="5">', "empty-alt-text", "img")
    assert 'role="presentation"' in out
    out, _ = one('<h2>Heads</h2><figure><img src="1.png"></figure>', "missing-figure-caption", "figure")
    assert "<figcaption>Heads</figcaption></figure>" in out
    out, _ = one('<figure><img src="red_bridge.png"></figure>', "missing-figure-caption", "figure")
    assert "<figcaption>Red Bridge</figcaption>" in out


def test_outcomes_of_pages(spark):
    source = "<html lang='en'><head><title>T is here</title></head><body><main><h1>Some</h1><h1>heading</h1><a href='/b'>here</a><a href='/b'>here</a></main></body></html>"
    pages = spark.createDataFrame([(2**60 + 1, source), (None, "<p>x</p>"), (5, None)], "page_id long, html string")
    docs = pages.selectExpr("page_id AS doc_id")
    found = rules.audit(docs, elements(pages).persist())
    fixes = remediate.remediated(pages, found).persist()
    assert {r["doc_id"] for r in fixes.collect()} == {2**60 + 1, None, 5}
    rows = remediate.outcome_rows(fixes).filter(F.col("doc_id") == 2**60 + 1).collect()
    told = {r["issue_id"]: (r["type"], r["outcome"]) for r in rows}
    numbers = {r["issue_id"]: r["type"] for r in fs.numbered(found).filter(F.col("doc_id") == 2**60 + 1).filter("status = 'needs_remediation'").collect()}
    assert {k: v[0] for k, v in told.items()} == numbers
    assert [v[1] for v in told.values()].count("skipped") == 1 and ("generic-heading", "skipped") in told.values()
    links = [r for r in rows if r["type"] == "generic-link-text"]
    assert len(links) == 2 and len({r["ord"] for r in links}) == 2 and all(r["changes"] == 1 for r in links)
    flat = files.remediation_rows(fixes)
    assert flat.columns == ["doc_id", "issue_id", "type", "outcome", "note"] and flat.count() == sum(r["processed"] for r in remediate.outcome_summary(fixes).collect())


def test_wrapping_many_children_stays_linear():
    def seconds(n):
        d = Document("<body>" + "<p>x</p>" * n + "</body>")
        begin = time.perf_counter()
        remediate.main(d, d.root, remediate.stub_provider)
        return time.perf_counter() - begin

    seconds(500)
    assert seconds(40_000) < 25 * max(seconds(4_000), 0.004)


# histories, boxes, headers


def test_undo_takes_back_the_last_that_stands(spark):
    r = random.Random(4)
    rows, stacks = [], {}
    for n in range(400):
        key = (r.randrange(3), r.choice("ab"))
        undone = r.random() < 0.45
        rows.append((*key, n, undone, f"before {n}"))
        stack = stacks.setdefault(key, [])
        if not undone:
            stack.append(n)
        elif stack:
            stack.pop()
    history = spark.createDataFrame(rows, "doc_id int, element_id string, change_no int, undone boolean, before string").repartition(3)
    got = {}
    for x in jobs.standing(history).collect():
        got.setdefault((x["doc_id"], x["element_id"]), []).append((-x["place"], x["change_no"]))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == {k: v for k, v in stacks.items() if v}
    for times in (1, 3):
        back = jobs.undo(history, times).collect()
        assert sorted((x["doc_id"], x["element_id"], x["html"]) for x in back) == sorted((*k, f"before {n}") for k, v in stacks.items() for n in v[-times:])
    # what undo gives is appended, and the next one goes on from there
    again = history.unionByName(jobs.undo(history).withColumnRenamed("html", "before"))
    assert sorted((x["doc_id"], x["element_id"], x["html"]) for x in jobs.undo(again).collect()) == sorted((*k, f"before {v[-2]}") for k, v in stacks.items() if len(v) > 1)


def test_boxes_are_matched_as_one_after_another(spark):
    r = random.Random(6)
    pairs = sorted({(1, r.randrange(60), r.randrange(60)) for _ in range(300)} | {(2, i, j) for i in range(12) for j in (i - 1, i)})
    expected, images, boxes = set(), set(), set()
    for f, i, b in pairs:
        if (f, i) not in images and (f, b) not in boxes:
            images.add((f, i))
            boxes.add((f, b))
            expected.add((f, i, b))
    rows = spark.createDataFrame([(f, i, i, b, b) for f, i, b in pairs] * 2, "file long, image_id long, image_no long, box_id long, box_no long")
    got = [tuple(x) for x in layout.one_to_one(rows).collect()]
    assert len(got) == len(expected) and set(got) == expected
    assert layout.one_to_one(rows.limit(0)).count() == 0


def test_headers_are_pruned_before_they_are_compared(spark):
    import difflib

    r = random.Random(8)
    words = ["Total amount", "Year", "Region name", "Cost of goods", "Units sold", "Average price", "2024", "", "Notes"]
    made = [(i, 1, "".join(c for c in r.choice(words) if r.random() < 0.9) + r.choice(["", "s", "!"])) for i in range(200)] + [(900, 2, "x"), (901, 1, "YEAR!")]
    wanted = spark.createDataFrame(made, "key long, table_no long, wanted string")
    headers = spark.createDataFrame([(1, k, w) for k, w in enumerate(words)], "table_no long, header_no int, header string")
    got = {x["key"]: x["header"] for x in text.matched_headers(wanted, headers, ["key"], ["table_no"]).collect()}

    def key(s):
        import re

        return re.sub("[^a-z0-9 ]", "", re.sub(r"\s+", " ", s.lower())).strip()

    def best(w):
        for h in words:
            if key(h) == key(w):
                return h
        score, _, h = max((difflib.SequenceMatcher(None, key(w), key(h)).ratio(), -k, h) for k, h in enumerate(words))
        return h if score >= 0.6 else None

    assert got == {k: best(w) if t == 1 else None for k, t, w in made}
    kept = text.header_pairs(wanted, headers, ["key"], ["table_no"]).count()
    assert kept < 0.35 * 201 * len(words)  # the rest never reaches Python


def test_table_function_in_sql(spark):
    table_functions.register(spark)
    pages = spark.createDataFrame([(1, "<p class='a b'>x</p><img>"), (2, None)], "id long, html string")
    got = spark.sql("SELECT p.id, h.* FROM {pages} p LEFT JOIN LATERAL parse_html(p.id, p.html, 'tag, classes, attrs') h ON true", pages=pages)
    assert got.columns == ["id", "tag", "classes", "attrs"]
    assert sorted((r["id"], r["tag"] or "") for r in got.collect()) == [(1, "img"), (1, "p"), (2, "")]
    with pytest.raises(Exception, match="no column nonsense"):
        spark.sql("SELECT * FROM parse_html(1L, '<p>', 'nonsense')").collect()


# states and retries


def test_steps_of_a_job():
    s, told = job_state.step(None, "AUDIT", "PENDING", 0, 1)
    assert told == "begun"
    for stage, status, want in (("AUDIT", "COMPLETED", "illegal"), ("AUDIT", "PROCESSING", "moved"), ("REMEDIATION", "PENDING", "illegal"), ("AUDIT", "COMPLETED", "moved"), ("COMPLETE", "PENDING", "illegal"), ("REMEDIATION", "PROCESSING", "moved"), ("x", "PENDING", "unknown")):
        s, told = job_state.step(s, stage, status, s.at + 1, s.event_id + 1)
        assert told == want
    assert job_state.step(s, "REMEDIATION", "FAILED", s.at, s.event_id)[1] == "repeated"
    assert job_state.step(s, "REMEDIATION", "FAILED", s.at - 1, s.event_id + 9)[1] == "late"
    assert job_state.step(s, "AUDIT", "PENDING", s.at + 8 * 24 * 3600 * 1_000_000, 99)[1] == "begun"


@pytest.fixture
def rocksdb(spark):
    job_state.rocksdb_state(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_state_stream_equals_batch(spark, tmp_path, rocksdb):
    events = job_moves(spark.read.parquet(f"{SF}/events.parquet"))
    ordered = events.orderBy("ts", "event_id").limit(400).persist()
    days = [r["day"] for r in ordered.select(F.to_date("ts").alias("day")).distinct().orderBy("day").collect()]
    for k in range(0, len(days), 5):  # files in the order of time, a few days each
        part = ordered.filter(F.to_date("ts").isin(days[k : k + 5]))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)
    stream = job_state.state_stream(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), TWO_DAYS)
    run = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).filter("job_id is not null").collect()))
    batch = job_state.fold(ordered, TWO_DAYS)
    assert got == sorted(map(tuple, batch.collect())) and len(got) == 400
    assert {r["told"] for r in batch.collect()} >= {"begun", "moved", "illegal"}


def test_batch_fold_against_plain(spark):
    rows = [(j, e, None if e % 13 == 0 else e * 7919 % 1000 * 10**9, ["AUDIT", "REMEDIATION", "odd"][e % 3 if e % 5 == 0 else 0], ["PENDING", "PROCESSING", "FAILED"][e % 3]) for j in (1, 2, 2**60 + 1) for e in range(60)]
    rows += rows[:5] + [(None, 1, 5, "AUDIT", "PENDING")]
    df = spark.createDataFrame(rows, "job_id long, event_id long, at long, stage string, status string").select("job_id", "event_id", F.timestamp_micros("at").alias("ts"), "stage", "status")
    got = sorted((r["job_id"], r["event_id"], r["told"], r["stage"], r["status"], r["moves"], r["illegal"]) for r in job_state.fold(df).collect())
    plain = sorted((r for r in rows if r[0] is not None and r[2] is not None), key=lambda r: (r[0], r[2], r[1]))
    assert got == sorted((j, e, t, s, x, m, i) for j, e, _, t, s, x, m, i in job_state.replay(plain))
    assert any(g[2] == "repeated" for g in got)


def test_a_stopped_run_is_taken_up(spark, tmp_path):
    items = spark.createDataFrame([(i,) for i in range(60)] + [(2**60 + 1,)], "item long")

    def handle(item, attempt):
        if attempt <= item % 5:
            raise RuntimeError("not yet")
        return True, f"done at {attempt}"

    whole, waits = str(tmp_path / "whole"), []
    assert retries.work_off(items, handle, whole, slices=3, wait=waits.append)
    ticks = iter(range(10_000))
    broken, runs = str(tmp_path / "broken"), 0
    while not retries.work_off(items, handle, broken, budget_seconds=2.5, slices=3, clock=lambda: next(ticks)):
        runs += 1
        assert runs < 20
    assert runs >= 2
    a, b = (sorted(map(tuple, retries.ledger_of(spark, p).collect())) for p in (whole, broken))
    assert a == b
    settled_ = {r["item"]: (r["tries"], r["ok"], r["settled"]) for r in retries.settled_items(retries.ledger_of(spark, whole)).collect()}
    assert settled_ == {i: (min(i % 5 + 1, 3), i % 5 < 3, True) for i in [*range(60), 2**60 + 1]}
    assert len(waits) == 2 and 1 <= waits[0] < 2 <= waits[1] < 3
    # a slice that was not finished counts for nothing
    (tmp_path / "broken" / "pass-3" / "slice-0" / "_SUCCESS").unlink()
    assert retries.ledger_of(spark, broken).filter("attempt = 3 and slice = 0").isEmpty()
    assert retries.work_off(items, handle, broken, slices=3) and sorted(map(tuple, retries.ledger_of(spark, broken).collect())) == a


def test_uploads_count_once(spark, tmp_path):
    rows = [(f"k{i % 7}", f"2024-01-0{1 + i % 3} 0{i % 9}:00:00") for i in range(40)]
    events = spark.createDataFrame(rows, "key string, ts string").withColumn("ts", F.to_timestamp("ts"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = status.uploads_once(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), late="9 days")
    status.run_to_table(stream, "uploads_seen", str(tmp_path / "state"), "append")
    assert sorted(r["key"] for r in spark.table("uploads_seen").collect()) == [f"k{i}" for i in range(7)]
