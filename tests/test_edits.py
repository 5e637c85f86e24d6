"""Edits by selector, tables prepared and located, controls grouped."""

from __future__ import annotations

import pytest

from pagewright.operators import edits
from pagewright.operators.remediate import Document, fixed
from pagewright.sources import files

PAGE = '<div id="a"><p class="x y">1</p><p data-k="v-1">2</p><img src="i/b.png"></div><p>3</p>'


@pytest.mark.parametrize(
    ("selector", "text"),
    [("p", "1"), ("#a p:nth-of-type(2)", "2"), ("div + p", "3"), ("div ~ p", "3"), (".y.x", "1"), ("[data-k|=v]", "2"), ("p[data-k]", "2"), ("h1, body p, p:last-child", "3"), ("DIV > P:first-child", "1"), ("#a > p:nth-child(2)", "2")],
)
def test_selectors(selector, text):
    d = Document(PAGE)
    assert d.text(edits.select(d, selector)) == text


def test_selectors_that_meet_nothing():
    d = Document(PAGE)
    assert edits.select(d, "div > div p") is None
    assert edits.select(d, "img[src$='.gif']") is None
    assert edits.select(Document(""), "*") is None
    for wrong in ("", "p >", "> p", "p[", "p,,p", "p:hover", "p:nth-child", "5"):
        with pytest.raises(ValueError):
            edits.parsed(wrong)


def test_edits_in_order(spark):
    pages = spark.createDataFrame([(1, PAGE, "kept out"), (2, None, None), (3, "<p>as it was", None)], "page_id long, html string, doc_id string")
    todo = [(1, 2, "content", "p", None, "<b>n</b> &amp; t"), (1, 1, "attribute", "p", "ID", 'q"'), (1, 3, "replace", "p", None, ""), (1, 4, "paint", "p", None, "x"), (1, 5, "replace", "img", None, "t<i>no</i>"), (2, 1, "attribute", "p", "id", "x"), (9, 1, "attribute", "p", "id", "x")]
    got = {r["doc_id"]: r for r in edits.edited(pages, spark.createDataFrame(todo, "doc_id long, edit_no int, action string, selector string, name string, value string")).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["html"] == '<div id="a"><b>n</b> &amp; t<p data-k="v-1">2</p>t</div><p>3</p>'
    assert (got[1]["applied"], got[1]["failed"]) == ([1, 2, 5], [3, 4])
    assert (got[2]["html"], got[2]["failed"]) == ("", [1])
    assert got[3]["html"] == "<p>as it was"


def test_tables_are_prepared():
    out = edits.prepared_tables('<table><tbody><tr><td class="My-Header">a</td><td><strong>b</strong></td></tr><tr><td><table><tr><td>in</td></tr></table></td></tr></tbody></table><table></table>')
    d = Document(out)
    outer, inner, empty = d.all("table")
    assert [d.text(x) for x in d.all("th", under=outer)] == ["a", "b"]
    assert [k.tag for k in outer.kids] == ["thead", "tbody"]
    assert d.text(inner) == "in" and d.first("thead", under=inner) is None
    assert "style" not in empty.attrs and "border" in inner.attrs["style"]
    assert edits.prepared_tables("") == ""


def test_controls_are_grouped():
    kind = "form-related-controls-no-fieldset"
    nested = "<form><div><div><input><input></div><div><select></select></div></div></form>"
    html, done, failed, _ = fixed(nested, [kind])
    assert html == "<form><div><fieldset><div><input><input></div><div><select></select></div></fieldset></div></form>" and done == [kind]
    assert fixed(html, [kind])[2] == [kind]
    radios = '<form><p><input type="radio" name="size"><input type="radio" name="size"></p></form>'
    assert fixed(radios, [kind])[0] == '<form><p><fieldset><legend>Size</legend><input type="radio" name="size"><input type="radio" name="size"></fieldset></p></form>'


def test_folder_prefers_extracted_html(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>outer</p>")
    assert [r["html"] for r in files.html_folder(spark, str(tmp_path)).collect()] == ["<p>outer</p>"]
    (tmp_path / "extracted_html").mkdir()
    (tmp_path / "extracted_html" / "page-1.html").write_text("<p>inner</p>")
    assert [r["html"] for r in files.html_folder(spark, str(tmp_path)).collect()] == ["<p>inner</p>"]


def test_pages_of_findings_are_not_broadcast(spark):
    """However small Spark takes them for: of text made up on the way, it knows no length."""
    pages = spark.range(20).selectExpr("id AS page_id", "concat('<table><tr><td>', repeat('x', 1000), '</td></tr></table><table id=\"t', id, '\"></table>') AS html")
    found = spark.range(20).selectExpr("id AS doc_id", "1 AS finding_no", "'' AS type", "concat('#t', id) AS selector", "'' AS element", "'' AS text", "CAST(NULL AS INT) AS index")
    rows = edits.tables_of(pages, found)
    assert sorted(map(tuple, rows.collect())) == [(k, 1, 1) for k in range(20)]
    assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
