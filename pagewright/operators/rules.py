"""The audit rules: functions from the element table to findings, in a registry.

A finding is (doc_id, check_no, emit_no, type, wcag, severity, status, ord). Rules are filters, joins
on (doc_id, ord), aggregations and windows over the element table; ancestors were noted while
parsing, so containment is an equi join too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.functions import colour

from .structure import first_inside, sums_inside, with_text

Rule = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    number: int
    types: tuple[str, ...]
    run: Rule
    columns: tuple[str, ...]


REGISTRY: dict[str, Registered] = {}

FINDING = ("doc_id", "check_no", "emit_no", "type", "wcag", "severity", "status", "ord")

# Texts that say nothing, and phrases that warn of a new window.
GENERIC_HEADINGS = ("heading", "title", "subtitle", "header")
GENERIC_TITLES = ("untitled", "document", "page", "new page", "title")
GENERIC_ALTS = ("image", "diagram", "photo", "picture", "graphic", "icon")
GENERIC_LINKS = (
    "click here", "click", "here", "read more", "more", "learn more", "details", "link", "this link", "this page", "this", "go", "go to",
    "view", "view more", "see more", "see details", "continue", "continue reading",
)
# Addresses as link texts; classes of texts for readers, and of icons.
URL_TEXT = r"(?i)^https?://|^www\.|\.com(/|$)|\.org(/|$)|\.net(/|$)|\.edu(/|$)|\.gov(/|$)|\.io(/|$)"
NEW_WINDOW = ("new window", "new tab", "opens in new", "external")
READER_CLASSES = ("sr-only", "visually-hidden", "screen-reader-text")
ICON_CLASSES = ("external", "new-window", "fa-external-link")
SKIPPED_INPUTS = ("hidden", "submit", "reset", "button")
TEXT_TAGS = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "a", "span", "div", "li", "td", "th")


def rule(name: str, number: int, *types: str, reads: str = "") -> Callable[[Rule], Rule]:
    """Registers a rule; number is its place in the order of checks, reads names the columns of the
    element table that it needs besides doc_id, ord and tag."""

    def add(run: Rule) -> Rule:
        REGISTRY[name] = Registered(name, number, types, run, ("doc_id", "ord", "tag", *reads.split()))
        return run

    return add


def columns_of(checks: list[str] | None = None) -> list[str]:
    """What the named rules (all: None) read of the element table."""
    return list(dict.fromkeys(c for r in REGISTRY.values() if checks is None or r.name in checks for c in r.columns))


def attr(name: str) -> Column:
    return F.col("attrs")[name]


def _long(name: str) -> Column:
    return F.col(name).cast("long")


def found(rows: DataFrame, kind: Column | str, wcag: str, severity: Column | str, ord_: Column | None = None, emit: Column | None = None) -> DataFrame:
    """Findings from rows that have doc_id and ord; types that start with compliant- are compliant."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    severity = F.lit(severity) if isinstance(severity, str) else severity
    at = F.col("ord") if ord_ is None else ord_
    return rows.select(
        "doc_id",
        (F.coalesce(at, F.lit(-1)) if emit is None else emit).cast("long").alias("emit_no"),
        kind.alias("type"),
        F.lit(wcag).alias("wcag"),
        severity.alias("severity"),
        F.when(kind.startswith("compliant-"), "compliant").otherwise("needs_remediation").alias("status"),
        at.cast("int").alias("ord"),
    ).filter("type is not null")


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def headings_of(e: DataFrame) -> DataFrame:
    return e.filter(F.col("tag").rlike("^h[1-6]$")).withColumn("level", F.substring("tag", 2, 1).cast("int"))


@rule("heading_hierarchy", 1, "no-headings", "no-h1", "skipped-heading-level", "compliant-heading-hierarchy")
def heading_hierarchy(docs: DataFrame, e: DataFrame) -> DataFrame:
    levels = headings_of(e).groupBy("doc_id", "level").agg(F.min("ord").alias("ord"))
    before = F.lag("level").over(Window.partitionBy("doc_id").orderBy("level"))
    gaps = levels.withColumn("gap", F.col("level") > before + 1).filter("gap")
    per_doc = levels.groupBy("doc_id").agg(F.min("level").alias("least"), F.min_by("ord", "level").alias("ord")).join(gaps.groupBy("doc_id").agg(F.count("*").alias("gaps")), "doc_id", "left")
    state = docs.select("doc_id").join(per_doc, "doc_id", "left")
    kind = F.when(F.col("least").isNull(), "no-headings").when(F.col("least") > 1, "no-h1").when(F.col("gaps").isNull(), "compliant-heading-hierarchy")
    return union(found(state, kind, "1.3.1", "major", F.when(F.col("least") == 1, F.col("ord"))), found(gaps, "skipped-heading-level", "1.3.1", "major"))


@rule("heading_content", 2, "empty-heading", "generic-heading", "compliant-heading-content", reads="text")
def heading_content(docs: DataFrame, e: DataFrame) -> DataFrame:
    h = headings_of(e)
    kind = F.when(F.col("text") == "", "empty-heading").when(F.lower("text").isin(*GENERIC_HEADINGS), "generic-heading")
    bad = found(h, kind, "2.4.6", F.when(F.col("text") == "", "major").otherwise("minor"))
    fine = h.groupBy("doc_id").agg(F.min_by("ord", F.struct("level", "ord")).alias("ord")).join(bad.select("doc_id").distinct(), "doc_id", "left_anti")
    return union(bad, found(fine, "compliant-heading-content", "2.4.6", "minor"))


@rule("document_title", 3, "missing-title", "empty-title", "generic-title", "compliant-document-title", reads="text")
def document_title(docs: DataFrame, e: DataFrame) -> DataFrame:
    first = e.filter("tag = 'title'").groupBy("doc_id").agg(F.min("ord").alias("ord"), F.min_by("text", "ord").alias("text"))
    state = docs.select("doc_id").join(first, "doc_id", "left")
    kind = F.when(F.col("ord").isNull(), "missing-title").when(F.col("text") == "", "empty-title").when(F.lower("text").isin(*GENERIC_TITLES), "generic-title").otherwise("compliant-document-title")
    return found(state, kind, "2.4.2", F.when(kind == "generic-title", "minor").otherwise("major"))


@rule("document_language", 4, "missing-document-language", "invalid-document-language", "compliant-document-language", reads="attrs")
def document_language(docs: DataFrame, e: DataFrame) -> DataFrame:
    first = e.filter("tag = 'html'").groupBy("doc_id").agg(F.min("ord").alias("ord"), F.min_by(F.struct(attr("lang").alias("lang")), "ord").alias("s"))
    lang = F.col("s.lang")
    kind = F.when(lang.isNull(), "missing-document-language").when(F.length(F.trim(lang)) < 2, "invalid-document-language").otherwise("compliant-document-language")
    return found(first, kind, "3.1.1", F.when(kind == "invalid-document-language", "major").otherwise("critical"))


def _landmark(docs: DataFrame, e: DataFrame, tag: str, role: str, name: str, severity: str, emit: int) -> DataFrame:
    has = e.filter((F.col("tag") == tag) | (attr("role") == role)).groupBy("doc_id").agg(F.min_by("ord", F.struct(F.col("tag") != tag, "ord")).alias("ord"))
    state = docs.select("doc_id").join(has, "doc_id", "left")
    return found(state, F.when(F.col("ord").isNull(), f"missing-{name}-landmark").otherwise(f"compliant-{name}-landmark"), "1.3.1", severity, emit=F.lit(emit))


@rule("main_landmark", 5, "missing-main-landmark", "compliant-main-landmark", reads="attrs")
def main_landmark(docs: DataFrame, e: DataFrame) -> DataFrame:
    return _landmark(docs, e, "main", "main", "main", "major", 0)


@rule("skip_link", 6, "missing-skip-link", "compliant-skip-link", reads="attrs text")
def skip_link(docs: DataFrame, e: DataFrame) -> DataFrame:
    first = e.filter("tag = 'a'").withColumn("no", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))).filter("no <= 5")
    has = first.filter(attr("href").startswith("#") & F.lower("text").rlike("skip|jump|content|main")).groupBy("doc_id").agg(F.min("ord").alias("ord"))
    state = docs.select("doc_id").join(has, "doc_id", "left")
    return found(state, F.when(F.col("ord").isNull(), "missing-skip-link").otherwise("compliant-skip-link"), "2.4.1", "major")


@rule("landmarks", 7, *[f"{s}-{n}-landmark" for n in ("navigation", "header", "footer") for s in ("missing", "compliant")], reads="attrs")
def landmarks(docs: DataFrame, e: DataFrame) -> DataFrame:
    """The three kinds at once: one aggregation by document, of which each gives a row."""
    kinds = (("nav", "navigation", "navigation"), ("header", "banner", "header"), ("footer", "contentinfo", "footer"))
    firsts = [F.min(F.when((F.col("tag") == tag) | (attr("role") == role), F.struct(F.col("tag") != tag, "ord"))).alias(name) for tag, role, name in kinds]
    has = e.filter(F.col("tag").isin(*[k[0] for k in kinds]) | attr("role").isin(*[k[1] for k in kinds])).groupBy("doc_id").agg(*firsts)
    each = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(i).alias("no"), F.col(f"{name}.ord").alias("ord")) for i, (_, _, name) in enumerate(kinds)])
    state = docs.select("doc_id").join(has, "doc_id", "left").select("doc_id", F.inline(each))
    kind = F.concat(F.when(F.col("ord").isNull(), "missing-").otherwise("compliant-"), "name", F.lit("-landmark"))
    return found(state, kind, "1.3.1", "minor", emit=F.col("no"))


@rule("alt_text", 8, "missing-alt-text", "compliant-decorative-image", "empty-alt-text", "generic-alt-text", "compliant-alt-text", reads="attrs")
def alt_text(docs: DataFrame, e: DataFrame) -> DataFrame:
    alt = attr("alt")
    blank = F.trim(alt) == ""
    decorative = (attr("role") == "presentation") | (attr("aria-hidden") == "true")
    kind = F.when(alt.isNull(), "missing-alt-text").when(blank & F.coalesce(decorative, F.lit(False)), "compliant-decorative-image").when(blank, "empty-alt-text")
    kind = kind.when(F.lower(F.trim(alt)).isin(*GENERIC_ALTS), "generic-alt-text").otherwise("compliant-alt-text")
    severity = F.when(kind.isin("missing-alt-text", "compliant-alt-text"), "critical").when(kind == "compliant-decorative-image", "minor").otherwise("major")
    return found(e.filter("tag = 'img'"), kind, "1.1.1", severity)


@rule("figure_structure", 9, "missing-figure-caption", "empty-figure-caption", "compliant-figure-structure", reads="end_ord text")
def figure_structure(docs: DataFrame, e: DataFrame) -> DataFrame:
    captions = e.filter("tag = 'figcaption'").select("doc_id", "ord", "text")
    figures = first_inside(e.filter("tag = 'figure'").select("doc_id", "ord", "end_ord"), captions, ["text"], "first").withColumn("caption", F.col("first.text"))
    kind = F.when(F.col("caption").isNull(), "missing-figure-caption").when(F.col("caption") == "", "empty-figure-caption").otherwise("compliant-figure-structure")
    return found(figures, kind, "1.1.1", "major")


@rule("link_text", 10, "compliant-image-link", "empty-link-text", "generic-link-text", "url-as-link-text", "compliant-link-text", "duplicate-link-text-different-url", reads="end_ord attrs text string")
def link_text(docs: DataFrame, e: DataFrame) -> DataFrame:
    images = e.filter("tag = 'img'").select("doc_id", "ord", attr("alt").alias("alt"))
    href = F.coalesce(attr("href"), F.lit(""))
    every = e.filter("tag = 'a'").withColumn("href", href)
    links = first_inside(every.filter(~F.col("href").rlike("^#+$")).select("doc_id", "ord", "end_ord", "text", "href"), images, ["alt"], "img")
    text = F.col("text")
    kind = F.when((text == "") & (F.coalesce(F.col("img.alt"), F.lit("")) != ""), "compliant-image-link").when(text == "", "empty-link-text")
    kind = kind.when(F.lower(text).isin(*GENERIC_LINKS), "generic-link-text").when(text.rlike(URL_TEXT), "url-as-link-text").otherwise("compliant-link-text")
    severity = F.when(kind == "empty-link-text", "critical").when(kind == "generic-link-text", "major").when(kind == "url-as-link-text", "minor").otherwise("info")
    same = links.filter(text != "").groupBy("doc_id", F.lower("text").alias("low")).agg(F.count_distinct("href").alias("n")).filter("n > 1")
    flagged = every.withColumn("low", F.lower("string")).join(same, ["doc_id", "low"])
    return union(found(links, kind, "2.4.4", severity), found(flagged, "duplicate-link-text-different-url", "2.4.9", "major", emit=_long("ord") + 1_000_000))


@rule("new_window", 11, "new-window-link-no-warning", "compliant-new-window-link", reads="end_ord attrs text text_in text_at text_length page_text own_text")
def new_window(docs: DataFrame, e: DataFrame) -> DataFrame:
    warns = "|".join(NEW_WINDOW)
    classed = e.withColumn("class", attr("class"))
    reader = classed.filter(F.col("tag").isin("span", "div") & F.col("class").rlike("|".join(READER_CLASSES)))
    reader = with_text(reader.select("doc_id", "ord", "text_in", "text_at", "text_length"), e).filter(F.lower("text").rlike(warns))
    icon = classed.filter((F.col("tag") == "i") & F.col("class").rlike("|".join(ICON_CLASSES)))
    flags = reader.select("doc_id", "ord").unionByName(icon.select("doc_id", "ord"))
    links = sums_inside(e.filter("tag = 'a'").select("doc_id", "ord", "end_ord", "attrs", "text"), flags, told=F.lit(1))
    warned = (F.col("told") > 0) | F.lower("text").rlike(warns) | F.coalesce(F.lower(attr("aria-label")).rlike(warns), F.lit(False)) | F.coalesce(F.lower(attr("title")).rlike(warns), F.lit(False))
    blank = links.filter(attr("target") == "_blank").withColumn("turn", F.lit(0))
    external = links.filter(F.array_contains(F.split(attr("rel"), r"\s+"), "external")).withColumn("turn", F.lit(1))  # a link in both is told twice
    kind = F.when(warned, "compliant-new-window-link").otherwise("new-window-link-no-warning")
    return found(blank.unionByName(external), kind, "3.2.5", F.when(warned, "info").otherwise("minor"), emit=F.col("turn") * 1_000_000 + _long("ord"))


def table_facts(e: DataFrame) -> DataFrame:
    """Per table what the table rules ask for; nested tables' parts count for the outer ones too. Counts
    are sums over intervals: of cells inside rows, then of rows and cells inside tables.

    A span that is no number ends a check when it is reached, before any merged cell, in a data table:
    stop is the first such table of the document."""
    parts = e.filter(F.col("tag").isin("tr", "td", "th", "caption", "thead", "tbody")).select("doc_id", "ord", "end_ord", "tag", "attrs")
    is_cell = F.col("tag").isin("td", "th")
    (down, bad_down), (across, bad_across) = [(attr(a).try_cast("int"), attr(a).isNotNull() & attr(a).try_cast("int").isNull()) for a in ("rowspan", "colspan")]
    wide = F.coalesce(down > 1, F.lit(False))
    cells = parts.filter(is_cell).withColumns({"is_th": F.col("tag") == "th", "bad": bad_down | (~wide & bad_across), "merged": wide | (~bad_down & F.coalesce(across > 1, F.lit(False)))})

    def n(where: Column) -> Column:
        return F.coalesce(where, F.lit(False)).cast("int")

    def tagged(tag: str) -> Column:
        return n(F.col("tag") == tag)

    rows = sums_inside(parts.filter("tag = 'tr'").select("doc_id", "ord", "end_ord"), cells, cells=F.lit(1), row_ths=n(F.col("is_th")))
    rows = first_inside(rows, cells, ["is_th"], "first")
    out = e.filter("tag = 'table'").select("doc_id", "ord", "end_ord", "attrs", "classes")
    out = sums_inside(
        out, parts, ths=tagged("th"), rows=tagged("tr"), captions=tagged("caption"), theads=tagged("thead"), tbodies=tagged("tbody"),
        with_headers=n((F.col("tag") == "td") & attr("headers").isNotNull()), with_id=n((F.col("tag") == "th") & attr("id").isNotNull()),
    )
    out = sums_inside(out, rows, header_rows=n(F.col("row_ths") > 0), column_ths=n(F.col("first.is_th")), empty_rows=n(F.col("cells") == 0))
    out = first_inside(out, rows, ["cells", "row_ths"], "first_row")
    out = first_inside(out, cells.filter("merged"), ["ord"], "first_merged")
    out = first_inside(out, cells.filter("bad"), ["ord"], "first_bad")
    out = out.withColumns({"first_cells": F.coalesce("first_row.cells", F.lit(0)), "first_ths": F.coalesce("first_row.row_ths", F.lit(0)), "merged": F.col("first_merged").isNotNull()})
    layout = (F.coalesce(attr("role"), F.lit("")) == "presentation") | F.lower(F.array_join("classes", " ")).rlike("layout|grid|non-data")
    layout = layout | ((F.col("ths") == 0) & (F.col("captions") == 0) & ((F.col("rows") <= 1) | (F.col("first_cells") <= 1)))
    out = out.withColumns({"layout": layout, "complex": F.col("merged") | (F.col("header_rows") > 1) | (F.col("rows") > 10)})
    broken = ~F.col("layout") & F.col("first_bad").isNotNull() & (F.col("first_merged").isNull() | (F.col("first_bad.ord") < F.col("first_merged.ord")))
    return out.withColumn("stop", F.min(F.when(broken, F.col("ord"))).over(Window.partitionBy("doc_id")))


@rule("table_headers", 12, "table-missing-headers", "table-missing-scope", "table-missing-caption", reads="end_ord attrs classes tables")
def table_headers(docs: DataFrame, e: DataFrame) -> DataFrame:
    data = table_facts(e).filter("not layout and (stop is null or ord <= stop)")
    ths = e.filter("tag = 'th'").filter(attr("scope").isNull()).select("doc_id", "ord", F.explode("tables").alias("table"))
    scoped = ths.join(data.select("doc_id", F.col("ord").alias("table")), ["doc_id", "table"])
    return union(
        found(data.filter("ths = 0"), "table-missing-headers", "1.3.1", "major", emit=_long("ord") * 10_000),
        found(scoped, "table-missing-scope", "1.3.1", "minor", emit=_long("table") * 10_000 + F.col("ord")),
        found(data.filter("complex and captions = 0 and (stop is null or ord < stop)"), "table-missing-caption", "1.3.1", "minor", emit=_long("ord") * 10_000 + 9_999),
    )


@rule("table_structure", 13, "table-missing-thead", "table-missing-tbody", "table-missing-headers-id", "table-irregular-headers", reads="end_ord attrs classes")
def table_structure(docs: DataFrame, e: DataFrame) -> DataFrame:
    data = table_facts(e).filter("not layout and (stop is null or ord <= stop)").withColumn("whole", F.expr("stop is null or ord < stop"))
    parts = (
        ("first_ths > 0 and theads = 0 and rows > 0", "table-missing-thead", "minor"),
        ("tbodies = 0 and rows > 1", "table-missing-tbody", "minor"),
        ("whole and complex and with_headers = 0 and with_id = 0", "table-missing-headers-id", "major"),
        ("whole and rows >= 2 and empty_rows = 0 and first_ths > 0 and first_ths < first_cells", "table-irregular-headers", "major"),
        ("whole and rows >= 2 and empty_rows = 0 and column_ths > 0 and column_ths < rows", "table-irregular-headers", "major"),
    )
    return union(*[found(data.filter(where), kind, "1.3.1", severity, emit=_long("ord") * 10 + i) for i, (where, kind, severity) in enumerate(parts)])


def contrasts(e: DataFrame) -> DataFrame:
    """Text elements with their colours, ratio and the ratio they need. The text colour's pattern is
    not anchored, so it also matches within background-color where that comes first."""
    style = F.coalesce(attr("style"), F.lit(""))
    text = F.regexp_extract(style, rf"color:\s*{colour.COLOUR}", 1)
    rows = e.filter(F.col("tag").isin(*TEXT_TAGS) & (F.col("text_length") > 0)).withColumns(
        {
            "text_color": F.when(text == "", "#000000").otherwise(colour.normalised(text)),
            "background_color": F.coalesce(colour.normalised(F.col("bg_style")), F.lit("#FFFFFF")),
            "is_large": colour.is_large(F.col("tag"), style),
        }
    )
    # the colours are bound once: written out, their patterns would be there for every channel
    pair = F.array(F.struct(F.col("text_color").alias("a"), F.col("background_color").alias("b")))
    ratio = F.element_at(F.transform(pair, lambda p: colour.contrast(p["a"], p["b"])), 1)
    return rows.withColumns({"ratio": ratio, "needed": F.when(F.col("is_large"), 3.0).otherwise(4.5)})


@rule("color_contrast", 14, "insufficient-color-contrast", "potential-color-contrast-issue", reads="attrs bg_style text_length")
def color_contrast(docs: DataFrame, e: DataFrame) -> DataFrame:
    rows = contrasts(e)
    fine = colour.valid(F.col("text_color")) & colour.valid(F.col("background_color"))
    # a colour without three channels ends this check for its page: what comes after it is lost
    stop = rows.filter(~fine).groupBy("doc_id").agg(F.min("ord").alias("stop"))
    low = rows.filter(fine & (F.col("ratio") < F.col("needed"))).join(stop, "doc_id", "left").filter("stop is null or ord < stop")
    return found(low, "insufficient-color-contrast", "1.4.3", "major")


def controls(e: DataFrame) -> DataFrame:
    kind = F.lower(F.coalesce(attr("type"), F.lit("")))
    return e.filter(F.col("tag").isin("select", "textarea") | ((F.col("tag") == "input") & ~kind.isin(*SKIPPED_INPUTS)))


def _first_by(e: DataFrame, name: str, key: str, value: str = "text") -> DataFrame:
    """The first element for each value of an attribute, and of that element a value."""
    return e.filter(attr(key).isNotNull()).groupBy("doc_id", attr(key).alias(name)).agg(F.min_by(value, "ord").alias(f"label_{value}"))


@rule("form_label", 15, "form-control-missing-name", "form-control-missing-label", "form-label-empty", reads="attrs text text_length in_label")
def form_label(docs: DataFrame, e: DataFrame) -> DataFrame:
    c = controls(e)
    for_label = _first_by(e.filter("tag = 'label'"), "id", "for")
    by_for = c.withColumn("id", attr("id")).join(for_label, ["doc_id", "id"], "left_semi").select("doc_id", "ord")
    named = _first_by(e, "id", "id", "text_length").filter("label_text_length > 0")
    by_aria = c.select("doc_id", "ord", F.explode(F.split(F.trim(attr("aria-labelledby")), r"\s+")).alias("id")).join(named, ["doc_id", "id"], "left_semi").select("doc_id", "ord")
    own = F.col("in_label").isNotNull() | F.coalesce(F.trim(attr("aria-label")) != "", F.lit(False)) | F.coalesce(F.trim(attr("title")) != "", F.lit(False))
    bare = c.filter(~own).join(by_for.unionByName(by_aria).distinct(), ["doc_id", "ord"], "left_anti")
    family = F.when(F.col("tag") == "input", 0).when(F.col("tag") == "select", 1).otherwise(2)
    return union(
        found(c.filter(attr("name").isNull()), "form-control-missing-name", "1.3.1", "major", emit=family * 10_000_000 + _long("ord") * 2),
        found(bare, "form-control-missing-label", "1.3.1", "critical", emit=family * 10_000_000 + _long("ord") * 2 + 1),
        found(e.filter("tag = 'label' and text = ''"), "form-label-empty", "3.3.2", "major", emit=_long("ord") + 30_000_000),
    )


@rule("form_required", 16, "form-required-field-missing-aria", "form-required-field-not-indicated", reads="attrs text in_label")
def form_required(docs: DataFrame, e: DataFrame) -> DataFrame:
    needed = controls(e).filter(attr("required").isNotNull() | (attr("aria-required") == "true")).withColumn("id", attr("id"))
    for_label = _first_by(e.filter("tag = 'label'"), "id", "for")
    around = e.filter("tag = 'label'").select("doc_id", F.col("ord").alias("in_label"), F.col("text").alias("around_text"))
    rows = needed.join(for_label, ["doc_id", "id"], "left").join(around, ["doc_id", "in_label"], "left")
    told = F.lit(False)
    for text in ("label_text", "around_text"):
        told = told | F.coalesce(F.lower(text).rlike(r"\*|required"), F.lit(False))
    return union(
        found(rows.filter(attr("aria-required").isNull()), "form-required-field-missing-aria", "3.3.2", "minor", emit=F.col("ord") * 2),
        found(rows.filter(~told), "form-required-field-not-indicated", "3.3.2", "major", emit=F.col("ord") * 2 + 1),
    )


@rule("form_fieldset", 17, "form-fieldset-missing-legend", "form-related-controls-no-fieldset", reads="end_ord attrs text forms in_fieldset near")
def form_fieldset(docs: DataFrame, e: DataFrame) -> DataFrame:
    sets = e.filter("tag = 'fieldset'").select("doc_id", "ord", "end_ord")
    legends = e.filter("tag = 'legend'").select("doc_id", "ord", "text")
    bare = first_inside(sets, legends, ["text"], "legend").filter("legend is null or trim(legend.text) = ''")
    boxes = e.filter("tag = 'input'").withColumns({"kind": attr("type"), "name": attr("name"), "form": F.explode("forms")})
    radios = boxes.filter("kind = 'radio' and name is not null").groupBy("doc_id", "form", "name").agg(F.count("*").alias("n"), F.bool_or("in_fieldset").alias("inside"), F.min("ord").alias("ord")).filter("n > 1 and not inside")
    in_form = Window.partitionBy("doc_id", "form").orderBy("ord")
    checks = boxes.filter("kind = 'checkbox'").withColumn("all", F.count("*").over(Window.partitionBy("doc_id", "form"))).filter("all > 2")
    apart = ~F.coalesce(F.arrays_overlap("near", F.lag("near").over(in_form)), F.lit(False))
    runs = checks.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(in_form))
    islands = runs.groupBy("doc_id", "form", "run").agg(F.count("*").alias("n"), F.bool_or("in_fieldset").alias("inside"), F.min("ord").alias("ord")).filter("n > 1 and not inside")
    return union(
        found(bare, "form-fieldset-missing-legend", "1.3.1", "major"),
        found(radios, "form-related-controls-no-fieldset", "1.3.1", "major", emit=_long("form") * 100_000 + F.col("ord")),
        found(islands, "form-related-controls-no-fieldset", "1.3.1", "minor", emit=_long("form") * 100_000 + F.col("ord") + 50_000),
    )


def audit(docs: DataFrame, e: DataFrame, checks: list[str] | None = None) -> DataFrame:
    """Findings of the named rules (all: None). docs has doc_id, e the elements; e is read by every
    rule, so callers keep it (persist or write it) where parsing is dear."""
    chosen = [r for r in REGISTRY.values() if checks is None or r.name in checks]
    return union(*[r.run(docs, e).withColumn("check_no", F.lit(r.number)).select(*FINDING) for r in chosen])
