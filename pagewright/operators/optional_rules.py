"""Optional rule sets, which no audit runs by itself: a stricter one for pages, one for images.

Like the rules they are functions from the documents and the element table to findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .rules import REGISTRY, _landmark, _long, attr, found, headings_of, skip_link, union
from .structure import first_inside, innermost, nearest, sums_inside, with_text

# Link texts that say nothing, in the stricter set.
STRICT_LINKS = ("click here", "click", "here", "this link", "more", "read more", "details", "learn more", "link", "this", "go", "go to")
# Alt texts that say nothing, in this case; marks of decorative and of complex images.
PLAIN_ALT = r"^image\s*\d*$|^photo\s*\d*$|^picture\s*\d*$|^graphic\s*\d*$|^IMAGE$|^ICON$|^FIGURE$|^DIAGRAM$"
NAMED_ALTS = ("ICON", "DIAGRAM", "FIGURE", "IMAGE")
DECORATIVE_NAMES = ("separator", "divider", "spacer", "bullet")
COMPLEX_NAMES = ("figure", "diagram", "chart", "graph")
LONG_ALT = 150
SMALL, LARGE = 20, 300


def strict_headings(docs: DataFrame, e: DataFrame) -> DataFrame:
    """Headings of a level from 2 on whose page has none of the level above."""
    h = headings_of(e)
    above = h.select("doc_id", (F.col("level") + 1).alias("level")).distinct()
    return found(h.filter("level > 1").join(above, ["doc_id", "level"], "left_anti"), "improper-heading-structure", "1.3.1", "major")


def strict_document(docs: DataFrame, e: DataFrame) -> DataFrame:
    """Language and title: the first html element without lang, a title that is absent or blank."""
    first = e.filter("tag = 'html'").groupBy("doc_id").agg(F.min("ord").alias("ord"), F.min_by(F.struct(attr("lang").alias("lang")), "ord").alias("s"))
    title = e.filter("tag = 'title'").groupBy("doc_id").agg(F.min_by(F.struct("string"), "ord").alias("t"))
    untitled = docs.select("doc_id").join(title, "doc_id", "left").filter(F.trim(F.coalesce("t.string", F.lit(""))) == "").withColumn("ord", F.lit(None).cast("int"))
    return union(found(first.filter("s.lang is null"), "missing-document-language", "3.1.1", "critical"), found(untitled, "missing-page-title", "2.4.2", "major"))


def strict_landmarks(docs: DataFrame, e: DataFrame) -> DataFrame:
    """Main landmark and skip link, where they are missing."""
    return union(_landmark(docs, e, "main", "main", "main", "major", 0), skip_link(docs, e)).filter("status = 'needs_remediation'")


def strict_tables(docs: DataFrame, e: DataFrame) -> DataFrame:
    """Headers, scopes and a caption of every table; cells' headers where there are many."""
    parts = e.filter(F.col("tag").isin("th", "td", "tr", "caption")).select("doc_id", "ord", "tag", "attrs")

    def n(tag: str) -> Column:
        return (F.col("tag") == tag).cast("int")

    tables = sums_inside(
        e.filter("tag = 'table'").select("doc_id", "ord", "end_ord"), parts, ths=n("th"), trs=n("tr"), tds=n("td"), captions=n("caption"), told=((F.col("tag") == "td") & attr("headers").isNotNull()).cast("int")
    )
    scopes = e.filter("tag = 'th'").filter(attr("scope").isNull()).select("doc_id", "ord", F.explode("tables").alias("table"))
    return union(
        found(tables.filter("ths = 0"), "missing-table-headers", "1.3.1", "critical", emit=_long("ord") * 10_000),
        found(scopes, "missing-header-scope", "1.3.1", "major", emit=_long("table") * 10_000 + F.col("ord")),
        found(tables.filter("captions = 0"), "missing-table-caption", "1.3.1", "minor", emit=_long("ord") * 10_000 + 9_998),
        found(tables.filter("trs > 2 and ths > 2 and tds > 0 and told = 0"), "complex-table-no-ids", "1.3.1", "critical", emit=_long("ord") * 10_000 + 9_999),
    )


def strict_forms(docs: DataFrame, e: DataFrame) -> DataFrame:
    """Labels by for or by attribute (one around the control does not count), and aria-required."""
    skipped = (F.col("tag") == "input") & F.coalesce(attr("type").isin("hidden", "button", "submit", "reset"), F.lit(False))
    c = e.filter(F.col("tag").isin("input", "select", "textarea") & ~skipped).withColumn("id", attr("id"))
    labels = e.filter("tag = 'label'").select("doc_id", attr("for").alias("id")).distinct()
    by_for = c.filter("id <> ''").join(labels, ["doc_id", "id"], "left_semi").select("doc_id", "ord")
    own = F.lit(False)
    for name in ("aria-label", "aria-labelledby", "title"):
        own = own | F.coalesce(F.trim(attr(name)) != "", F.lit(False))
    bare = c.filter(~own).join(by_for, ["doc_id", "ord"], "left_anti")
    return union(
        found(bare, "missing-form-label", "3.3.2", "critical", emit=_long("ord") * 2),
        found(c.filter(attr("required").isNotNull() & attr("aria-required").isNull()), "missing-aria-required", "3.3.2", "minor", emit=_long("ord") * 2 + 1),
    )


def strict_links(docs: DataFrame, e: DataFrame) -> DataFrame:
    """Links without content, with a text that says nothing, or with an image alone that has no alt text."""
    links = first_inside(e.filter("tag = 'a'").select("doc_id", "ord", "end_ord", "text"), e.filter("tag = 'img'").select("doc_id", "ord", attr("alt").alias("alt")), ["alt"], "img")
    text = F.trim("text")
    blank_image = F.col("img").isNotNull() & (F.trim(F.coalesce("img.alt", F.lit(""))) == "")
    kind = F.when((text == "") & F.col("img").isNull(), "empty-link").when((text == "") & blank_image, "link-image-missing-alt").when(F.lower(text).isin(*STRICT_LINKS), "generic-link-text")
    return found(links, kind, "2.4.4", F.when(kind == "generic-link-text", "major").otherwise("critical"))


def _dimensions() -> tuple[Column, Column]:
    return attr("width").try_cast("int"), attr("height").try_cast("int")


def is_decorative() -> Column:
    """By role, by size, or by the name of its source."""
    width, height = _dimensions()
    by_role = (attr("role") == "presentation") | (attr("aria-hidden") == "true")
    by_name = attr("src").rlike("|".join(DECORATIVE_NAMES))
    return F.coalesce(by_role, F.lit(False)) | F.coalesce((width < SMALL) & (height < SMALL), F.lit(False)) | F.coalesce(by_name, F.lit(False))


def images_with_context(e: DataFrame, id_attr: str = "data-element-id") -> DataFrame:
    """Images with figure (the nearest around them), captioned, and complex: such as need a
    description of their own. id_attr names the attribute with the extractor's element id."""
    figures = first_inside(e.filter("tag = 'figure'").select("doc_id", "ord", "end_ord"), e.filter("tag = 'figcaption'").select("doc_id", "ord"), ["ord"], "caption")
    images = innermost(e.filter("tag = 'img'"), figures, ["ord", "caption"], "around")
    images = images.withColumns({"figure": F.col("around.ord"), "captioned": F.when(F.col("around.caption").isNotNull(), True)}).drop("around")
    # of paragraphs, only those after an image are read
    images = nearest(images, e.filter("tag = 'p'"), ["ord", "text_in", "text_at", "text_length"], "p", after=True)
    after = with_text(images.filter("p is not null").select("doc_id", "p.*").distinct(), e, "next_p").select("doc_id", F.col("ord").alias("next_ord"), "next_p")
    images = images.withColumn("next_ord", F.col("p.ord")).drop("p").join(after, ["doc_id", "next_ord"], "left").drop("next_ord")
    width, height = _dimensions()
    told = (F.coalesce(attr(id_attr), F.lit("")) != "") & F.coalesce(F.col("next_p").rlike(r"Figure\s+\d+"), F.lit(False))
    named = F.coalesce(F.lower(attr("src")).rlike("|".join(COMPLEX_NAMES)), F.lit(False))
    big = F.coalesce((width > LARGE) & (height > LARGE), F.lit(False))
    return images.withColumn("complex", told | named | big)


def image_texts(docs: DataFrame, e: DataFrame, made_attr: str = "data-generated-alt", id_attr: str = "data-element-id") -> DataFrame:
    """Alt texts and figures, in more detail than the audit. made_attr marks alt texts that an
    extractor wrote."""
    images = images_with_context(e, id_attr)
    alt = F.trim(attr("alt"))
    made, plain = F.coalesce(attr(made_attr) == "true", F.lit(False)), alt.rlike(PLAIN_ALT)
    first = F.when(attr("alt").isNull(), "missing-alt-text").when(made, "alt-text-present").when((alt == "") & ~is_decorative(), "empty-alt-text")
    first = first.when(alt.isin(*NAMED_ALTS), F.concat(F.lit("generic-alt-text-"), F.lower(alt))).when(plain, "generic-alt-text").when(F.length(alt) > LONG_ALT, "long-alt-text").otherwise("alt-text-present")
    severity = F.when(first == "missing-alt-text", "critical").when(first == "long-alt-text", "minor").otherwise("major")
    present = first == "alt-text-present"

    def judged(where: Column, status: str, kind: Column | str, severity: Column | str) -> DataFrame:
        return found(images.filter(where), kind, "1.1.1", severity, emit=_long("ord") * 3).withColumn("status", F.lit(status))

    texts = (judged(~present, "needs_remediation", first, severity), judged(present & made, "auto_remediated", first, "info"), judged(present & ~made, "remediated", first, "info"))
    again = found(images.filter(made & plain), "generic-alt-text", "1.1.1", "major", emit=_long("ord") * 3 + 1)
    bare = found(images.filter("figure is null and complex"), "improper-figure-structure", "1.1.1", "major", emit=_long("ord") * 3 + 2)
    uncaptioned = found(images.filter("figure is not null and captioned is null"), "missing-figcaption", "1.1.1", "major", F.col("figure"), _long("ord") * 3 + 2)
    return union(*texts, again, bare, uncaptioned)


#: name: (number, rule). Numbers go on from the audit's.
OPTIONAL = {
    f.__name__: (max(r.number for r in REGISTRY.values()) + k, f)
    for k, f in enumerate((strict_headings, strict_document, strict_landmarks, strict_tables, strict_forms, strict_links, image_texts), 1)
}


def optional_audit(docs: DataFrame, e: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Findings of the named optional rules (all: None), as the audit gives them."""
    return union(*[f(docs, e).withColumn("check_no", F.lit(number)) for name, (number, f) in OPTIONAL.items() if names is None or name in names])


def image_context(e: DataFrame) -> DataFrame:
    """For each image of (doc_id, ord) what stands around it, as lines: caption, the texts of the
    elements before and after it in its parent, the nearest heading before it, the paragraph around
    it, its alt text and its aria attributes."""
    parent = F.coalesce("parent_ord", F.lit(-1)).alias("parent_ord")  # the page itself
    images = e.filter("tag = 'img'").select("doc_id", "ord", parent, "attrs")
    captions = e.filter("tag = 'figcaption'").select("doc_id", "ord", "text")
    figures = first_inside(e.filter("tag = 'figure'").select("doc_id", "ord", "end_ord"), captions, ["text"], "caption")
    rows = innermost(images, figures, ["caption"], "figure").withColumn("caption", F.col("figure.caption.text")).drop("figure")
    rows = nearest(rows, headings_of(e), ["text"], "head").withColumn("heading", F.col("head.text")).drop("head")
    place = ["text_in", "text_at", "text_length"]
    rows = innermost(rows, e.filter("tag = 'p'"), ["ord", *place], "p")
    paragraphs = with_text(rows.filter("p is not null").select("doc_id", "p.*").distinct(), e, "paragraph").select("doc_id", F.col("ord").alias("p_ord"), "paragraph")
    rows = rows.withColumn("p_ord", F.col("p.ord")).drop("p").join(paragraphs, ["doc_id", "p_ord"], "left")
    # what stands beside is one text per parent, and a place in it for each image
    parents = rows.select("doc_id", "parent_ord").distinct()
    beside = with_text(e.filter("tag <> 'img'").select("doc_id", parent, "ord", *place).join(parents, ["doc_id", "parent_ord"]), e, "t")
    whole = beside.groupBy("doc_id", "parent_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "t"))), lambda x: x["t"]), "").alias("whole"))
    both = rows.select("doc_id", "parent_ord", "ord", F.lit(0).alias("size"), F.lit(True).alias("image")).unionByName(beside.select("doc_id", "parent_ord", "ord", F.length("t").alias("size"), F.lit(False).alias("image")))
    so_far = Window.partitionBy("doc_id", "parent_ord").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = both.withColumn("at", F.sum("size").over(so_far).cast("int")).filter("image").select("doc_id", "ord", "at")
    rows = rows.join(places, ["doc_id", "ord"], "left").join(whole, ["doc_id", "parent_ord"], "left")
    rows = rows.withColumns({"before": F.substring("whole", F.lit(1), F.least("at", F.lit(200))), "after": F.substring("whole", F.col("at") + 1, F.lit(200))})

    def line(name: str, value: Column) -> Column:
        return F.when(F.trim(F.coalesce(value, F.lit(""))) != "", F.concat(F.lit(f"{name}: "), F.trim(value)))

    aria = F.transform(F.filter(F.map_entries("attrs"), lambda x: x["key"].startswith("aria-")), lambda x: F.concat(F.lit("ARIA "), x["key"], F.lit(": "), x["value"]))
    told = F.array(
        line("Caption", F.col("caption")), line("Text before image", F.col("before")), line("Text after image", F.col("after")), line("Nearest heading", F.col("heading")),
        line("Paragraph text", F.substring("paragraph", 1, 200)), line("Current alt text", F.col("attrs")["alt"]),
    )
    lines = F.concat(F.array_compact(told), aria)
    return rows.select("doc_id", "ord", F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise("No surrounding context found").alias("context"))
