"""Extracted layout: reading order, neighbours, captions, and bounding-box matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.sources.tables import written

# The layout extractor's result, for from_json.
LAYOUT = (
    "struct<pages:array<struct<id:string,page_index:int,representation:struct<html:string>>>,"
    "elements:array<struct<id:string,type:string,sub_type:string,page_indices:array<int>,reading_order:int,"
    "bounding_box:struct<top:double,left:double>,representation:struct<html:string>,crop_images:array<string>>>>"
)


def parse_layout(texts: DataFrame, column: str = "value") -> DataFrame:
    """doc_id and the elements of each layout result, one row each."""
    parsed = texts.select("doc_id", F.from_json(column, LAYOUT).alias("r"))
    return parsed.select("doc_id", F.posexplode("r.elements").alias("list_no", "x")).select("doc_id", "list_no", "x.*")


def layout_pages(texts: DataFrame, column: str = "value") -> DataFrame:
    """doc_id and the pages of each layout result: list_no, id, page_index and html."""
    parsed = texts.select("doc_id", F.from_json(column, LAYOUT).alias("r"))
    return parsed.select("doc_id", F.posexplode("r.pages").alias("list_no", "x")).select("doc_id", "list_no", "x.id", "x.page_index", F.col("x.representation.html").alias("html"))


def reading_order(elements: DataFrame) -> DataFrame:
    """elements (doc_id, id, page_indices, top, left) numbered by first page, top and left; what lacks counts as 0."""
    page = F.coalesce(F.array_min("page_indices"), F.lit(0))
    order = Window.partitionBy("doc_id").orderBy(page, F.coalesce("top", F.lit(0.0)), F.coalesce("left", F.lit(0.0)), "id")
    return elements.withColumn("order_no", F.row_number().over(order))


def on_pages(elements: DataFrame) -> DataFrame:
    """One row per element and page it stands on."""
    return elements.withColumn("page", F.explode("page_indices"))


def page_status(elements: DataFrame) -> DataFrame:
    """Per page of (doc_id, page, issues, remediated): elements, those with findings, remediated, and left."""
    return elements.groupBy("doc_id", "page").agg(
        F.count("*").alias("elements"), F.count_if(F.expr("issues > 0")).alias("with_issues"), F.count_if("remediated").alias("remediated"), F.count_if((F.col("issues") > 0) & ~F.col("remediated")).alias("remaining")
    )


def neighbours(elements: DataFrame, reach: int = 2) -> DataFrame:
    """The ids of the elements up to reach places before and after on the page, in order."""
    page = Window.partitionBy("doc_id", "page").orderBy("reading_order", "id")
    return elements.withColumns({"before": F.collect_list("id").over(page.rowsBetween(-reach, -1)), "after": F.collect_list("id").over(page.rowsBetween(1, reach))})


def positions(elements: DataFrame) -> DataFrame:
    """Per element in order: its number, findings before it, findings from it on, and the next and
    previous element with findings."""
    order = Window.partitionBy("doc_id").orderBy("order_no")
    before = F.coalesce(F.sum("issues").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    has = F.when(F.col("issues") > 0, F.col("id"))
    return elements.withColumns(
        {
            "index": F.row_number().over(order) - 1,
            "issues_before": before,
            "remaining": F.sum("issues").over(Window.partitionBy("doc_id")) - before,
            "previous_issue": F.last(has, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)),
            "next_issue": F.first(has, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)),
        }
    )


def captions(elements: DataFrame) -> DataFrame:
    """For each FIGURE the first TEXT, in list order, of those on its page that are later in the
    reading order and have "Figure" in them."""
    is_text = (F.col("type") == "TEXT") & F.col("text").contains("Figure")
    figures = elements.filter("type = 'FIGURE'")
    texts = elements.filter(is_text).select("doc_id", "page", F.col("list_no").alias("t_list"), F.col("reading_order").alias("t_order"), F.col("text").alias("t"))
    first = figures.select("doc_id", "page", "id", "reading_order").join(texts, ["doc_id", "page"]).filter("t_order > reading_order").groupBy("doc_id", "page", "id").agg(F.min_by("t", "t_list").alias("caption"))
    return figures.join(first, ["doc_id", "page", "id"], "left")


def issue_elements(issues: DataFrame, elements: DataFrame) -> DataFrame:
    """doc_id, issue_id, element_id, way: the layout element of issues (doc_id, issue_id, page, path,
    context, type) among elements (doc_id, page, id, list_no, html). Issue ids are of a document.

    By the place among the page's images that the path tells (0), else by the image source or alt
    text of the context inside an element's markup (1), else the page's only element (2), else, for
    long alt texts, an element with the context in it (3), the first image with alt text (4), or the
    first image (5). What a page says by itself, its only element and its first images, is one row per
    page; markup meets only the issues of its page that no place has settled.
    """
    key = ["doc_id", "issue_id"]
    page = Window.partitionBy("doc_id", "page").orderBy("list_no")
    is_image = F.col("html").startswith("<img")
    images = elements.filter(is_image).select("doc_id", "page", "id", F.row_number().over(page).alias("nth"))
    context = F.coalesce("context", F.lit(""))
    src, alt = (F.regexp_extract(context, rf"{k}=[\"'](.*?)[\"']", 1) for k in ("src", "alt"))
    nth = F.regexp_extract(F.coalesce("path", F.lit("")), r":nth-of-type\((\d+)\)$", 1).try_cast("int")
    wanted = issues.select(*key, "page", nth.alias("nth"), src.alias("src"), alt.alias("alt"), context.alias("told"), (F.col("type") == "long-alt-text").alias("long"))
    placed = wanted.join(images, ["doc_id", "page", "nth"], "left").withColumnRenamed("id", "by_place")
    open_ = placed.filter("by_place is null and (src <> '' or alt <> '' or (long and told <> ''))")
    both = open_.select(*key, "page", "src", "alt", "told", "long").join(elements.select("doc_id", "page", "id", "list_no", "html"), ["doc_id", "page"])
    named = ((F.col("src") != "") & F.col("html").contains(F.col("src"))) | ((F.col("alt") != "") & F.col("html").contains(F.col("alt")))
    way = F.when(named, 1).when(F.col("long") & (F.col("told") != "") & F.col("html").contains(F.col("told")), 3)
    by_text = both.withColumn("way", way).filter("way is not null").groupBy(*key).agg(F.min_by(F.struct("id", "way"), F.struct("way", "list_no")).alias("text"))
    first = [F.min_by(F.when(where, F.col("id")), F.when(where, F.col("list_no"))).alias(n) for n, where in (("with_alt", is_image & F.col("html").contains("alt=")), ("image", is_image))]
    pages = elements.groupBy("doc_id", "page").agg(F.when(F.count("*") == 1, F.first("id")).alias("only"), *first)
    rows = placed.join(by_text, key, "left").join(pages, ["doc_id", "page"], "left")
    told = [(F.col("by_place"), 0), (F.when(F.col("text.way") == 1, F.col("text.id")), 1), (F.col("only"), 2), (F.col("text.id"), 3), (F.when(F.col("long"), F.col("with_alt")), 4), (F.when(F.col("long"), F.col("image")), 5)]
    found = F.coalesce(*[F.when(c.isNotNull(), F.struct(c.alias("id"), F.lit(w).alias("way"))) for c, w in told])
    return rows.select(*key, found["id"].alias("element_id"), found["way"].alias("way"))


def table_of_contents(elements: DataFrame) -> DataFrame:
    """(doc_id, level, title, page) of headings among API elements (doc_id, page, path, text); pages from 1."""
    return elements.filter(F.col("path").rlike("H[1-4]") & (F.col("text") != "")).select("doc_id", F.lit(1).alias("level"), F.col("text").alias("title"), (F.col("page") + 1).alias("page"))


TOLERANCE = 7


def box_candidates(images: DataFrame, boxes: DataFrame, tolerance: int = TOLERANCE) -> DataFrame:
    """Pairs whose x, top, width and height each differ by at most tolerance when rounded half-even.

    Boxes are joined by cells of the width of the tolerance in x and top, so the range join is an
    equi join on (file, cell) with 3 x 3 cells for each image, then the exact test.
    """
    size = float(2 * tolerance)
    rounded = {c: F.bround(c, 0) for c in ("x", "top", "width", "height")}
    a = images.withColumns({f"a_{c}": v for c, v in rounded.items()}).drop(*rounded)
    b = boxes.withColumns({f"b_{c}": v for c, v in rounded.items()}).drop(*rounded)
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = a.withColumn("cx", F.explode(F.transform(steps, lambda s: F.floor(F.col("a_x") / size) + s))).withColumn("cy", F.explode(F.transform(steps, lambda s: F.floor(F.col("a_top") / size) + s)))
    b = b.withColumns({"cx": F.floor(F.col("b_x") / size), "cy": F.floor(F.col("b_top") / size)})
    near = F.lit(True)
    for c in rounded:
        near = near & (F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= tolerance)
    return a.join(b, ["file", "cx", "cy"]).filter(near).select("file", "image_id", "image_no", "box_id", "box_no")


def one_to_one(candidates: DataFrame) -> DataFrame:
    """Greedy by image, then box order within each file: the first free box wins.

    In rounds: a pair that comes first among those of its image and of its box is one that the greedy
    order takes, whatever else is there; it goes with all pairs of its image and box, and the next
    round looks at what is left. So a file of any size is many groups, an image's or a box's pairs
    each, and what remains falls fast; a chain of boxes, each near the next, takes a round per box.
    Pairs are distinct, numbers (image_no, box_no) are unique in a file."""
    left = written(candidates.select("file", "image_id", "image_no", "box_id", "box_no").distinct(), "pairs")
    taken = None
    while not left.isEmpty():
        order = F.struct("image_no", "box_no", "image_id", "box_id")
        first = [F.min(order).over(Window.partitionBy("file", c)).alias(f"{c}_first") for c in ("image_id", "box_id")]
        won = written(left.select("*", order.alias("own"), *first).filter("own = image_id_first and own = box_id_first").select("file", "image_id", "box_id"), "pairs-won")
        rest = left.join(won.select("file", "image_id"), ["file", "image_id"], "left_anti").join(won.select("file", "box_id"), ["file", "box_id"], "left_anti")
        taken = won if taken is None else taken.unionByName(won)
        left = written(rest.select(*left.columns), "pairs")
    return taken if taken is not None else left.select("file", "image_id", "box_id")
