"""Further queries: optional rules, image files, layout matches, text rules, histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.functions import colour, text
from pagewright.operators import findings as fs
from pagewright.operators import edits, images, jobs, layout, optional_rules, remediate
from pagewright.sources.html_tree import elements
from pagewright.sources.tables import written

from .catalog import LAY, RULE_COLUMNS, _layout_rows, query, table

# ---- optional rules over snippets --------------------------------------------------------------

OPTIONAL_FAMILIES: dict[str, list[tuple[str, list[str]]]] = {
    "strict_headings": [
        ("<h1>a</h1><h2>b</h2>", []),
        ("<h1>a</h1><h3>b</h3><h3>c</h3>", ["improper-heading-structure"] * 2),
        ("<h3>b</h3><h2>c</h2>", ["improper-heading-structure"]),
        ("<p>x</p>", []),
    ],
    "strict_document": [
        ("<html lang=''><title>t</title></html>", []),
        ("<html><title> </title></html>", ["missing-document-language", "missing-page-title"]),
        ("<p>x</p>", ["missing-page-title"]),
    ],
    "strict_landmarks": [
        ("<main>x</main><a href='#m'>Skip</a>", []),
        ("<div role='main'>x</div>", ["missing-skip-link"]),
        ("<a href='/m'>Skip</a>", ["missing-main-landmark", "missing-skip-link"]),
    ],
    "strict_tables": [
        ("<table><caption>c</caption><tr><th scope='col'>a</th></tr></table>", []),
        ("<table><tr><th>a</th><th scope='row'>b</th></tr></table>", ["missing-header-scope", "missing-table-caption"]),
        ("<table><tr><td>a</td></tr></table>", ["missing-table-caption", "missing-table-headers"]),
        ("<table><caption>c</caption><tr><th scope='col'>a</th><th scope='col'>a</th><th scope='col'>a</th></tr><tr><td>b</td></tr><tr><td>c</td></tr></table>", ["complex-table-no-ids"]),
        ("<table><caption>c</caption><tr><th scope='col'>a</th><th scope='col'>a</th><th scope='col'>a</th></tr><tr><td headers='h'>b</td></tr><tr><td>c</td></tr></table>", []),
    ],
    "strict_forms": [
        ("<label>n<input id='a'></label>", ["missing-form-label"]),
        ("<label for='a'>n</label><input id='a' required>", ["missing-aria-required"]),
        ("<input aria-labelledby='none'><input type='hidden'><select title='t'></select>", []),
        ("<textarea aria-label=' '></textarea><input type='Submit'>", ["missing-form-label"] * 2),
    ],
    "strict_links": [
        ("<a href='/a'> </a>", ["empty-link"]),
        ("<a href='/a'><img alt=' '></a><a href='/b'><img></a>", ["link-image-missing-alt"] * 2),
        ("<a href='/a'><img alt='x'></a>", []),
        ("<a href='/a'>Go to</a><a href='/b'>see more</a>", ["generic-link-text"]),
    ],
    "image_texts": [
        ("<img src='a.png'>", ["missing-alt-text"]),
        ("<img src='a.png' alt='x' data-generated-alt='true'>", ["alt-text-present"]),
        ("<img src='a.png' alt='photo 3' data-generated-alt='true'>", ["alt-text-present", "generic-alt-text"]),
        ("<img src='a.png' alt=''>", ["empty-alt-text"]),
        ("<img src='spacer.gif' alt=''><img alt='' width='5' height='9'><img alt='' role='presentation'>", ["alt-text-present"] * 3),
        ("<img src='a.png' alt='FIGURE'><img src='a.png' alt='Figure'>", ["alt-text-present", "generic-alt-text-figure"]),
        (f"<img src='a.png' alt='{'long ' * 40}'>", ["long-alt-text"]),
        ("<img src='Chart.png' alt='x'>", ["alt-text-present", "improper-figure-structure"]),
        ("<img src='a.png' alt='x' width='301' height='301'>", ["alt-text-present", "improper-figure-structure"]),
        ("<img src='a.png' alt='x' data-element-id='e'><p>See Figure 12</p>", ["alt-text-present", "improper-figure-structure"]),
        ("<figure><img src='chart.png' alt='x'></figure>", ["alt-text-present", "missing-figcaption"]),
        ("<figure><img src='chart.png' alt='x'><figcaption>c</figcaption></figure>", ["alt-text-present"]),
    ],
}


def _snippets(spark: SparkSession, d: str, cases: list) -> tuple[DataFrame, DataFrame]:
    """Document ids and elements, snippet page_id % n being laid under each page's id."""
    laid = F.array(*[F.lit(s) for s, _ in cases])
    pages = table(spark, d, "pages").select("page_id", F.element_at(laid, (F.col("page_id") % len(cases) + 1).cast("int")).alias("html"))
    return pages.select(F.col("page_id").alias("doc_id")), written(elements(pages, columns=RULE_COLUMNS), "elements")


def _optional(name: str) -> None:
    cases = OPTIONAL_FAMILIES[name]
    values = ", ".join(f"({i}, '{t}')" for i, (_, types) in enumerate(cases) for t in types)

    @query(f"optional_{name}", f"SELECT page_id AS doc_id, v.type FROM pages JOIN (VALUES {values}) v(i, type) ON page_id % {len(cases)} = v.i")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return optional_rules.optional_audit(*_snippets(spark, d, cases), [name]).select("doc_id", "type")


for _name in OPTIONAL_FAMILIES:
    _optional(_name)

CONTEXTS = [
    ("<h2>Top</h2><p>before <img alt='a b' aria-label='z'></p>", "Nearest heading: Top\nParagraph text: before\nCurrent alt text: a b\nARIA aria-label: z"),
    ("<figure><b>left</b><img><i>right</i><figcaption>Cap</figcaption></figure>", "Caption: Cap\nText before image: left\nText after image: rightCap"),
    ("<div><img></div>", "No surrounding context found"),
]


@query("image_contexts", "SELECT page_id AS doc_id, v.context FROM pages JOIN (VALUES " + ", ".join(f"({i}, '{c}')" for i, (_, c) in enumerate(CONTEXTS)).replace("\n", "' || chr(10) || '") + f") v(i, context) ON page_id % {len(CONTEXTS)} = v.i")
def image_contexts(spark: SparkSession, d: str) -> DataFrame:
    return optional_rules.image_context(_snippets(spark, d, CONTEXTS)[1]).select("doc_id", "context")


# ---- image files -------------------------------------------------------------------------------

FILES = "f AS (SELECT 'd' || p_partkey % 3 || '/img' || p_partkey % 90 || CASE p_size % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '.PNG' ELSE '.txt' END AS path, p_partkey AS file_no FROM part)"
IMAGES = rf"{FILES}, k AS (SELECT regexp_extract(path, '([^/]*)$', 1) AS name, arg_max(path, file_no) AS path FROM f WHERE regexp_matches(path, '\.(png|jpg)$') GROUP BY 1)"


def _files(spark: SparkSession, d: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size") % 4
    end = F.when(size == 0, ".png").when(size == 1, ".jpg").when(size == 2, ".PNG").otherwise(".txt")
    return table(spark, d, "part").select(F.concat(F.lit("d"), (key % 3).cast("string"), F.lit("/img"), (key % 90).cast("string"), end).alias("path"), key.alias("file_no"))


def _refs(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    html = F.concat(F.lit("<p>x</p><img alt='y' src='old/img"), (key % 120).cast("string"), F.lit('.png\'><IMG src="a.gif"><img src="img'), (key % 7).cast("string"), F.lit('.jpg">'))
    return table(spark, d, "part").select(key.alias("doc_id"), html.alias("html"))


@query("image_inventory", f"WITH {IMAGES} SELECT name, path FROM k")
def image_inventory(spark: SparkSession, d: str) -> DataFrame:
    return images.inventory(_files(spark, d))


@query("missing_images", f"""WITH {IMAGES}, r AS (SELECT DISTINCT p_partkey AS doc_id, unnest(['img' || p_partkey % 120 || '.png', 'img' || p_partkey % 7 || '.jpg']) AS name FROM part)
SELECT doc_id, r.name, coalesce(k.path, (SELECT arg_min(path, name) FROM k)) AS path FROM r LEFT JOIN k ON k.name = r.name WHERE r.name NOT IN (SELECT 'img' || s_suppkey || '.png' FROM supplier)""")
def missing_images(spark: SparkSession, d: str) -> DataFrame:
    there = table(spark, d, "supplier").select(F.concat(F.lit("img"), F.col("s_suppkey").cast("string"), F.lit(".png")).alias("name"))
    return images.missing(images.references(_refs(spark, d)), there, images.inventory(_files(spark, d)), fill=True)


@query("resolved_images", r"""WITH f AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'out/assets/' WHEN 1 THEN 'out/page/' WHEN 2 THEN 'out/page/extracted_html/' ELSE 'out/page/deep/er/' END || 'n' || p_partkey || '.png' AS path FROM part),
w AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN 'n' || p_partkey || '.png' WHEN 1 THEN 'n' || p_partkey || '.webp' ELSE 'none' || p_partkey || '.png' END AS name, p_partkey FROM part)
SELECT name, CASE WHEN name LIKE 'none%' THEN NULL WHEN name LIKE '%.png' THEN (SELECT path FROM f WHERE path LIKE '%/' || name)
  ELSE (SELECT min(path) FROM f WHERE path LIKE 'out/page/%' AND starts_with(regexp_extract(path, '([^/]*)$', 1), replace(name, '.webp', ''))) END AS path FROM w""")
def resolved_images(spark: SparkSession, d: str) -> DataFrame:
    key, no = F.col("p_partkey"), F.col("p_partkey").cast("string")
    place = F.when(key % 4 == 0, "out/assets/").when(key % 4 == 1, "out/page/").when(key % 4 == 2, "out/page/extracted_html/").otherwise("out/page/deep/er/")
    part = table(spark, d, "part")
    there = part.select(F.concat(place, F.lit("n"), no, F.lit(".png")).alias("path"))
    wanted = part.select(F.when(key % 3 == 0, F.concat(F.lit("n"), no, F.lit(".png"))).when(key % 3 == 1, F.concat(F.lit("n"), no, F.lit(".webp"))).otherwise(F.concat(F.lit("none"), no, F.lit(".png"))).alias("name"))
    bases = spark.createDataFrame([("out/page/", 0)], "base string, base_no int")
    return images.resolved(wanted, bases, there)


@query("image_folders", "SELECT 'w/j' || s_suppkey || '/page.html' AS base, CASE s_suppkey % 4 WHEN 0 THEN 'w/j' || s_suppkey || '/images' WHEN 1 THEN 'w/j' || s_suppkey || '/assets' WHEN 2 THEN 'w/assets' ELSE 'w/assets' END AS folder FROM supplier")
def image_folders(spark: SparkSession, d: str) -> DataFrame:
    key, home = F.col("s_suppkey"), F.concat(F.lit("w/j"), F.col("s_suppkey").cast("string"))
    suppliers = table(spark, d, "supplier")
    there = suppliers.select(F.when(key % 4 == 0, F.concat(home, F.lit("/images"))).when(key % 4 == 1, F.concat(home, F.lit("/assets"))).otherwise("w/assets").alias("folder"))
    return images.image_folder(suppliers.select(F.concat(home, F.lit("/page.html")).alias("base")), there)


@query("rewritten_images", """SELECT p_partkey AS doc_id, '<p>x</p><img alt=''y'' src=''' || CASE WHEN p_partkey % 120 < 60 THEN 'new/' || p_partkey % 120 ELSE 'old/img' || p_partkey % 120 || '.png' END || '''><IMG src="a.gif"><img src="img' || p_partkey % 7 || '.jpg">' AS html FROM part""")
def rewritten_images(spark: SparkSession, d: str) -> DataFrame:
    mapping = spark.range(60).select(F.concat(F.lit("img"), F.col("id").cast("string"), F.lit(".png")).alias("name"), F.concat(F.lit("new/"), F.col("id").cast("string")).alias("path"))
    return images.rewritten(_refs(spark, d), mapping)


@query("figure_sources", """SELECT l_orderkey AS doc_id, CAST(l_linenumber AS VARCHAR) AS element_id, 'c' || min(l_partkey) || '.png' AS expected FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING min(l_partkey) % 3 <> 2 AND min(l_suppkey) % 2 = 0""")
def figure_sources(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    no, key = F.col("p").cast("string"), F.col("l_linenumber").cast("string")
    kind = F.when(F.col("p") % 3 == 0, "IMAGE").when(F.col("p") % 3 == 1, "DIAGRAM").otherwise("CHART")
    figures = lines.select(F.col("l_orderkey").alias("doc_id"), key.alias("id"), F.lit("FIGURE").alias("type"), kind.alias("sub_type"), F.array(F.concat(F.lit("crops/c"), no, F.lit(".jpeg"))).alias("crop_images"))
    shown = lines.select(F.col("l_orderkey").alias("doc_id"), key.alias("element_id"), F.concat(F.when(F.col("s") % 2 == 0, "other/x").otherwise("other/c"), no, F.lit(".png")).alias("src"))
    return images.figure_sources(figures, shown)


@query("copied_pages", "SELECT CAST(sum(l_linenumber) AS BIGINT) AS copied FROM lineitem")
def copied_pages(spark: SparkSession, d: str) -> DataFrame:
    return images.copied_pages(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("long").alias("copied")))


# ---- text rules --------------------------------------------------------------------------------


@query("common_prefixes", """WITH g AS (SELECT o_custkey, min(lower(n)) AS a, max(lower(n)) AS z FROM (SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'Contact_' || o_orderkey ELSE o_orderpriority || '_' || o_orderkey END AS n FROM orders) GROUP BY 1),
p AS (SELECT o_custkey, a, coalesce(list_max(list_filter(range(1, least(length(a), length(z)) + 1), lambda i: a[1:i] = z[1:i])), 0) AS n FROM g)
SELECT o_custkey, CASE WHEN n > 3 THEN a[1:n] ELSE '' END AS prefix FROM p""")
def common_prefixes(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("Contact_"), F.col("o_orderkey").cast("string"))).otherwise(F.concat("o_orderpriority", F.lit("_"), F.col("o_orderkey").cast("string")))
    low = F.lower(name)
    groups = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(low).alias("a"), F.max(low).alias("z"))
    return groups.select("o_custkey", text.common_prefix(F.col("a"), F.col("z")).alias("prefix"))


@query("object_keys", "SELECT o_orderkey, lower(o_orderstatus) || '/doc' || o_orderkey || '.v1.json' AS key FROM orders")
def object_keys(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("in/a/doc"), F.col("o_orderkey").cast("string"), F.lit(".v1.pdf"))
    return table(spark, d, "orders").select("o_orderkey", text.object_key(F.lower("o_orderstatus"), name, F.lit(".json")).alias("key"))


@query("natural_order", "SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_suppkey) AS place FROM lineitem")
def natural_order(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("part"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"), F.lit(".png"))
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(text.natural_key(name)))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", place.cast("long").alias("place"))


@query("selectors", """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'img#p' || p_partkey WHEN 1 THEN 'img.a.b' WHEN 2 THEN 'img[data-n=''' || p_partkey || ''']' WHEN 3 THEN 'img[src$=''' || p_partkey || '.png'']' ELSE 'p' || CASE WHEN p_size % 4 > 1 THEN ':nth-of-type(' || p_size % 4 || ')' ELSE '' END END AS selector FROM part""")
def selectors(spark: SparkSession, d: str) -> DataFrame:
    no, way = F.col("p_partkey").cast("string"), F.col("p_partkey") % 5
    source = F.concat(F.lit("x/"), no, F.lit(".png"))
    attrs = F.when(way == 0, F.create_map(F.lit("id"), F.concat(F.lit("p"), no), F.lit("class"), F.lit("a"))).when(way == 1, F.create_map(F.lit("class"), F.lit(" a  b "), F.lit("data-n"), no))
    attrs = attrs.when(way == 2, F.create_map(F.lit("src"), source, F.lit("data-n"), no)).when(way == 3, F.create_map(F.lit("src"), source)).otherwise(F.create_map(F.lit("alt"), no))
    return table(spark, d, "part").select("p_partkey", text.selector(F.when(way == 4, "p").otherwise("img"), attrs, F.col("p_size") % 4).alias("selector"))


@query("payload_fields", "SELECT o_orderkey, o_orderpriority AS priority, CASE WHEN o_orderkey % 2 = 0 THEN 'last ' || o_orderstatus END AS status FROM orders")
def payload_fields(spark: SparkSession, d: str) -> DataFrame:
    payload = F.concat(F.lit("Priority: none\n\n  Priority: "), F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("\nfirst line\nlast "), F.col("o_orderstatus"), F.lit("\nUrl: a: b"))).otherwise(F.lit("")))
    rows = jobs.payload_status(table(spark, d, "orders").select("o_orderkey", payload.alias("payload")))
    return rows.select("o_orderkey", F.col("fields")["Priority"].alias("priority"), F.col("fields")["Status"].alias("status"))


@query("encoding_repairs", "SELECT doc_id, regexp_matches(t, '[□●αβ]') OR (length(t) <= 40 AND regexp_matches(t, ':[A-Za-z]:')) AS repair FROM (SELECT doc_id, regexp_replace(CASE doc_id % 4 WHEN 0 THEN text || '●' WHEN 1 THEN ' x:a:' || doc_id WHEN 2 THEN ' x:a:' || doc_id || repeat('y', 40) ELSE text END, '^\\s+|\\s+$', '', 'g') AS t FROM documents) WHERE t IS NOT NULL")
def encoding_repairs(spark: SparkSession, d: str) -> DataFrame:
    no, way = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    t = F.when(way == 0, F.concat("text", F.lit("●"))).when(way == 1, F.concat(F.lit(" x:a:"), no)).when(way == 2, F.concat(F.lit(" x:a:"), no, F.lit("y" * 40))).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", t.alias("t")).filter("t is not null").select("doc_id", text.needs_encoding_repair(F.col("t")).alias("repair"))


@query("spoken_steps", "SELECT p_partkey, 'Step ' || p_size || '. increased open bracket ' || lower(p_brand) || ' close bracket chloride, Cl minus, and open parenthesis bicarbonate, H C O 3 minus, close parenthesis' AS spoken FROM part")
def spoken_steps(spark: SparkSession, d: str) -> DataFrame:
    step = F.concat(F.col("p_size").cast("string"), F.lit(" )  ![ "), F.lower("p_brand"), F.lit(" ] Cl - and ( HCO 3- )"))
    return table(spark, d, "part").select("p_partkey", text.spoken_step(step).alias("spoken"))


@query("image_tokens", "SELECT conv_id, turn, CAST(CASE WHEN length(text) > 0 THEN greatest(1, length(text) // 4) ELSE 0 END + 1000 * (turn % 3) AS INT) AS tokens FROM conversations WHERE text IS NOT NULL")
def image_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").filter("text is not null").select("conv_id", "turn", text.token_estimate(F.col("text"), (F.col("turn") % 3).cast("int")).cast("int").alias("tokens"))


@query("dark_colours", "SELECT p_partkey, (0.299 * r + 0.587 * g + 0.114 * b) / 255 < 0.5 AS dark FROM (SELECT p_partkey, (c // 65536)::DOUBLE AS r, ((c // 256) % 256)::DOUBLE AS g, (c % 256)::DOUBLE AS b FROM (SELECT p_partkey, CAST((p_partkey * 2654435761) % 16777216 AS BIGINT) AS c FROM part))")
def dark_colours(spark: SparkSession, d: str) -> DataFrame:
    hexed = F.concat(F.lit("#"), F.lpad(F.hex((F.col("p_partkey") * 2654435761) % 16777216), 6, "0"))
    return table(spark, d, "part").select("p_partkey", colour.is_dark(hexed).alias("dark"))


@query("header_hints", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'row' ELSE 'col' END AS scope FROM part")
def header_hints(spark: SparkSession, d: str) -> DataFrame:
    attrs = F.when(F.col("p_size") % 3 == 0, F.create_map(F.lit("class"), F.lit("big row-header"))).otherwise(F.create_map(F.lit("role"), F.lit("columnheader")))
    return table(spark, d, "part").select("p_partkey", text.scope_of(F.lit(False), F.lit(2), F.lit(1), attrs).alias("scope"))


# ---- layout, jobs, histories -------------------------------------------------------------------


@query("neighbours_3", f"""WITH {LAY} SELECT doc_id, id, coalesce(string_agg(CAST(id AS VARCHAR), ',') OVER (PARTITION BY doc_id, page ORDER BY id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(CAST(id AS VARCHAR), ',') OVER (PARTITION BY doc_id, page ORDER BY id ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), '') AS after FROM y""")
def neighbours_3(spark: SparkSession, d: str) -> DataFrame:
    rows = layout.neighbours(_layout_rows(spark, d), 3)
    return rows.select("doc_id", "id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("before", "after")])


@query("elements_on_pages", f"WITH {LAY} SELECT doc_id, page, count(*) AS n FROM (SELECT doc_id, unnest([page, page + 1]) AS page FROM y) GROUP BY ALL")
def elements_on_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = _layout_rows(spark, d).withColumn("page_indices", F.array("page", F.col("page") + 1)).drop("page")
    return layout.on_pages(rows).groupBy("doc_id", "page").agg(F.count("*").alias("n"))


@query("parsed_layout", "SELECT o_orderkey AS doc_id, 'e' || (n + 1) AS id, CAST(n AS INT) AS list_no, CAST(o_orderkey % 3 + n AS INT) AS reading_order FROM orders, range(2) t(n)")
def parsed_layout(spark: SparkSession, d: str) -> DataFrame:
    def element(n: int) -> F.Column:
        return F.struct(F.lit(f"e{n + 1}").alias("id"), F.lit("TEXT").alias("type"), (F.col("o_orderkey") % 3 + n).cast("int").alias("reading_order"))

    made = F.to_json(F.struct(F.array(element(0), element(1)).alias("elements"), F.array(F.struct(F.lit("p").alias("id"))).alias("pages")))
    return layout.parse_layout(table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), made.alias("value"))).select("doc_id", "id", "list_no", "reading_order")


@query("issue_elements", """WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL), c AS (SELECT o, count(*) AS k, min(n) AS f FROM l GROUP BY o)
SELECT l.o AS doc_id, 'issue-' || l.n AS issue_id, CASE p % 4 WHEN 0 THEN l.n WHEN 1 THEN l.n WHEN 2 THEN CASE WHEN k = 1 THEN l.n END ELSE CASE WHEN k = 1 THEN l.n ELSE f END END AS element_id,
  CAST(CASE p % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN CASE WHEN k = 1 THEN 2 END ELSE CASE WHEN k = 1 THEN 2 ELSE 4 END END AS INT) AS way FROM l JOIN c ON c.o = l.o""")
def issue_elements(spark: SparkSession, d: str) -> DataFrame:
    """Orders as documents of a page, lines as images and as issues, whose ids begin anew in each: told
    by place, by source, by nothing, as long alt texts."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    n, way = F.col("l_linenumber"), F.col("p") % 4
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(n)).cast("string")
    there = lines.select(
        F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), n.alias("id"), n.alias("list_no"), F.concat(F.lit("<img src='s"), n.cast("string"), F.lit(".png' alt='words'>")).alias("html")
    )
    issues = lines.select(
        F.concat(F.lit("issue-"), n.cast("string")).alias("issue_id"), F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"),
        F.when(way == 0, F.concat(F.lit("div > img:nth-of-type("), place, F.lit(")"))).alias("path"),
        F.when(way == 1, F.concat(F.lit('<img src="s'), n.cast("string"), F.lit('.png">'))).when(way == 3, "no such text").alias("context"), F.when(way == 3, "long-alt-text").otherwise("empty-alt-text").alias("type"),
    )
    return layout.issue_elements(issues, there)


@query("dominant_languages", "SELECT source AS doc_id, arg_min(lang, (-n, lang)) AS lang FROM (SELECT source, lang, sum(n_chars) AS n FROM documents WHERE lang IS NOT NULL GROUP BY ALL) GROUP BY source")
def dominant_languages(spark: SparkSession, d: str) -> DataFrame:
    scores = table(spark, d, "documents").filter("lang is not null").groupBy(F.col("source").alias("doc_id"), "lang").agg(F.sum("n_chars").alias("score"))
    return jobs.dominant_language(scores)


@query("processed_totals", "SELECT count(DISTINCT o_custkey) AS documents, count(*) AS pages, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS documents_processed, count(*) FILTER (o_orderstatus = 'F') AS pages_processed FROM orders")
def processed_totals(spark: SparkSession, d: str) -> DataFrame:
    return jobs.processed_totals(table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("FAILED").alias("status")))


@query("layout_tables", "SELECT p_partkey AS table_id, NOT (p_size % 2 = 0 AND length(trim(p_name || p_name || p_name)) > 40) AND ((p_size % 4 = 1 AND p_partkey % 6 = 1) OR (p_size % 4 <= 2 AND p_partkey % 6 <= 4)) AS is_layout FROM part")
def layout_tables(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    tables = table(spark, d, "part").select(F.col("p_partkey").alias("table_id"), (size % 4).alias("rows"), (F.col("p_partkey") % 6).alias("cells"), F.when(size % 2 == 0, F.concat("p_name", "p_name", "p_name")).alias("summary"))
    return jobs.layout_tables(tables).select("table_id", "is_layout")


@query("unsuppressed_figures", "SELECT DISTINCT l_orderkey AS doc_id, CAST(l_linenumber AS BIGINT) AS figure FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R')")
def unsuppressed_figures(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("long").alias("figure"), "l_returnflag")
    done = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("figure"), F.col("figure").cast("string"), F.lit(": added /ActualText"))).otherwise("table0: none")
    return jobs.unsuppressed(lines.select("doc_id", "figure").distinct(), lines.select("doc_id", done.alias("action")))


HISTORY = "h AS (SELECT user_id AS doc_id, event_type AS element_id, event_id AS change_no, event_id % 5 = 0 AS undone FROM events), l AS (SELECT doc_id, element_id, arg_max(undone, change_no) AS undone, max(change_no) AS n FROM h GROUP BY ALL)"


def _history(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("element_id"), F.col("event_id").alias("change_no"), (F.col("event_id") % 5 == 0).alias("undone"), F.concat(F.lit("<p>"), F.col("event_id").cast("string")).alias("before"))


@query("fix_status", f"WITH {HISTORY}, e AS (SELECT DISTINCT user_id AS doc_id, t.element_id FROM events, (SELECT DISTINCT event_type AS element_id FROM events) t) SELECT e.doc_id, count(*) AS total, count(*) FILTER (NOT l.undone) AS fixed, count(*) - count(*) FILTER (NOT l.undone) AS remaining FROM e LEFT JOIN l ON l.doc_id = e.doc_id AND l.element_id = e.element_id GROUP BY e.doc_id")
def fix_status(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    kinds = events.agg(F.collect_set("event_type").alias("kinds"))
    parts = events.select(F.col("user_id").alias("doc_id")).distinct().join(F.broadcast(kinds)).select("doc_id", F.explode("kinds").alias("element_id"))
    return jobs.fix_status(parts, _history(spark, d))


# each element's changes in turn, a list of those that stand being pushed to and popped from
STACKS = """x AS (SELECT *, row_number() OVER (PARTITION BY doc_id, element_id ORDER BY change_no) AS k FROM h),
r(doc_id, element_id, k, stack) AS (SELECT DISTINCT doc_id, element_id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM x UNION ALL
  SELECT x.doc_id, x.element_id, x.k, CASE WHEN NOT x.undone THEN list_append(stack, x.change_no) WHEN len(stack) > 0 THEN stack[:-2] ELSE stack END FROM r JOIN x ON x.doc_id = r.doc_id AND x.element_id = r.element_id AND x.k = r.k + 1),
z AS (SELECT doc_id, element_id, arg_max(stack, k) AS stack FROM r GROUP BY ALL)"""


def _undone(times: int) -> str:
    """SQL of what as many undos as times append."""
    return f"""WITH RECURSIVE {HISTORY}, {STACKS}
SELECT z.doc_id, z.element_id, l.n + i AS change_no, true AS undone, '<p>' || stack[len(stack) - i + 1] AS html FROM z JOIN l ON l.doc_id = z.doc_id AND l.element_id = z.element_id, range(1, {times + 1}) t(i) WHERE i <= len(stack)"""


@query("undone_fixes", _undone(1))
def undone_fixes(spark: SparkSession, d: str) -> DataFrame:
    return jobs.undo(_history(spark, d))


@query("undone_thrice", _undone(3))
def undone_thrice(spark: SparkSession, d: str) -> DataFrame:
    return jobs.undo(_history(spark, d), 3)


@query("standing_fixes", f"WITH RECURSIVE {HISTORY}, {STACKS} SELECT doc_id, element_id, unnest(stack) AS change_no, CAST(len(stack) - generate_subscripts(stack, 1) + 1 AS INT) AS place FROM z")
def standing_fixes(spark: SparkSession, d: str) -> DataFrame:
    return jobs.standing(_history(spark, d)).select("doc_id", "element_id", "change_no", "place")


@query("failed_reports", "SELECT conv_id AS doc_id, CASE WHEN conv_id % 5 = 0 THEN 0 ELSE count(*) END AS total_issues, CASE WHEN conv_id % 5 <> 0 THEN count(*) FILTER (role = 'user') END AS critical, CASE WHEN conv_id % 5 = 0 THEN 'unreadable' END AS error FROM conversations GROUP BY conv_id")
def failed_reports(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").withColumnRenamed("conv_id", "doc_id")
    good = turns.filter("doc_id % 5 <> 0").groupBy("doc_id").agg(F.count("*").alias("total_issues"), F.count_if(F.col("role") == "user").alias("critical"))
    bad = turns.filter("doc_id % 5 = 0").select("doc_id").distinct().withColumn("error", F.lit("unreadable"))
    return fs.failed_report(good, bad)


@query("types_by", "SELECT p_partkey AS type FROM part WHERE p_size % 3 = 1 AND p_brand LIKE '%1' AND p_partkey % 2 = 0")
def types_by(spark: SparkSession, d: str) -> DataFrame:
    kinds = table(spark, d, "part").select(F.col("p_partkey").alias("type"), F.concat(F.lit("1."), (F.col("p_size") % 3).cast("string")).alias("wcag"), F.substring("p_brand", -1, 1).alias("severity"), F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("p"), F.lit("a"))).otherwise(F.array(F.lit("p"))).alias("elements"))
    return fs.types_by(kinds, "1.1", "1", "a").select("type")


@query("open_findings", "SELECT o_orderkey FROM orders WHERE o_orderkey % 4 NOT IN (1, 2)")
def open_findings(spark: SparkSession, d: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, ("compliant", "remediated", "auto_remediated", "needs_remediation"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return fs.without_remediated(table(spark, d, "orders").select("o_orderkey", status.alias("status"))).select("o_orderkey")

# ---- edits at a place, over pages made of orders -----------------------------------------------


def _order_pages(spark: SparkSession, d: str, *parts: Column | str) -> DataFrame:
    """page_id, html: a page for each order, of texts and columns in turn."""
    html = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


def _order_columns() -> tuple[Column, Column, Column]:
    return F.col("o_orderkey"), F.col("o_orderstatus"), F.concat(F.lit("c"), F.col("o_custkey"))


@query("selector_edits", """SELECT o_orderkey AS doc_id, '<div id="o' || o_orderkey || '" lang="en"><b>' || o_orderstatus || '</b> x<i>' || 'c' || o_custkey || '</i></div>' AS html, '1,2,3' AS applied, '4,5' AS failed FROM orders""")
def selector_edits(spark: SparkSession, d: str) -> DataFrame:
    key, status, clerk = _order_columns()
    pages = _order_pages(spark, d, '<div id="o', key, '"><p class="s t">', status, '</p><p class="s">', clerk, "</p></div>")
    orders = table(spark, d, "orders")
    none = F.lit(None).cast("string")
    todo = [
        ("attribute", F.concat(F.lit("#o"), key), F.lit("lang"), F.lit("en")),
        ("content", F.lit("div > p.s:first-child"), none, F.concat(F.lit("<b>"), status, F.lit("</b> x"))),
        ("replace", F.lit("table, b ~ p[class^='s']"), none, F.concat(F.lit("<i>"), clerk, F.lit("</i><u>left out</u>"))),
        ("replace", F.lit("p"), none, F.lit("<p>nothing to replace</p>")),
        ("attribute", F.lit("div["), F.lit("lang"), F.lit("de")),
    ]
    rows = [F.struct(F.lit(k + 1).alias("edit_no"), F.lit(a).alias("action"), s.alias("selector"), n.alias("name"), v.alias("value")) for k, (a, s, n, v) in enumerate(todo)]
    work = orders.select(key.alias("doc_id"), F.explode(F.array(*rows)).alias("e")).select("doc_id", "e.*")
    out = edits.edited(pages, work)
    return out.select("doc_id", "html", F.array_join("applied", ",").alias("applied"), F.array_join("failed", ",").alias("failed"))


@query("prepared_tables", f"""SELECT o_orderkey AS doc_id, '<table style="; {edits.TABLE_BORDER}">' || CASE WHEN o_orderstatus = 'O'
  THEN '<thead><tr style="; {edits.CELL_BORDER}"><th scope="col" style="; {edits.CELL_BORDER}"><b>' || o_orderkey || '</b></th></tr></thead><tbody>'
  ELSE '<tr style="; {edits.CELL_BORDER}"><td style="; {edits.CELL_BORDER}"><i>' || o_orderkey || '</i></td></tr>' END
  || '<tr style="; {edits.CELL_BORDER}"><td style="border:0">' || 'c' || o_custkey || '</td></tr>' || CASE WHEN o_orderstatus = 'O' THEN '</tbody>' ELSE '' END || '</table>' AS html FROM orders""")
def prepared_tables(spark: SparkSession, d: str) -> DataFrame:
    key, status, clerk = _order_columns()
    tag = F.when(status == "O", "b").otherwise("i")
    pages = _order_pages(spark, d, "<table><tr><td><", tag, ">", key, "</", tag, '></td></tr><tr><td style="border:0">', clerk, "</td></tr></table>")
    return edits.of_pages(pages, edits.prepared_tables)


@query("grouped_controls", """SELECT o_orderkey AS doc_id, CASE o_orderstatus
  WHEN 'O' THEN '<form><fieldset><legend>A' || o_orderkey || '</legend><input name="a' || o_orderkey || '_x"><input name="a' || o_orderkey || '_y"></fieldset></form>'
  WHEN 'F' THEN '<form><div><fieldset><legend>Road</legend><label for="a">Road 1</label><input id="a"><label for="b">Road</label><input id="b"></fieldset></div></form>'
  ELSE '<form><input name="a"><input name="b"></form>' END AS html FROM orders""")
def grouped_controls(spark: SparkSession, d: str) -> DataFrame:
    key, status, _ = _order_columns()
    name = F.concat(F.lit("a"), key)
    named = F.concat(F.lit('<input name="'), name, F.lit('_x"><input name="'), name, F.lit('_y">'))
    inside = F.when(status == "O", named).when(status == "F", '<div><label for="a">Road 1</label><input id="a"><label for="b">Road</label><input id="b"></div>').otherwise('<input name="a"><input name="b">')
    pages = _order_pages(spark, d, "<form>", inside, "</form>")
    return edits.of_pages(pages, lambda source: remediate.fixed(source, ["form-related-controls-no-fieldset"])[0])


@query("located_tables", """SELECT o_orderkey AS doc_id, CAST(u.n AS INT) AS finding_no, CAST(CASE u.n WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN o_orderkey % 3 WHEN 4 THEN 1 WHEN 5 THEN 0 WHEN 6 THEN 0 WHEN 7 THEN NULL END AS INT) AS place
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS n) u""")
def located_tables(spark: SparkSession, d: str) -> DataFrame:
    key, _, clerk = _order_columns()
    pages = _order_pages(spark, d, "<table><tr><td>a</td></tr></table><table><tr><th>", clerk, '</th></tr></table><table id="t', key, '"><tr><td>', key, "</td></tr></table>")
    blank, none = F.lit(""), F.lit(None).cast("int")
    told = [
        ("", F.concat(F.lit("#t"), key), blank, blank, none),
        ("", F.lit("p"), F.lit("table"), clerk, none),
        ("", blank, F.lit("table"), blank, (key % 3).cast("int")),
        ("table-missing-scope", blank, blank, blank, none),
        ("table-missing-headers", F.lit("["), F.lit("<table><tr><td>other</td></tr></table>"), blank, none),
        ("table-else", blank, blank, blank, none),
        ("else", blank, F.lit("td"), blank, none),
    ]
    rows = [F.struct(F.lit(k + 1).alias("finding_no"), F.lit(t).alias("type"), s.alias("selector"), e.alias("element"), x.alias("text"), i.alias("index")) for k, (t, s, e, x, i) in enumerate(told)]
    findings = table(spark, d, "orders").select(key.alias("doc_id"), F.explode(F.array(*rows)).alias("f")).select("doc_id", "f.*")
    return edits.tables_of(pages, findings)
