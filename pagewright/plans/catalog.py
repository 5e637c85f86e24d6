"""Every query of the library by name, and the SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.functions import colour, text
from pagewright.operators import findings as fs
from pagewright.operators import jobs, layout, remediate, rules
from pagewright.operators.dims import severity_rank, wcag_rows
from pagewright.sources import files
from pagewright.sources.html_tree import COLUMNS, elements
from pagewright.sources.tables import written

from .golden import FAMILIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from . import further, more  # noqa: F401  register their queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: What all rules, optional ones too, read of the element table.
RULE_COLUMNS = [c for c in COLUMNS if c not in ("css_path", "snippet", "depth", "nth_of_type", "page_number", "text_digest")]


def parsed(spark: SparkSession, d: str, detailed: bool = False, checks: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Document ids and the element table, which is written once since every rule reads it; of its
    columns those that the checks read, or with detailed all."""
    pages = table(spark, d, "pages")
    return pages.select(F.col("page_id").alias("doc_id")), written(elements(pages, columns=None if detailed else rules.columns_of(checks)), "elements")


def audited(spark: SparkSession, d: str, *checks: str) -> DataFrame:
    docs, e = parsed(spark, d, checks=list(checks) or None)
    return rules.audit(docs, e, list(checks) or None)


# ---- audit rules on the pages ------------------------------------------------------------------

# The pages' markup is flat enough for patterns: no landmark, title or link is inside another or in a script.
HAS = "regexp_matches(html, '{}')"
LINKS = r"""l AS (SELECT page_id AS doc_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS no, href, trim(txt) AS txt FROM
  (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
          unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS txt,
          generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) AS i FROM pages))"""
GENERIC = ", ".join(f"'{t}'" for t in rules.GENERIC_LINKS)
LANDMARK_SQL = """SELECT page_id AS doc_id, CASE WHEN regexp_matches(html, '<nav[ >]') THEN 'compliant' ELSE 'missing' END || '-navigation-landmark' AS type FROM pages
UNION ALL SELECT page_id, CASE WHEN regexp_matches(html, '<header[ >]') THEN 'compliant' ELSE 'missing' END || '-header-landmark' FROM pages
UNION ALL SELECT page_id, CASE WHEN regexp_matches(html, '<footer[ >]') THEN 'compliant' ELSE 'missing' END || '-footer-landmark' FROM pages"""
MAIN_SQL = "SELECT page_id AS doc_id, CASE WHEN regexp_matches(html, '<main[ >]') THEN 'compliant' ELSE 'missing' END || '-main-landmark' AS type FROM pages"
SKIP_SQL = f"""WITH {LINKS}
SELECT p.page_id AS doc_id, CASE WHEN count(*) FILTER (no <= 5 AND href LIKE '#%' AND regexp_matches(lower(txt), 'skip|jump|content|main')) > 0
  THEN 'compliant-skip-link' ELSE 'missing-skip-link' END AS type FROM pages p LEFT JOIN l ON l.doc_id = p.page_id GROUP BY p.page_id"""
TITLE_SQL = r"""SELECT page_id AS doc_id, CASE WHEN NOT regexp_matches(html, '<title>') THEN 'missing-title'
  WHEN trim(t) = '' THEN 'empty-title' WHEN lower(trim(t)) IN ('untitled', 'document', 'page', 'new page', 'title') THEN 'generic-title' ELSE 'compliant-document-title' END AS type
FROM (SELECT page_id, html, regexp_extract(html, '<title>([^<]*)', 1) AS t FROM pages)"""
LANGUAGE_SQL = r"""SELECT page_id AS doc_id, CASE WHEN NOT regexp_matches(html, '<html[^>]* lang="') THEN 'missing-document-language'
  WHEN length(trim(regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1))) < 2 THEN 'invalid-document-language' ELSE 'compliant-document-language' END AS type
FROM pages WHERE regexp_matches(html, '<html[ >]')"""
HEADING_SQL = r"""WITH h AS (SELECT page_id AS doc_id, CAST(unnest(regexp_extract_all(html, '<h([1-6])>', 1)) AS INT) AS level FROM pages),
g AS (SELECT doc_id, level, level > lag(level) OVER (PARTITION BY doc_id ORDER BY level) + 1 AS gap FROM (SELECT DISTINCT doc_id, level FROM h)),
s AS (SELECT doc_id, min(level) AS least, count(*) FILTER (gap) AS gaps FROM g GROUP BY doc_id)
SELECT p.page_id AS doc_id, CASE WHEN least IS NULL THEN 'no-headings' WHEN least > 1 THEN 'no-h1' ELSE 'compliant-heading-hierarchy' END AS type
FROM pages p LEFT JOIN s ON s.doc_id = p.page_id WHERE least IS NULL OR least > 1 OR gaps = 0
UNION ALL SELECT doc_id, 'skipped-heading-level' FROM g WHERE gap"""
HEADING_TEXT_SQL = r"""WITH h AS (SELECT page_id AS doc_id, trim(unnest(regexp_extract_all(html, '<h[1-6]>([^<]*)</h[1-6]>', 1))) AS t FROM pages),
b AS (SELECT doc_id, CASE WHEN t = '' THEN 'empty-heading' WHEN lower(t) IN ('heading', 'title', 'subtitle', 'header') THEN 'generic-heading' END AS type FROM h)
SELECT doc_id, type FROM b WHERE type IS NOT NULL UNION ALL
SELECT DISTINCT doc_id, 'compliant-heading-content' FROM b WHERE doc_id NOT IN (SELECT doc_id FROM b WHERE type IS NOT NULL)"""
LINK_SQL = f"""WITH {LINKS}
SELECT doc_id, CASE WHEN txt = '' THEN 'empty-link-text' WHEN lower(txt) IN ({GENERIC}) THEN 'generic-link-text'
  WHEN regexp_matches(txt, '(?i)^https?://|^www\\.|\\.(com|org|net|edu|gov|io)(/|$)') THEN 'url-as-link-text' ELSE 'compliant-link-text' END AS type
FROM l WHERE NOT regexp_matches(href, '^#+$')
UNION ALL SELECT l.doc_id, 'duplicate-link-text-different-url' FROM l JOIN
  (SELECT doc_id, lower(txt) AS low FROM l WHERE txt <> '' AND NOT regexp_matches(href, '^#+$') GROUP BY ALL HAVING count(DISTINCT href) > 1) g
  ON g.doc_id = l.doc_id AND lower(l.txt) = g.low"""

for _name, _check, _sql in (
    ("audit_headings", "heading_hierarchy", HEADING_SQL),
    ("audit_heading_texts", "heading_content", HEADING_TEXT_SQL),
    ("audit_title", "document_title", TITLE_SQL),
    ("audit_language", "document_language", LANGUAGE_SQL),
    ("audit_main_landmark", "main_landmark", MAIN_SQL),
    ("audit_skip_link", "skip_link", SKIP_SQL),
    ("audit_landmarks", "landmarks", LANDMARK_SQL),
    ("audit_links", "link_text", LINK_SQL),
):
    query(_name, _sql)(lambda spark, d, c=_check: audited(spark, d, c).select("doc_id", "type"))

ALL_SQL = " UNION ALL ".join(f"(SELECT * FROM ({s}))" for s in (HEADING_SQL, HEADING_TEXT_SQL, TITLE_SQL, LANGUAGE_SQL, MAIN_SQL, SKIP_SQL, LANDMARK_SQL, LINK_SQL))
SEVERITY_SQL = """CASE WHEN type IN ('missing-document-language', 'compliant-document-language', 'empty-link-text') THEN 'critical'
  WHEN type IN ('compliant-link-text', 'compliant-image-link') THEN 'info'
  WHEN type IN ('generic-heading', 'compliant-heading-content', 'generic-title', 'url-as-link-text') OR regexp_matches(type, '-(navigation|header|footer)-landmark') THEN 'minor' ELSE 'major' END"""
F_SQL = f"WITH f AS (SELECT doc_id, type, {SEVERITY_SQL} AS severity, CASE WHEN type LIKE 'compliant-%' THEN 'compliant' ELSE 'needs_remediation' END AS status FROM ({ALL_SQL}))"


@query("audit_summary", f"{F_SQL} SELECT type, severity, status, count(*) AS n, count(DISTINCT doc_id) AS documents FROM f GROUP BY ALL")
def audit_summary(spark: SparkSession, d: str) -> DataFrame:
    return audited(spark, d).groupBy("type", "severity", "status").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("documents"))


@query("status_summary", f"""{F_SQL} SELECT count(*) AS total_issues, count(*) FILTER (status = 'needs_remediation') AS needs_remediation, count(*) FILTER (status = 'remediated') AS remediated,
  count(*) FILTER (status = 'auto_remediated') AS auto_remediated, count(*) FILTER (status = 'compliant') AS compliant FROM f""")
def status_summary(spark: SparkSession, d: str) -> DataFrame:
    return fs.status_summary(audited(spark, d))


@query("severity_counts", f"""{F_SQL} SELECT count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'major') AS major,
  count(*) FILTER (severity = 'minor') AS minor, count(*) FILTER (severity = 'info') AS info FROM f""")
def severity_counts(spark: SparkSession, d: str) -> DataFrame:
    return fs.severity_counts(audited(spark, d))


@query("issues_by_page", f"""{F_SQL} SELECT doc_id AS page_number, count(*) AS total, count(*) FILTER (status = 'needs_remediation') AS needs_remediation, count(*) FILTER (status = 'remediated') AS remediated,
  count(*) FILTER (status = 'auto_remediated') AS auto_remediated, count(*) FILTER (status = 'compliant') AS compliant FROM f GROUP BY doc_id""")
def issues_by_page(spark: SparkSession, d: str) -> DataFrame:
    return fs.by_page(audited(spark, d), F.col("doc_id"))


@query("issue_type_stats", f"{F_SQL} SELECT type, count(*) AS total, count(*) FILTER (status = 'compliant') AS compliant, count(*) FILTER (status <> 'compliant') AS needing_work FROM f GROUP BY type")
def issue_type_stats(spark: SparkSession, d: str) -> DataFrame:
    return fs.by_type(audited(spark, d))


@query("unified_counts", f"{F_SQL} SELECT type, severity, count(*) FILTER (status = 'compliant') AS compliant, CAST(0 AS BIGINT) AS remediated, count(*) FILTER (status <> 'compliant') AS non_compliant FROM f GROUP BY ALL")
def unified_counts(spark: SparkSession, d: str) -> DataFrame:
    return fs.unified_counts(audited(spark, d))


@query("severity_threshold", f"{F_SQL} SELECT type, count(*) AS n FROM f WHERE status = 'compliant' OR severity IN ('major', 'critical') GROUP BY type")
def severity_threshold(spark: SparkSession, d: str) -> DataFrame:
    return fs.over_threshold(audited(spark, d), "major").groupBy("type").agg(F.count("*").alias("n"))


WCAG_VALUES = ", ".join(f"('{c}', '{n}', '{level}')" for c, n, level in wcag_rows())
WCAG_OF = """CASE WHEN type LIKE '%title' OR type LIKE '%document-title' THEN '2.4.2' WHEN type LIKE '%document-language' THEN '3.1.1' WHEN type LIKE '%skip-link' THEN '2.4.1'
  WHEN type = 'duplicate-link-text-different-url' THEN '2.4.9' WHEN type LIKE '%link%' OR type LIKE '%-url' THEN '2.4.4'
  WHEN type IN ('empty-heading', 'generic-heading', 'compliant-heading-content') THEN '2.4.6' ELSE '1.3.1' END"""


@query("enriched_by_criterion", f"""{F_SQL}, w(criterion, name, level) AS (VALUES {WCAG_VALUES}), x AS (SELECT *, {WCAG_OF} AS wcag FROM f)
SELECT wcag, name AS criterion_name, level AS criterion_level, count(*) AS n FROM x JOIN w ON w.criterion = x.wcag GROUP BY ALL""")
def enriched_by_criterion(spark: SparkSession, d: str) -> DataFrame:
    docs, e = parsed(spark, d, detailed=True)
    return fs.enriched(rules.audit(docs, e), e, detailed=False).groupBy("wcag", "criterion_name", "criterion_level").agg(F.count("*").alias("n"))


@query("numbered_issues", f"{F_SQL} SELECT doc_id, count(*) AS n, 'issue-' || count(*) AS last_id FROM f GROUP BY doc_id")
def numbered_issues(spark: SparkSession, d: str) -> DataFrame:
    no = F.regexp_extract("issue_id", r"(\d+)", 1).cast("int")
    return fs.numbered(audited(spark, d)).groupBy("doc_id").agg(F.count("*").alias("n"), F.max_by("issue_id", no).alias("last_id"))


@query("scan_elements", r"""WITH t AS (SELECT regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?s)(<(?:script|style)>).*?</', '\1</', 'g') AS h FROM pages)
SELECT tag, count(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(h, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM t) GROUP BY tag""")
def scan_elements(spark: SparkSession, d: str) -> DataFrame:
    return elements(table(spark, d, "pages"), columns=["tag"]).groupBy("tag").agg(F.count("*").alias("n"))


def _golden(family: str) -> None:
    check, cases = FAMILIES[family]
    values = ", ".join(f"({i}, '{t}')" for i, (_, types) in enumerate(cases) for t in types)
    sql = f"SELECT page_id AS doc_id, v.type FROM pages JOIN (VALUES {values}) v(i, type) ON page_id % {len(cases)} = v.i"

    @query(f"golden_{family}", sql)
    def run(spark: SparkSession, d: str) -> DataFrame:
        snippets = F.array(*[F.lit(s) for s, _ in cases])
        pages = table(spark, d, "pages").select("page_id", F.element_at(snippets, (F.col("page_id") % len(cases) + 1).cast("int")).alias("html"))
        e = written(elements(pages, columns=RULE_COLUMNS), "elements")
        return rules.audit(pages.select(F.col("page_id").alias("doc_id")), e, [check]).select("doc_id", "type")


for _family in FAMILIES:
    _golden(_family)


# ---- scalar rules ------------------------------------------------------------------------------

ALT_CASES = [
    ("The diagram has parts. It shows four stages: 1", [], ["truncated_list_enumeration"]),
    ("A plot of the ratio 3: 5", [], ["truncated_colon_digit"]),
    ("Membrane pump Cl-/HCO3- Antiporter", ["/fb-region-inlineFormula"], ["inline_formula_caption_only"]),
    ("x equals y", ["inlineFormula"], []),
    ("Table showing the values", [], ["table_tagged_as_figure"]),
    ("Table showing the values", ["table-figure-reverted"], []),
    ("Columns labeled 'a' and 'b' with rows for each year. " + "Every cell gives a count of what was seen. " * 3, [], []),
    ("A red bridge over a river.", [], []),
    ("  ", [], []),
]


@query("alt_classifier", "SELECT doc_id, v.reason FROM documents JOIN (VALUES " + ", ".join(f"({i}, '{','.join(r)}')" for i, (_, _, r) in enumerate(ALT_CASES)) + f") v(i, reason) ON doc_id % {len(ALT_CASES)} = v.i")
def alt_classifier(spark: SparkSession, d: str) -> DataFrame:
    cases = F.array(*[F.struct(F.lit(a).alias("alt"), F.array(*map(F.lit, c)).cast("array<string>").alias("classes")) for a, c, _ in ALT_CASES])
    rows = table(spark, d, "documents").select("doc_id", F.element_at(cases, (F.col("doc_id") % len(ALT_CASES) + 1).cast("int")).alias("c"))
    return rows.select("doc_id", F.array_join(text.alt_reasons(F.col("c.alt"), F.col("c.classes")), ",").alias("reason"))


@query("token_estimate", "SELECT doc_id, CAST(CASE WHEN length(coalesce(text, '')) > 0 THEN greatest(1, length(text) // 4) ELSE 0 END AS INT) AS tokens FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.token_estimate(F.col("text")).cast("int").alias("tokens"))


@query("title_text", r"""WITH p AS (SELECT conv_id AS doc_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS page, text, count(*) OVER (PARTITION BY conv_id) AS pages FROM conversations),
t AS (SELECT doc_id, max(pages) AS pages, max(text) FILTER (page = 1) AS one, string_agg(text, chr(10) || chr(10) ORDER BY page) FILTER (page <= 3) AS three FROM p GROUP BY doc_id)
SELECT doc_id, md5(regexp_replace(CASE WHEN pages = 1 OR len(list_filter(regexp_split_to_array(one, '\s+'), lambda w: w <> '')) >= 50 THEN one ELSE three END, '^\s+|\s+$', '', 'g')) AS digest FROM t""")
def title_text(spark: SparkSession, d: str) -> DataFrame:
    no = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    pages = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), no.alias("page"), "text")
    return files.title_texts(pages).select("doc_id", F.md5("text").alias("digest"))


HEX = "printf('#%06X', CAST((p_partkey * 2654435761) % 16777216 AS BIGINT))"


@query("contrast_ratio", f"""WITH c AS (SELECT p_partkey, {HEX} AS a, printf('#%06X', CAST((p_partkey * 40503) % 16777216 AS BIGINT)) AS b FROM part),
v AS (SELECT p_partkey, [CAST(('0x' || substr(a, i, 2)) AS INT) / 255.0::DOUBLE FOR i IN [2, 4, 6]] AS x, [CAST(('0x' || substr(b, i, 2)) AS INT) / 255.0::DOUBLE FOR i IN [2, 4, 6]] AS y FROM c),
g AS (SELECT p_partkey, [CASE WHEN t <= 0.03928 THEN t / 12.92 ELSE pow((t + 0.055) / 1.055, 2.4) END FOR t IN x] AS x, [CASE WHEN t <= 0.03928 THEN t / 12.92 ELSE pow((t + 0.055) / 1.055, 2.4) END FOR t IN y] AS y FROM v),
l AS (SELECT p_partkey, x[1] * 0.2126 + x[2] * 0.7152 + x[3] * 0.0722 AS p, y[1] * 0.2126 + y[2] * 0.7152 + y[3] * 0.0722 AS q FROM g)
SELECT p_partkey, round((greatest(p, q) + 0.05) / (least(p, q) + 0.05), 4) AS ratio FROM l""")
def contrast_ratio(spark: SparkSession, d: str) -> DataFrame:
    def hexed(factor: int) -> F.Column:
        return F.concat(F.lit("#"), F.lpad(F.hex((F.col("p_partkey") * factor) % 16777216), 6, "0"))

    return table(spark, d, "part").select("p_partkey", F.round(colour.contrast(hexed(2654435761), hexed(40503)), 4).alias("ratio"))


@query("page_numbers", r"SELECT page_id, CAST(CASE WHEN page_id % 3 = 2 THEN NULL ELSE page_id END AS INT) AS page_number FROM pages")
def page_numbers(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("out/"), F.when(F.col("page_id") % 3 == 0, "page-").when(F.col("page_id") % 3 == 1, "Page_").otherwise("other"), F.col("page_id").cast("string"), F.lit(".html"))
    return table(spark, d, "pages").select("page_id", text.page_number(name).alias("page_number"))


@query("page_sort", "SELECT page_id, row_number() OVER (ORDER BY CASE WHEN page_id % 3 = 0 THEN 999 ELSE page_id END, 'out/' || CASE WHEN page_id % 3 = 0 THEN 'other' ELSE 'page-' END || page_id || '.html') AS place FROM pages")
def page_sort(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("out/"), F.when(F.col("page_id") % 3 == 0, "other").otherwise("page-"), F.col("page_id").cast("string"), F.lit(".html"))
    rows = table(spark, d, "pages").select("page_id", name.alias("file"), text.page_number(name).alias("page_number"))
    return files.placed(rows).select("page_id", "place")


@query("url_domains", r"SELECT page_id, regexp_extract(url, 'https?://(?:www\.)?([^/]+)', 1) AS domain FROM pages")
def url_domains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.domain(F.col("url")).alias("domain"))


@query("safe_names", r"""SELECT p_partkey, CASE WHEN n = '' THEN 'document' ELSE n END AS name FROM (SELECT p_partkey,
  regexp_replace(regexp_replace(regexp_replace(replace(p_name || ' (v1).pdf', ' ', '_'), '_+', '_', 'g'), '[^A-Za-z0-9_.-]', '', 'g'), '^_+|_+$', '', 'g') AS n FROM part)""")
def safe_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.safe_name(F.concat("p_name", F.lit(" (v1).pdf"))).alias("name"))


@query("header_scopes", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'col' WHEN l_orderkey % 4 = 0 THEN 'row' ELSE 'col' END AS scope FROM lineitem")
def header_scopes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.scope_of(F.lit(False), F.col("l_linenumber") - 1, F.col("l_orderkey") % 4).alias("scope"))


@query("header_keys", r"SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || '  #' || p_brand), '\s+', ' ', 'g'), '[^a-z0-9 ]', '', 'g')) AS header FROM part")
def header_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.header_key(F.concat("p_name", F.lit("  #"), "p_brand")).alias("header"))


@query("job_ids", "SELECT o_orderkey, substr(md5(o_orderpriority || ':' || o_orderkey || ':' || o_custkey), 1, 12) AS job_id FROM orders")
def job_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", text.job_id(F.col("o_orderpriority"), F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("job_id"))


@query("reply_repair", "SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS answer FROM events")
def reply_repair(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat(F.lit('{"id": "'), F.col("event_id").cast("string"), F.lit('"}'))
    kinds = [body, F.concat(F.lit("```json\n"), body, F.lit("\n```")), F.concat(F.lit("Sure: "), body, F.lit(" as asked")), F.lit("I can't")]
    reply = F.element_at(F.array(*kinds), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", text.reply_map(reply)["id"].alias("answer"))


@query("spoken_formulas", """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN split_part(p_name, ' ', 1) || ' Antiporter exchanging chloride, Cl minus and bicarbonate, H C O 3 minus, written as Cl minus divided by HCO3 minus.'
  WHEN 1 THEN 'sodium, N a plus divided by potassium, K plus' ELSE 'x equals y' END AS spoken FROM part""")
def spoken_formulas(spark: SparkSession, d: str) -> DataFrame:
    caption = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.substring_index("p_name", " ", 1), F.lit(" Cl-/HCO3- Antiporter"))).when(F.col("p_partkey") % 3 == 1, "Na+/K+").otherwise("x equals y")
    spoken = F.regexp_replace(text.spoken_formula(caption), r"\. Spoken formula.*$", "")
    return table(spark, d, "part").select("p_partkey", spoken.alias("spoken"))


@query("prose_tables", r"""SELECT p_partkey, 'Transporter|Size ' || p_size AS headers, CASE p_partkey % 3 WHEN 0 THEN p_brand || '/' || p_type || '/' || p_name || ';' || p_brand || '/x/y' WHEN 1 THEN '/' || p_type || '/' || p_name
  ELSE 'GLUT' || p_size || '/' || lower(p_type) || '/' || 'carrying ' || p_size END AS rows FROM part""")
def prose_tables(spark: SparkSession, d: str) -> DataFrame:
    def row(nth: str, a: F.Column, b: F.Column, c: F.Column) -> F.Column:
        return F.concat(F.lit(f" The {nth} row contains '"), a, F.lit("' under 'Transporter', '"), b, F.lit("' under 'Tissue Expression', and '"), c, F.lit("' under 'Biological Role'."))

    brand, container, maker, size = F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.col("p_size").cast("string")
    quoted = F.concat(row("first", brand, container, maker), row("second", brand, F.lit("x"), F.lit("y")))
    under = F.concat(F.lit(" The first row, under 'Transporter' is blank, under 'Tissue Expression' it says '"), container, F.lit("', under 'Biological Role' it says '"), maker, F.lit("'."))
    free = F.concat(F.lit(" Another row includes 'GLUT"), size, F.lit("' with tissue expression in "), F.lower(container), F.lit(" and biological role of carrying "), size, F.lit("."))
    rest = F.when(F.col("p_partkey") % 3 == 0, quoted).when(F.col("p_partkey") % 3 == 1, under).otherwise(free)
    prose = F.concat(F.lit("A table. Columns are labeled 'Transporter' and 'Size "), size, F.lit("'."), rest)
    cells = F.array_join(F.transform(text.prose_rows(prose), lambda r: F.array_join(r, "/")), ";")
    return table(spark, d, "part").select("p_partkey", F.array_join(text.prose_headers(prose), "|").alias("headers"), cells.alias("rows"))


@query("nearest_headers", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Total amount' WHEN 1 THEN 'Year' ELSE NULL END AS header FROM part")
def nearest_headers(spark: SparkSession, d: str) -> DataFrame:
    wanted = F.when(F.col("p_partkey") % 3 == 0, "total amout").when(F.col("p_partkey") % 3 == 1, " YEAR!").otherwise("zzzz")
    return table(spark, d, "part").select("p_partkey", text.nearest_header(wanted, F.array(F.lit("Year"), F.lit("Total amount"))).alias("header"))


@query("content_types", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'text/html' WHEN 1 THEN 'image/png' ELSE 'application/octet-stream' END AS content_type FROM pages")
def content_types(spark: SparkSession, d: str) -> DataFrame:
    end = F.when(F.col("page_id") % 3 == 0, ".HTML").when(F.col("page_id") % 3 == 1, ".png").otherwise(".xyz")
    return table(spark, d, "pages").select("page_id", text.content_type(F.concat(F.lit("a/b"), end)).alias("content_type"))


@query("glyph_pairs", "SELECT p_partkey, printf('%04X', CAST(p_partkey AS BIGINT)) || '=A' AS pair FROM part")
def glyph_pairs(spark: SparkSession, d: str) -> DataFrame:
    data = F.concat(F.lit("begincodespacerange <0000> <FFFF> endcodespacerange beginbfchar <"), F.format_string("%04X", "p_partkey"), F.lit("> <0041> endbfchar"))
    pairs = F.transform(text.glyph_pairs(data), lambda p: F.concat(p["src"], F.lit("="), p["dst"]))
    return table(spark, d, "part").select("p_partkey", F.array_join(pairs, ",").alias("pair"))


# ---- joins, windows, roll-ups ------------------------------------------------------------------


@query("chunk_plan", """WITH p AS (SELECT doc_id, CAST(ceil(n_chars / 10.0) AS INT) AS pages FROM documents WHERE n_chars > 0)
SELECT doc_id, CAST(c AS INT) AS chunk, CAST((c - 1) * 200 + 1 AS INT) AS first_page, CAST(least(c * 200, pages) AS INT) AS last_page, 'doc' || doc_id || '_chunk_' || c || '.pdf' AS name
FROM (SELECT *, unnest(range(1, CAST(ceil(pages / 200.0) AS INT) + 1)) AS c FROM p)""")
def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("in/doc"), F.col("doc_id").cast("string"), F.lit(".PDF")).alias("key"), F.ceil(F.col("n_chars") / 10).cast("int").alias("pages"))
    return jobs.chunk_plan(docs)


@query("merged_chunks", """SELECT o_orderkey AS doc_id, count(l_linenumber) AS planned, string_agg('c' || l_linenumber, ',' ORDER BY l_linenumber) FILTER (l_returnflag <> 'R') AS merged,
  count(*) FILTER (l_returnflag <> 'R') = count(*) AS whole FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def merged_chunks(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("chunk"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("name"), "l_returnflag")
    return jobs.merged_chunks(lines.filter("l_returnflag <> 'R'"), lines)


@query("image_only_docs", "SELECT conv_id AS doc_id, NOT bool_or(length(trim(CASE WHEN role = 'user' THEN '' ELSE text END)) > 0) AS image_only FROM conversations GROUP BY conv_id")
def image_only_docs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.when(F.col("role") == "user", "").otherwise(F.col("text")).alias("text"))
    return jobs.image_only(rows)


@query("combine_pages", r"""SELECT conv_id AS doc_id, md5(string_agg('<div class="page-container" id="page-' || turn || '">' || text || '</div>', chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id""")
def combine_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.col("text").alias("html"))
    return files.combined(rows).select("doc_id", F.md5("html").alias("digest"))


@query("dup_blocks", r"""WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents),
c AS (SELECT doc_id, ord, regexp_replace(t, '^\s+|\s+$', '', 'g') AS s FROM b)
SELECT doc_id, CAST(ord AS INT) AS ord, row_number() OVER (PARTITION BY doc_id, s ORDER BY ord) > 1 AS is_duplicate FROM c WHERE s <> ''""")
def dup_blocks(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ord", "text")).withColumn("tag", F.lit("p"))
    return fs.duplicate_blocks(lines).select("doc_id", "ord", "is_duplicate")


@query("usage_rollup", """SELECT model, purpose, CAST(grouping_id(model, purpose) AS INT) AS level, count(*) AS calls, CAST(sum(length(text) // 4) AS BIGINT) AS input_tokens,
  CAST(sum(turn) AS BIGINT) AS output_tokens, CAST(sum(length(text)) AS BIGINT) AS processing_ms
FROM (SELECT *, 'm' || conv_id % 3 AS model, role AS purpose FROM conversations) GROUP BY GROUPING SETS ((), (model), (purpose))""")
def usage_rollup(spark: SparkSession, d: str) -> DataFrame:
    calls = table(spark, d, "conversations").select(
        F.concat(F.lit("m"), (F.col("conv_id") % 3).cast("string")).alias("model"), F.col("role").alias("purpose"), F.floor(F.length("text") / 4).alias("input_tokens"),
        F.col("turn").alias("output_tokens"), F.length("text").cast("long").alias("processing_ms"),
    )
    return jobs.usage_rollup(calls)


@query("latest_status_by_file", "SELECT user_id AS file, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY user_id")
def latest_status_by_file(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select(F.col("user_id").alias("file"), "ts", "event_id", F.col("event_type").alias("status"))
    return jobs.latest_status(log)


@query("job_latest_status", """SELECT user_id AS job_id, arg_max(event_type, (ts, event_id)) AS status, count(*) AS n_events, string_agg(event_type, '>' ORDER BY ts, event_id) AS history FROM events GROUP BY user_id""")
def job_latest_status(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select(F.col("user_id").alias("job_id"), "ts", "event_id", F.lit("audit").alias("stage"), F.col("event_type").alias("status"))
    return jobs.job_record(log).select("job_id", "status", "n_events", "history")


@query("event_parse", """SELECT event_id, CASE WHEN event_id % 4 = 2 THEN NULL ELSE 'b' || user_id END AS bucket, CASE WHEN event_id % 4 = 2 THEN NULL ELSE 'uploads/a b' || n || '.pdf' END AS key, CASE WHEN event_id % 4 = 2 THEN 'not json' END AS raw_body
FROM (SELECT *, unnest(CASE WHEN event_id % 4 = 3 THEN [1, 2] ELSE [1] END) AS n FROM events)""")
def event_parse(spark: SparkSession, d: str) -> DataFrame:
    """Plain notifications, such as a queue delivers, and bodies that aren't JSON."""
    def record(n: int) -> F.Column:
        return F.concat(F.lit('{"eventName":"x","s3":{"bucket":{"name":"b'), F.col("user_id").cast("string"), F.lit(f'"}},"object":{{"key":"uploads/a+b{n}.pdf"}}}}}}'))

    def whole(*parts: F.Column) -> F.Column:
        return F.concat(F.lit('{"Records":['), F.concat_ws(",", *parts), F.lit("]}"))

    queued = F.concat(F.lit('{"Records":['), F.to_json(F.struct(whole(record(1), record(2)).alias("body"))), F.lit("]}"))
    body = F.when(F.col("event_id") % 4 == 2, "not json").when(F.col("event_id") % 4 == 3, queued).otherwise(whole(record(1)))
    return jobs.parse_events(table(spark, d, "events").select("event_id", body.alias("body"))).select("event_id", "bucket", "key", "raw_body")


@query("progress_summary", """SELECT o_custkey AS course, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS failed,
  CAST(coalesce(min(n) FILTER (o_orderstatus <> 'F') - 1, count(*)) AS INT) AS next_index
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) GROUP BY o_custkey""")
def progress_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("course"), F.col("o_orderkey").alias("chapter"), (F.col("o_orderstatus") == "F").alias("done"), (F.col("o_orderstatus") == "P").alias("failed"))
    return jobs.progress(rows)


@query("frontier_index", """WITH RECURSIVE s AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey % 3) AS n, CAST(l_partkey % 3 AS INT) AS v FROM lineitem),
r(k, n, next) AS (SELECT DISTINCT k, CAST(0 AS BIGINT), 0 FROM s UNION ALL SELECT s.k, s.n, CASE WHEN s.v = r.next THEN r.next + 1 ELSE r.next END FROM r JOIN s ON s.k = r.k AND s.n = r.n + 1)
SELECT k AS l_orderkey, CAST(arg_max(next, n) AS INT) AS next_index FROM r GROUP BY k""")
def frontier_index(spark: SparkSession, d: str) -> DataFrame:
    steps = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", (F.col("l_partkey") % 3).cast("int").alias("v")))).alias("s"))
    return steps.select("l_orderkey", jobs.frontier(F.transform("s", lambda x: x["v"])).alias("next_index"))


@query("orphans", "SELECT doc_id AS topic FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT page_id FROM pages)")
def orphans(spark: SparkSession, d: str) -> DataFrame:
    topics = table(spark, d, "documents").select(F.col("doc_id").alias("topic"))
    return jobs.orphans(topics, table(spark, d, "labels").select(F.col("doc_id").alias("topic")), table(spark, d, "pages").select(F.col("page_id").alias("topic")))


@query("retry_set", "SELECT c_custkey AS topic FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def retry_set(spark: SparkSession, d: str) -> DataFrame:
    return jobs.to_retry(table(spark, d, "customer").select(F.col("c_custkey").alias("topic")), table(spark, d, "orders").select(F.col("o_custkey").alias("topic")))


@query("skip_done", "SELECT 'uploads/' || page_id || '.pdf' AS key FROM pages WHERE page_id % 4 NOT IN (1, 2) AND page_id NOT IN (SELECT doc_id FROM labels)")
def skip_done(spark: SparkSession, d: str) -> DataFrame:
    page, name = F.col("page_id").cast("string"), F.lit("uploads/")
    key = F.when(F.col("page_id") % 4 == 1, F.concat(name, F.lit("deep/"), page, F.lit(".pdf"))).when(F.col("page_id") % 4 == 2, F.concat(name, page, F.lit(".txt"))).otherwise(F.concat(name, page, F.lit(".pdf")))
    done = table(spark, d, "labels").select(F.concat(name, F.col("doc_id").cast("string"), F.lit(".pdf")).alias("key"))
    return jobs.wanted_uploads(table(spark, d, "pages").select(key.alias("key")), done)


@query("scope_topics", """SELECT o_custkey AS course, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INT) AS topic_no, 't' || l_partkey AS topic, CAST(o_orderkey AS VARCHAR) AS chapter
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def scope_topics(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("t"))
    chapters = table(spark, d, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    topics = F.transform("t", lambda x: F.struct(F.concat(F.lit("t"), x["l_partkey"].cast("string")).alias("id")))
    courses = chapters.groupBy(F.col("o_custkey").alias("course")).agg(F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("id"), topics.alias("topics"))).alias("chapters"))
    return jobs.topics_of(courses).select("course", "topic_no", "topic", "chapter")


LINES_SQL = "(SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines, one for each number."""
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return rows.agg(*[F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")])


BOX = """SELECT l_orderkey AS file, l_orderkey * 10 + l_linenumber AS id, l_orderkey * 10 + l_linenumber AS no, CAST(l_partkey % 97 AS DOUBLE) AS x, CAST(l_suppkey % 89 AS DOUBLE) AS top,
  l_quantity AS width, CAST(l_linenumber * 5 AS DOUBLE) AS height, l_returnflag FROM lineitem"""


def _boxes(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = lines.select(
        F.col("l_orderkey").alias("file"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_partkey") % 97).cast("double").alias("x"), (F.col("l_suppkey") % 89).cast("double").alias("top"),
        F.col("l_quantity").alias("width"), (F.col("l_linenumber") * 5).cast("double").alias("height"), "l_returnflag",
    )
    images = rows.filter("l_returnflag = 'R'").select("file", F.col("id").alias("image_id"), F.col("id").alias("image_no"), "x", "top", "width", "height")
    return images, rows.filter("l_returnflag <> 'R'").select("file", F.col("id").alias("box_id"), F.col("id").alias("box_no"), "x", "top", "width", "height")


@query("bbox_candidates", f"""WITH b AS ({BOX}) SELECT i.file, i.id AS image_id, o.id AS box_id FROM b i JOIN b o ON i.file = o.file AND i.l_returnflag = 'R' AND o.l_returnflag <> 'R'
  AND abs(i.x - o.x) <= 7 AND abs(i.top - o.top) <= 7 AND abs(round_even(i.width, 0) - round_even(o.width, 0)) <= 7 AND abs(i.height - o.height) <= 7""")
def bbox_candidates(spark: SparkSession, d: str) -> DataFrame:
    return layout.box_candidates(*_boxes(table(spark, d, "lineitem"))).select("file", "image_id", "box_id")


@query("bbox_match", f"""WITH RECURSIVE b AS ({BOX}), c AS (SELECT i.file, i.id AS image_id, o.id AS box_id FROM b i JOIN b o ON i.file = o.file AND i.l_returnflag = 'R' AND o.l_returnflag <> 'R'
  AND abs(i.x - o.x) <= 7 AND abs(i.top - o.top) <= 7 AND abs(round_even(i.width, 0) - round_even(o.width, 0)) <= 7 AND abs(i.height - o.height) <= 7),
p AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY image_id, box_id) AS n FROM c),
r(file, n, images, boxes) AS (SELECT DISTINCT file, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM p UNION ALL
  SELECT p.file, p.n, CASE WHEN list_contains(images, image_id) OR list_contains(boxes, box_id) THEN images ELSE list_append(images, image_id) END,
    CASE WHEN list_contains(images, image_id) OR list_contains(boxes, box_id) THEN boxes ELSE list_append(boxes, box_id) END FROM r JOIN p ON p.file = r.file AND p.n = r.n + 1),
l AS (SELECT file, arg_max(images, n) AS images, arg_max(boxes, n) AS boxes FROM r GROUP BY file)
SELECT file, unnest(images) AS image_id, unnest(boxes) AS box_id FROM l""")
def bbox_match(spark: SparkSession, d: str) -> DataFrame:
    return layout.one_to_one(layout.box_candidates(*_boxes(table(spark, d, "lineitem"))))


def _layout_rows(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as layout elements: an order is a document, quantities and parts give boxes."""
    return _lines(spark, d).select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("id"), F.array((F.col("l_partkey") % 3).cast("int")).alias("page_indices"), (F.col("l_partkey") % 3).cast("int").alias("page"),
        (F.col("l_suppkey") % 7).cast("double").alias("top"), F.col("l_quantity").alias("left"), F.col("l_linenumber").alias("reading_order"), F.col("l_linenumber").alias("list_no"),
        (F.col("l_partkey") % 2).cast("int").alias("issues"), (F.col("l_returnflag") == "R").alias("remediated"),
        F.when(F.col("l_partkey") % 4 == 0, "FIGURE").otherwise("TEXT").alias("type"), F.when(F.col("l_partkey") % 2 == 1, F.concat(F.lit("Figure "), F.col("l_linenumber").cast("string"))).otherwise("text").alias("text"),
    )


LAY = f"""y AS (SELECT l_orderkey AS doc_id, l_linenumber AS id, CAST(l_partkey % 3 AS INT) AS page, l_suppkey % 7 AS top, l_quantity AS lft, CAST(l_partkey % 2 AS INT) AS issues, l_returnflag = 'R' AS remediated,
  CASE WHEN l_partkey % 4 = 0 THEN 'FIGURE' ELSE 'TEXT' END AS type, CASE WHEN l_partkey % 2 = 1 THEN 'Figure ' || l_linenumber ELSE 'text' END AS text FROM {LINES_SQL})"""


@query("reading_order", f"WITH {LAY} SELECT doc_id, id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, top, lft, id) AS INT) AS order_no FROM y")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(_layout_rows(spark, d)).select("doc_id", "id", "order_no")


@query("neighbours_2", f"""WITH {LAY} SELECT doc_id, id, coalesce(string_agg(CAST(id AS VARCHAR), ',') OVER (PARTITION BY doc_id, page ORDER BY id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(CAST(id AS VARCHAR), ',') OVER (PARTITION BY doc_id, page ORDER BY id ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), '') AS after FROM y""")
def neighbours_2(spark: SparkSession, d: str) -> DataFrame:
    rows = layout.neighbours(_layout_rows(spark, d))
    return rows.select("doc_id", "id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("before", "after")])


@query("position_info", f"""WITH {LAY} SELECT doc_id, id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY id) - 1 AS INT) AS index, CAST(coalesce(sum(issues) OVER (PARTITION BY doc_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS issues_before,
  CAST(sum(issues) OVER (PARTITION BY doc_id) - coalesce(sum(issues) OVER (PARTITION BY doc_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS remaining,
  max(CASE WHEN issues > 0 THEN id END) OVER (PARTITION BY doc_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_issue,
  min(CASE WHEN issues > 0 THEN id END) OVER (PARTITION BY doc_id ORDER BY id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_issue FROM y""")
def position_info(spark: SparkSession, d: str) -> DataFrame:
    rows = layout.positions(_layout_rows(spark, d).withColumn("order_no", F.col("id")))
    return rows.select("doc_id", "id", "index", "issues_before", "remaining", "previous_issue", "next_issue")


@query("figure_captions", f"""WITH {LAY}, z AS (SELECT y.*, (id * 7 + page * 3 + issues) % 10 AS ro FROM y)
SELECT f.doc_id, f.id, (SELECT arg_min(t.text, t.id) FROM z t WHERE t.doc_id = f.doc_id AND t.page = f.page AND t.ro > f.ro AND t.type = 'TEXT' AND contains(t.text, 'Figure')) AS caption FROM z f WHERE f.type = 'FIGURE'""")
def figure_captions(spark: SparkSession, d: str) -> DataFrame:
    """The reading order differs from the order of the list."""
    rows = _layout_rows(spark, d).withColumn("reading_order", (F.col("id") * 7 + F.col("page") * 3 + F.col("issues")) % 10)
    return layout.captions(rows).select("doc_id", "id", "caption")


@query("page_status", f"WITH {LAY} SELECT doc_id, page, count(*) AS elements, count(*) FILTER (issues > 0) AS with_issues, count(*) FILTER (remediated) AS remediated, count(*) FILTER (issues > 0 AND NOT remediated) AS remaining FROM y GROUP BY ALL")
def page_status(spark: SparkSession, d: str) -> DataFrame:
    return layout.page_status(_layout_rows(spark, d))


@query("table_of_contents", "SELECT doc_id, CAST(1 AS INT) AS level, text AS title, CAST(n_chars % 5 + 1 AS BIGINT) AS page FROM documents WHERE doc_id % 3 = 0 AND text <> ''")
def table_of_contents(spark: SparkSession, d: str) -> DataFrame:
    path = F.when(F.col("doc_id") % 3 == 0, "//Document/Sect/H2").otherwise("//Document/P")
    return layout.table_of_contents(table(spark, d, "documents").select("doc_id", (F.col("n_chars") % 5).alias("page"), path.alias("path"), "text"))


@query("issue_files", """WITH i AS (SELECT o_custkey AS job_id, o_orderkey AS issue_id, o_orderkey % 5 AS way, o_orderkey % 7 AS n FROM orders),
j AS (SELECT job_id, issue_id, way, n, n < 4 + job_id % 3 AS there FROM i)
SELECT job_id, issue_id, CASE WHEN there AND way < 3 THEN 'out/' || job_id || '/page-' || n || '.html' ELSE 'out/' || job_id || '/page-0.html' END AS file, CAST(CASE WHEN there AND way < 3 THEN way ELSE 3 END AS INT) AS way FROM j""")
def issue_files(spark: SparkSession, d: str) -> DataFrame:
    """Jobs with 4 to 6 pages each; pages of one name are in every job."""
    n, way, job = F.col("o_orderkey") % 7, F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    name = F.concat(F.lit("page-"), n.cast("string"), F.lit(".html"))
    orders = table(spark, d, "orders")
    issues = orders.select(
        F.col("o_custkey").alias("job_id"), F.col("o_orderkey").alias("issue_id"), F.when(way == 0, F.concat(F.lit("out/"), job, F.lit("/"), name)).when(way == 1, F.concat(F.lit("tmp/"), name)).alias("file_path"),
        F.when(way == 2, n).otherwise(99).cast("int").alias("page_number"),
    )
    jobs_ = orders.select(F.col("o_custkey").alias("job_id")).distinct().withColumn("no", F.explode(F.sequence(F.lit(0), (F.col("job_id") % 3 + 3).cast("int"))))
    pages = jobs_.select("job_id", F.concat(F.lit("out/"), F.col("job_id").cast("string"), F.lit("/page-"), F.col("no").cast("string"), F.lit(".html")).alias("file"), F.col("no").alias("page_number"), F.col("no").cast("long").alias("file_no"))
    return fs.to_files(issues, pages)


@query("unified_dedup", """WITH s AS (SELECT o_orderkey % 500 AS k, 0 AS s, o_orderkey AS o FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey % 500, 1, o_orderkey FROM orders WHERE o_orderkey % 2 = 1)
SELECT 'issue-' || k AS key, CAST(arg_min(s, (s, o)) AS INT) AS source_no, arg_min(o, (s, o)) AS "order" FROM s GROUP BY k""")
def unified_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.concat(F.lit("issue-"), (F.col("o_orderkey") % 500).cast("string")).alias("issue_id"), F.lit("t").alias("type"), F.lit("major").alias("severity"), F.lit("p").alias("selector"), F.col("o_orderkey").alias("order"))
    return fs.merged([rows.filter("order % 2 = 0"), rows.filter("order % 2 = 1")]).select("key", "source_no", "order")


@query("remediation_summary", """SELECT o_custkey AS job_id, CAST(sum(p) AS BIGINT) AS issues_processed, CAST(sum(CASE WHEN r > p AND p > 0 THEN p ELSE r END) AS BIGINT) AS issues_remediated, CAST(sum(f) AS BIGINT) AS issues_failed, CAST(sum(r) AS BIGINT) AS changes_applied
FROM (SELECT o_custkey, o_orderkey % 5 AS p, o_orderkey % 7 AS r, o_orderkey % 3 AS f FROM orders) GROUP BY o_custkey""")
def remediation_summary(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    return fs.remediation_summary(table(spark, d, "orders").select(F.col("o_custkey").alias("job_id"), (key % 5).alias("processed"), (key % 7).alias("remediated"), (key % 3).alias("failed"), (key % 7).alias("changes_applied")))


@query("batch_rollup", """SELECT o_custkey AS job_id, count(*) AS processed, count(*) FILTER (o_orderstatus <> 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'F') AS failed,
  CAST(coalesce(sum(o_orderkey % 9) FILTER (o_orderstatus <> 'F'), 0) AS BIGINT) AS issues FROM orders GROUP BY o_custkey""")
def batch_rollup(spark: SparkSession, d: str) -> DataFrame:
    return fs.file_rollup(table(spark, d, "orders").select(F.col("o_custkey").alias("job_id"), (F.col("o_orderstatus") != "F").alias("ok"), (F.col("o_orderkey") % 9).alias("issues")))


@query("remediation_filters", """WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS no, CASE o_orderkey % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'major' WHEN 2 THEN 'minor' ELSE 'odd' END AS s, o_orderstatus AS t FROM orders)
SELECT o_custkey AS doc_id, o_orderkey AS emit_no FROM n WHERE no <= 5 AND t IN ('F', 'O') AND s IN ('critical', 'major')""")
def remediation_filters(spark: SparkSession, d: str) -> DataFrame:
    severity = F.element_at(F.array(*map(F.lit, ("critical", "major", "minor", "odd"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.lit(1).alias("check_no"), F.col("o_orderkey").alias("emit_no"), F.col("o_orderstatus").alias("type"), severity.alias("severity"))
    return fs.to_remediate(rows, ["F", "O"], "major", 5).select("doc_id", "emit_no")


@query("irregular_tables", """WITH t AS (SELECT l_orderkey AS k, l_linenumber AS r, min(l_partkey % 4 + 1) AS c FROM lineitem GROUP BY ALL),
g AS (SELECT k, count(*) AS n, count(DISTINCT c) AS widths, arg_min(c, r) AS a, arg_max(c, r) AS z FROM t GROUP BY k)
SELECT o_orderkey AS table_id, coalesce(widths, 0) AS widths, coalesce(widths > 1 AND NOT (n = 2 AND z > a AND z % a = 0), true) AS irregular FROM orders LEFT JOIN g ON k = o_orderkey""")
def irregular_tables(spark: SparkSession, d: str) -> DataFrame:
    """Orders as tables, their lines as rows; some orders have none."""
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("row")).agg(F.min(F.col("l_partkey") % 4 + 1).alias("cells"))
    return jobs.irregular_tables(table(spark, d, "orders").select(F.col("o_orderkey").alias("table_id")).join(rows, "table_id", "left"))


@query("dup_glyphs", "SELECT l_orderkey AS font, count(*) - count(DISTINCT l_partkey % 5) AS ambiguous FROM lineitem GROUP BY l_orderkey")
def dup_glyphs(spark: SparkSession, d: str) -> DataFrame:
    return jobs.ambiguous_glyphs(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("font"), F.lpad(F.hex("l_linenumber"), 4, "0").alias("src"), (F.col("l_partkey") % 5).alias("dst")))


@query("unmatched_marks", "SELECT l_orderkey AS doc_id, l_linenumber AS page, l_partkey AS mcid FROM lineitem WHERE l_returnflag <> 'R' AND (l_orderkey, l_linenumber, l_partkey) NOT IN (SELECT (l_orderkey, l_linenumber, l_partkey) FROM lineitem WHERE l_linestatus = 'F')")
def unmatched_marks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.col("l_partkey").alias("mcid"), "l_returnflag", "l_linestatus")
    return jobs.unmatched_marks(rows.filter("l_returnflag <> 'R'").select("doc_id", "page", "mcid"), rows.filter("l_linestatus = 'F'"))


@query("struct_audit", """WITH n AS (SELECT l_orderkey AS doc_id, CASE WHEN l_partkey % 2 = 0 THEN 'Figure' ELSE 'Table' END AS kind, l_linenumber AS i, CASE WHEN l_suppkey % 3 = 0 THEN ' ' ELSE 'x' END AS alt, CASE WHEN l_suppkey % 2 = 0 THEN 's' END AS summary, l_suppkey % 4 AS ths FROM lineitem)
SELECT doc_id, count(*) FILTER (kind = 'Figure') AS figures, coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FILTER (kind = 'Figure' AND trim(alt) = ''), '') AS figures_without_alt, count(*) FILTER (kind = 'Table') AS tables,
  count(*) FILTER (kind = 'Table' AND summary IS NULL) AS tables_without_summary, count(*) FILTER (kind = 'Table' AND ths = 0) AS tables_without_th FROM n GROUP BY doc_id""")
def struct_audit(spark: SparkSession, d: str) -> DataFrame:
    supp = F.col("l_suppkey")
    nodes = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.when(F.col("l_partkey") % 2 == 0, "Figure").otherwise("Table").alias("kind"), F.col("l_linenumber").alias("index"),
        F.when(supp % 3 == 0, " ").otherwise("x").alias("alt"), F.when(supp % 2 == 0, "s").alias("summary"), (supp % 4).alias("ths"),
    )
    return jobs.struct_audit(nodes)


@query("grouped_names", "SELECT doc_id, prefix, count(*) AS n FROM (SELECT o_custkey AS doc_id, split_part(o_orderpriority, '-', 1) AS prefix FROM orders) GROUP BY ALL HAVING count(*) >= 2")
def grouped_names(spark: SparkSession, d: str) -> DataFrame:
    return jobs.grouped_names(table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.replace("o_orderpriority", F.lit("-"), F.lit("_")).alias("name")))


# ---- reports and fixes -------------------------------------------------------------------------


@query("report_csv", f"{F_SQL} SELECT doc_id, type, severity, status, {WCAG_OF} AS wcag, count(*) AS n, count(*) AS ids FROM f GROUP BY ALL")
def report_csv(spark: SparkSession, d: str) -> DataFrame:
    docs, e = parsed(spark, d, detailed=True)
    rows = files.report_rows(fs.numbered(fs.enriched(rules.audit(docs, e), e)), "doc_id")
    return rows.groupBy("doc_id", "type", "severity", "status", "wcag").agg(F.count("*").alias("n"), F.count_distinct("issue_id").alias("ids"))


NO_FIX = "('generic-heading', 'duplicate-link-text-different-url', 'form-control-missing-name')"


def _fixed(spark: SparkSession, d: str) -> DataFrame:
    docs, e = parsed(spark, d)
    return remediate.remediated(table(spark, d, "pages"), rules.audit(docs, e))


@query("remediate_pages", f"""{F_SQL}, x AS (SELECT doc_id, CASE WHEN type IN {NO_FIX} THEN 'skipped' ELSE 'remediated' END AS outcome, type FROM f WHERE status = 'needs_remediation')
SELECT page_id AS doc_id, count(type) AS processed, count(*) FILTER (outcome = 'remediated') AS remediated, CAST(0 AS BIGINT) AS failed, count(*) FILTER (outcome = 'skipped') AS skipped,
  coalesce(string_agg(DISTINCT type, ',' ORDER BY type) FILTER (outcome <> 'remediated'), '') AS failed_types FROM pages LEFT JOIN x ON x.doc_id = page_id GROUP BY page_id""")
def remediate_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = remediate.outcome_summary(_fixed(spark, d)).drop("changes_applied")
    return rows.withColumn("failed_types", F.array_join("failed_types", ","))


@query("fix_outcomes", f"{F_SQL} SELECT doc_id, type, CASE WHEN type IN {NO_FIX} THEN 'skipped' ELSE 'remediated' END AS outcome, count(*) AS n FROM f WHERE status = 'needs_remediation' GROUP BY ALL")
def fix_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What became of each finding, by its issue id."""
    return remediate.outcome_rows(_fixed(spark, d)).groupBy("doc_id", "type", "outcome").agg(F.count_distinct("issue_id").alias("n"))


@query("remediated_findings", f"{F_SQL} SELECT DISTINCT doc_id, type FROM f WHERE status = 'needs_remediation' AND type NOT IN ('no-headings', 'no-h1', 'skipped-heading-level', 'empty-heading', 'missing-main-landmark', 'missing-navigation-landmark', 'missing-header-landmark', 'missing-footer-landmark', 'missing-skip-link', 'generic-link-text', 'empty-link-text', 'url-as-link-text')")
def remediated_findings(spark: SparkSession, d: str) -> DataFrame:
    """What an audit still finds after the fixes."""
    after = written(_fixed(spark, d).select("doc_id", "html"), "fixed")
    e = written(elements(after, "doc_id", columns=RULE_COLUMNS), "elements")
    return rules.audit(after.select("doc_id"), e).filter("status = 'needs_remediation'").select("doc_id", "type").distinct()


@query("severity_order", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS rank FROM orders")
def severity_order(spark: SparkSession, d: str) -> DataFrame:
    severity = F.element_at(F.array(*map(F.lit, ("critical", "major", "minor", "info", "odd"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", severity_rank(severity).alias("rank"))
