"""What happens to findings: enrichment, thresholds, summaries, merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .dims import SEVERITY, STATUSES, severity_rank, wcag
from .structure import with_text


def enriched(findings: DataFrame, e: DataFrame, detailed: bool = True) -> DataFrame:
    """Findings with criterion name and level, element, location and, if detailed, context. The
    criteria are a fixed table of 78 rows, which is broadcast."""
    spark = findings.sparkSession
    named = findings.join(F.broadcast(wcag(spark)), findings["wcag"] == F.col("criterion"), "left").drop("criterion")
    named = named.withColumns({"criterion_name": F.coalesce("criterion_name", F.lit("")), "criterion_level": F.coalesce("criterion_level", F.lit(""))})
    place = e.select("doc_id", "ord", F.col("tag").alias("element"), F.struct(F.col("css_path").alias("path"), "page_number").alias("location"))
    if not detailed:
        return named.join(place, ["doc_id", "ord"], "left")
    # the texts of elements that have findings alone are read
    same = Window.partitionBy("doc_id", "tag")
    told = named.filter("ord is not null").select("doc_id", "ord").distinct()
    numbers = e.select("doc_id", "ord", (F.row_number().over(same.orderBy("ord")) - 1).alias("position"), F.count("*").over(same).alias("total"))
    chosen = with_text(e.drop("text", "page_text", "own_text").join(told, ["doc_id", "ord"]), e).join(numbers, ["doc_id", "ord"])
    context = F.struct(F.col("tag").alias("element_name"), F.col("attrs").alias("attributes"), F.col("text").alias("text_content"), F.col("snippet").alias("html_snippet"), "position", "total")
    return named.join(place, ["doc_id", "ord"], "left").join(chosen.select("doc_id", "ord", context.alias("context")), ["doc_id", "ord"], "left")


def numbered(findings: DataFrame) -> DataFrame:
    """issue-{n} within each document, in the order of checks and of emission."""
    order = Window.partitionBy("doc_id").orderBy("check_no", "emit_no", "type")
    return findings.withColumn("issue_id", F.concat(F.lit("issue-"), F.row_number().over(order)))


def over_threshold(findings: DataFrame, threshold: str = "minor") -> DataFrame:
    """Compliant rows always stay; an unknown threshold counts as minor, an unknown severity as info."""
    least = SEVERITY.get(threshold, 1)
    return findings.filter((severity_rank(F.col("severity")) >= least) | (F.col("status") == "compliant"))


def without_remediated(findings: DataFrame) -> DataFrame:
    return findings.filter(~F.col("status").isin("remediated", "auto_remediated"))


def to_remediate(findings: DataFrame, types: list[str] | None = None, least: str | None = None, max_issues: int | None = None) -> DataFrame:
    """What remediation takes of each document: the first max_issues, of these the types, of these
    the severities, in this order."""
    rows = findings
    if max_issues is not None:
        rows = rows.withColumn("no", F.row_number().over(Window.partitionBy("doc_id").orderBy("check_no", "emit_no", "type"))).filter(F.col("no") <= max_issues).drop("no")
    if types is not None:
        rows = rows.filter(F.col("type").isin(types))
    if least is not None:
        rows = rows.filter(severity_rank(F.col("severity"), unknown=1) >= SEVERITY.get(least, 1))
    return rows


def _counts(column: str, values: tuple[str, ...]) -> list[Column]:
    return [F.count_if(F.col(column) == v).alias(v) for v in values]


def status_summary(findings: DataFrame) -> DataFrame:
    """One row: findings and the four statuses; other statuses are not counted among them."""
    return findings.agg(F.count("*").alias("total_issues"), *_counts("status", STATUSES))


def severity_counts(findings: DataFrame) -> DataFrame:
    """One row: the four severities, compliant findings included."""
    return findings.agg(*_counts("severity", tuple(SEVERITY)))


def by_page(findings: DataFrame, page: Column) -> DataFrame:
    """Per page, null being a page of its own: findings and the four statuses."""
    return findings.groupBy(page.alias("page_number")).agg(F.count("*").alias("total"), *_counts("status", STATUSES))


def by_type(findings: DataFrame) -> DataFrame:
    """Per type; compliant by status or by name."""
    compliant = (F.col("status") == "compliant") | F.col("type").startswith("compliant-")
    return findings.groupBy("type").agg(F.count("*").alias("total"), F.count_if(compliant).alias("compliant"), F.count_if(~compliant).alias("needing_work"))


def unified_counts(findings: DataFrame) -> DataFrame:
    """Per type and severity: compliant, else remediated, else non-compliant."""
    kind = F.when((F.col("status") == "compliant") | F.col("type").startswith("compliant-"), "compliant").when(F.col("status").isin("remediated", "auto_remediated"), "remediated").otherwise("non_compliant")
    return findings.groupBy("type", "severity").agg(*[F.count_if(kind == k).alias(k) for k in ("compliant", "remediated", "non_compliant")])


def merged(sources: list[DataFrame]) -> DataFrame:
    """One row per key (the id, else type, severity and selector), from the first source that has it.
    The sources have issue_id, type, severity, selector and order."""
    rows = None
    for no, s in enumerate(sources):
        part = s.select("issue_id", "type", "severity", "selector", "order").withColumn("source_no", F.lit(no))
        rows = part if rows is None else rows.unionByName(part)
    key = F.coalesce("issue_id", F.concat_ws("-", "type", "severity", "selector"))
    first = F.row_number().over(Window.partitionBy("key").orderBy("source_no", "order"))
    return rows.withColumn("key", key).withColumn("no", first).filter("no = 1").drop("no")


def remediation_summary(results: DataFrame) -> DataFrame:
    """Per job of (job_id, processed, remediated, failed, changes_applied): sums, and remediated of a
    file held down to what it processed where it reports more."""
    held = F.when((F.col("remediated") > F.col("processed")) & (F.col("processed") > 0), F.col("processed")).otherwise(F.col("remediated"))
    return results.groupBy("job_id").agg(
        F.sum("processed").alias("issues_processed"), F.sum(held).alias("issues_remediated"), F.sum("failed").alias("issues_failed"), F.sum("changes_applied").alias("changes_applied")
    )


def summary_cascade(issues: DataFrame, reports: DataFrame, files: DataFrame) -> DataFrame:
    """Per job of issues (job_id, status): issues_processed, remediated, failed. What a report (job_id,
    processed, remediated, failed; one row per job) says of the processed counts before the issues if
    above 0, and the sums of its files (job_id, processed, remediated, failed) before both if any was
    processed; remediated and failed that are 0 are then taken from the report, if it tells them."""
    own = issues.groupBy("job_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "remediated").alias("fixed"), F.count_if(~F.coalesce(F.col("status") == "remediated", F.lit(False))).alias("lost"))
    of_files = files.groupBy("job_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"file_{c}") for c in ("processed", "remediated", "failed")])
    rows = own.join(reports.select("job_id", *[F.col(c).alias(f"told_{c}") for c in ("processed", "remediated", "failed")]), "job_id", "left").join(of_files, "job_id", "left")
    by_file = F.coalesce(F.col("file_processed") > 0, F.lit(False))
    processed = F.when(by_file, F.col("file_processed")).when(F.col("told_processed") > 0, F.col("told_processed")).otherwise(F.col("n"))

    def told(name: str, counted: str) -> Column:
        first = F.when(by_file, F.col(f"file_{name}")).otherwise(F.col(counted))
        return F.when(first == 0, F.coalesce(f"told_{name}", F.lit(0))).otherwise(first).cast("long").alias(name)

    return rows.select("job_id", processed.cast("long").alias("issues_processed"), told("remediated", "fixed"), told("failed", "lost"))


def file_rollup(files: DataFrame) -> DataFrame:
    """Per job of (job_id, ok, issues): files processed, succeeded and failed, and their findings."""
    return files.groupBy("job_id").agg(F.count("*").alias("processed"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("issues"))), F.lit(0)).alias("issues"))


def to_files(issues: DataFrame, files: DataFrame) -> DataFrame:
    """The file of each issue, of those of its job: by path, else by base name, else by page, else the
    job's first file. issues has job_id, issue_id, file_path, page_number; files has job_id, file,
    page_number, file_no (0: the first)."""
    base = F.regexp_extract
    i = issues.withColumn("base", base(F.coalesce("file_path", F.lit("")), "([^/]*)$", 1))
    f = files.withColumn("base", base("file", "([^/]*)$", 1))
    pairs = [
        i.join(f.select("job_id", F.col("file").alias("file_path"), "file", "file_no"), ["job_id", "file_path"]).withColumn("way", F.lit(0)),
        i.filter("base <> ''").join(f.select("job_id", "file", "file_no", "base"), ["job_id", "base"]).withColumn("way", F.lit(1)),
        i.join(f.select("job_id", "file", "file_no", "page_number"), ["job_id", "page_number"]).withColumn("way", F.lit(2)),
    ]
    ways = reduce(DataFrame.unionByName, [p.select("job_id", "issue_id", "file", "file_no", "way") for p in pairs])
    best = ways.groupBy("job_id", "issue_id").agg(F.min_by(F.struct("file", "way"), F.struct("way", "file_no")).alias("b"))
    first = files.filter("file_no = 0").select("job_id", F.col("file").alias("first_file"))
    joined = issues.join(best, ["job_id", "issue_id"], "left").join(first, "job_id", "left")
    return joined.select("job_id", "issue_id", F.coalesce("b.file", "first_file").alias("file"), F.coalesce("b.way", F.lit(3)).alias("way"))


def failed_report(reports: DataFrame, failures: DataFrame) -> DataFrame:
    """Reports (doc_id, total_issues, ... , severity_counts) together with those of documents that
    could not be read (doc_id, error), which have no findings and no severity counts."""
    none = failures.select("doc_id", F.lit(0).cast("long").alias("total_issues"), "error")
    return reports.unionByName(none, allowMissingColumns=True)


def types_by(kinds: DataFrame, wcag: str | None = None, severity: str | None = None, element: str | None = None) -> DataFrame:
    """The finding types of kinds (type, wcag, severity, elements) that a criterion, a severity and an
    element tag each select, where given."""
    rows = kinds
    if wcag is not None:
        rows = rows.filter(F.col("wcag") == wcag)
    if severity is not None:
        rows = rows.filter(F.col("severity") == severity)
    if element is not None:
        rows = rows.filter(F.array_contains("elements", element))
    return rows


def duplicate_blocks(blocks: DataFrame) -> DataFrame:
    """Which of blocks (doc_id, ord, tag, and text, or of the element table text_length and text_digest)
    repeat an earlier one of the same document: by tag and whole stripped text, digested where long."""
    if "text_digest" in blocks.columns:
        sign, has_text = F.concat_ws(":", "tag", "text_length", "text_digest"), F.col("text_length") > 0
    else:
        text = F.regexp_replace("text", r"^\s+|\s+$", "")
        sign, has_text = F.concat("tag", F.lit(":"), F.when(F.length(text) > 100, F.md5(text)).otherwise(text)), text != ""
    no = F.row_number().over(Window.partitionBy("doc_id", sign).orderBy("ord"))
    return blocks.filter(has_text).select("doc_id", "ord", "tag", (no > 1).alias("is_duplicate"))
