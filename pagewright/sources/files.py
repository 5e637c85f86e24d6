"""File sources and report sinks, for any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from pagewright.functions.text import page_number, title_source
from pagewright.sources.tables import written


def html_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """file, file_name, page_number, html of *.html files in a folder, or of one file; file order is by name."""
    reader = spark.read.option("wholetext", True).option("pathGlobFilter", "*.html")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    rows = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("html"))
    return rows.withColumn("page_number", page_number(F.col("file")))


def html_folder(spark: SparkSession, path: str) -> DataFrame:
    """html_files of a folder's extracted_html, if there is such a folder in it, else of the folder itself."""
    inner = spark._jvm.org.apache.hadoop.fs.Path(path, "extracted_html")
    fs = inner.getFileSystem(spark._jsc.hadoopConfiguration())
    return html_files(spark, inner.toString() if fs.exists(inner) and fs.getFileStatus(inner).isDirectory() else path)


def by_page(files: DataFrame) -> DataFrame:
    """In the order of page numbers; files without one come at 999."""
    return files.orderBy(F.coalesce("page_number", F.lit(999)), "file")


def placed(files: DataFrame) -> DataFrame:
    """files with place, their number in that order from 1. Each range of the order is numbered in a
    task of its own; of the ranges, only the counts are added up. The ranges are written once: worked
    out again, for the counts, they could be others."""
    number = F.coalesce("page_number", F.lit(999))
    ranged = written(files.repartitionByRange(number, F.col("file")).withColumn("range_no", F.spark_partition_id()), "ranges")
    within = F.row_number().over(Window.partitionBy("range_no").orderBy(number, "file"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = ranged.groupBy("range_no").agg(F.count("*").alias("n")).select("range_no", before.alias("before"))
    rows = ranged.withColumn("within", within).join(F.broadcast(counts), "range_no")
    return rows.withColumn("place", (F.col("within") + F.col("before")).cast("long")).drop("within", "before", "range_no")


def title_texts(pages: DataFrame) -> DataFrame:
    """Per document of (doc_id, page, text) what a title is made from: its first page, or first three."""
    first = F.array_sort(F.collect_list(F.when(F.col("page") <= 3, F.struct("page", "text"))))
    rows = pages.groupBy("doc_id").agg(F.count("*").cast("int").alias("pages"), first.alias("p"))
    texts = F.transform("p", lambda x: F.coalesce(x["text"], F.lit("")))
    return rows.select("doc_id", title_source(texts[0], F.array_join(texts, "\n\n"), F.col("pages")).alias("text"))


def binary_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def combined(pages: DataFrame) -> DataFrame:
    """Per document its pages' markup in order, each in a division."""
    part = F.concat(F.lit('<div class="page-container" id="page-'), F.col("page").cast("string"), F.lit('">'), F.col("html"), F.lit("</div>"))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", part.alias("h")))), lambda x: x["h"]), "\n").alias("html"))


def report_rows(findings: DataFrame, *also: str) -> DataFrame:
    """The flat columns of a CSV report, after also; cells that a spreadsheet would run are quoted."""
    names = ("issue_id", "type", "severity", "wcag", "status", "element", "location")
    rows = findings.select(*also, "issue_id", "type", "severity", "wcag", "status", "element", F.col("location.path").alias("location"))
    return rows.select(*also, *[F.when(F.col(c).rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), F.col(c))).otherwise(F.col(c)).alias(c) for c in names])


def remediation_rows(fixes: DataFrame) -> DataFrame:
    """The flat columns of a CSV report of fixes (doc_id, outcomes): one row for each finding and what
    became of it; notes that a spreadsheet would run are quoted."""
    note = F.when(F.col("note").rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), F.col("note"))).otherwise(F.col("note"))
    return fixes.select("doc_id", F.inline("outcomes")).select("doc_id", "issue_id", "type", "outcome", note.alias("note"))


def json_rows(findings: DataFrame) -> DataFrame:
    return findings.select(F.to_json(F.struct(*findings.columns)).alias("value"))


def text_rows(findings: DataFrame) -> DataFrame:
    """Per document a text report: a headline and a line for each finding that needs work, in order."""
    line = F.concat_ws(" ", F.concat(F.lit("["), F.col("severity"), F.lit("]")), "type", F.concat(F.lit("("), F.col("wcag"), F.lit(")")))
    item = F.struct("check_no", "emit_no", line.alias("line"))
    rows = findings.groupBy("doc_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("status") == "needs_remediation", item))).alias("lines"))
    return rows.select("doc_id", F.concat(F.lit("Findings: "), F.col("n").cast("string"), F.lit("\n"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("value"))


def html_rows(findings: DataFrame) -> DataFrame:
    """Per document an HTML report with a table of its findings."""

    def safe(c: str) -> F.Column:
        return F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    cells = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), safe(c), F.lit("</td>")) for c in ("type", "severity", "wcag", "status", "element")], F.lit("</tr>"))
    rows = findings.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("check_no", "emit_no", cells.alias("r")))).alias("rows"))
    return rows.select("doc_id", F.concat(F.lit('<!DOCTYPE html><html lang="en"><head><title>Audit report</title></head><body><main><h1>Audit report</h1><table><tr><th scope="col">Type</th><th scope="col">Severity</th><th scope="col">Criterion</th><th scope="col">Status</th><th scope="col">Element</th></tr>'), F.array_join(F.transform("rows", lambda x: x["r"]), ""), F.lit("</table></main></body></html>")).alias("value"))


def write_report(findings: DataFrame, path: str, kind: str = "json", mode: str = "errorifexists") -> None:
    """Writes findings (enriched and numbered) as json, csv, text or html; unknown kinds are json."""
    if kind == "csv":
        report_rows(findings).write.mode(mode).option("header", True).csv(path)
    elif kind == "text":
        text_rows(findings).select("value").write.mode(mode).text(path)
    elif kind == "html":
        html_rows(findings).select("value").write.mode(mode).text(path)
    else:
        json_rows(findings).write.mode(mode).text(path)


def usage_files(calls: DataFrame, path: str) -> None:
    """Usage rows in a folder per day."""
    calls.withColumn("date", F.to_date("ts")).write.mode("append").partitionBy("date").json(path)
