"""Chunks, job logs, progress, usage and scope: the control side as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.functions.text import payload_lines

CHUNK_PAGES = 200

# Stages and statuses of a job.
STAGES = ("PDF_TO_HTML", "AUDIT", "REMEDIATION", "COMPLETE")
STATES = ("PENDING", "PROCESSING", "COMPLETED", "FAILED")


def chunk_plan(documents: DataFrame, size: int = CHUNK_PAGES) -> DataFrame:
    """Chunks of documents (doc_id, key, pages): number from 1, first and last page, name. Built from
    the page count alone, without a row per page."""
    base = F.regexp_replace(F.regexp_extract("key", "([^/]+)$", 1), r"(?i)\.pdf$", "")
    rows = documents.filter("pages > 0").withColumn("chunk", F.explode(F.sequence(F.lit(1), F.ceil(F.col("pages") / size).cast("int"))))
    return rows.select(
        "doc_id", "chunk", ((F.col("chunk") - 1) * size + 1).alias("first_page"), F.least(F.col("chunk") * size, F.col("pages")).alias("last_page"),
        F.concat(base, F.lit("_chunk_"), F.col("chunk"), F.lit(".pdf")).alias("name"),
    )


def merged_chunks(chunks: DataFrame, plan: DataFrame) -> DataFrame:
    """Per document the chunk names in order, whole only if every planned chunk is there."""
    have = chunks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "name"))).alias("c"))
    need = plan.groupBy("doc_id").agg(F.count("*").alias("planned"))
    return need.join(have, "doc_id", "left").select("doc_id", "planned", F.array_join(F.transform("c", lambda x: x["name"]), ",").alias("merged"), (F.coalesce(F.size("c"), F.lit(0)) == F.col("planned")).alias("whole"))


def image_only(pages: DataFrame) -> DataFrame:
    """Per document of (doc_id, text): True if no page has text."""
    return pages.groupBy("doc_id").agg((~F.bool_or(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0)).alias("image_only"))


def latest_status(log: DataFrame, key: str = "file", at: str = "ts", tie: str = "event_id") -> DataFrame:
    """The last status of each file of an append-only log."""
    return log.groupBy(key).agg(F.max_by("status", F.struct(at, tie)).alias("status"))


# Fixed value: how a log line names its file and status.
LOG_LINE = r"File: (.*?), Status: (.*)"


def parsed_log(lines: DataFrame, column: str = "message") -> DataFrame:
    """lines with file and status of messages that have them; others are left out."""
    rows = lines.filter(F.col(column).rlike(LOG_LINE))
    return rows.withColumns({"file": F.trim(F.regexp_extract(column, LOG_LINE, 1)), "status": F.trim(F.regexp_extract(column, LOG_LINE, 2))})


def job_record(log: DataFrame) -> DataFrame:
    """Per job: current stage and status, when it began and changed, and its history in order."""
    step = F.struct("ts", "event_id", "stage", "status")
    return log.groupBy("job_id").agg(
        F.max(step).alias("last"), F.min("ts").alias("created_at"), F.count("*").alias("n_events"), F.array_join(F.transform(F.array_sort(F.collect_list(step)), lambda s: s["status"]), ">").alias("history")
    ).select("job_id", "last.stage", "last.status", "created_at", F.col("last.ts").alias("updated_at"), "n_events", "history")


def frontier(completed: Column, start: Column | None = None) -> Column:
    """Where the next index stands after completions in this order: it moves by one, and only when
    the completed index is the next."""
    first = F.lit(0) if start is None else start
    return F.aggregate(completed, first.cast("int"), lambda next_, done: F.when(done == next_, next_ + 1).otherwise(next_))


def to_retry(failed: DataFrame, done: DataFrame, key: str = "topic") -> DataFrame:
    return failed.join(done, key, "left_anti")


def orphans(topics: DataFrame, in_toc: DataFrame, done: DataFrame, key: str = "topic") -> DataFrame:
    return topics.join(in_toc, key, "left_anti").join(done, key, "left_anti")


def progress(chapters: DataFrame) -> DataFrame:
    """Per course of (course, chapter, done, failed): chapters, done, failed, and the next index."""
    order = F.transform(F.array_sort(F.collect_list(F.struct("chapter", "done"))), lambda x: x["done"])
    rows = chapters.groupBy("course").agg(F.count("*").alias("total"), F.count_if("done").alias("done"), F.count_if("failed").alias("failed"), order.alias("o"))
    return rows.select("course", "total", "done", "failed", (F.when(F.forall("o", lambda d: d), F.size("o")).otherwise(F.array_position("o", False) - 1)).cast("int").alias("next_index"))


def usage_rollup(calls: DataFrame) -> DataFrame:
    """Calls and tokens in all, by model and by purpose, as grouping sets."""
    sums = [F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "processing_ms")]
    model, purpose = F.col("model"), F.col("purpose")
    rows = calls.groupingSets([[], [model], [purpose]], model, purpose).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("calls"), *sums)
    return rows.select("model", "purpose", "level", "calls", *[c for c in ("input_tokens", "output_tokens", "processing_ms")])


def processed_totals(pages: DataFrame) -> DataFrame:
    """One row: documents and pages processed of (doc_id, status), a row per page."""
    done = F.col("status") == "COMPLETED"
    return pages.agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("pages"), F.count_distinct(F.when(done, F.col("doc_id"))).alias("documents_processed"), F.count_if(done).alias("pages_processed"))


def dominant_language(scores: DataFrame) -> DataFrame:
    """Per document of (doc_id, lang, score) the language of the highest score; the first by name in a tie."""
    best = F.min_by("lang", F.struct((-F.col("score")).alias("s"), "lang"))
    return scores.groupBy("doc_id").agg(best.alias("lang"))


def payload_status(rows: DataFrame, column: str = "payload") -> DataFrame:
    """rows with the map of their payload's lines."""
    return rows.withColumn("fields", payload_lines(F.col(column)))


EVENT = "struct<Records:array<struct<eventName:string,body:string,s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>>"


def parse_events(raw: DataFrame, column: str = "body") -> DataFrame:
    """event_name, bucket and key of each record of notifications; those that a queue delivers are
    inside its records' bodies. A body that isn't JSON is kept as raw_body."""
    outer = raw.withColumn("r", F.explode_outer(F.from_json(column, EVENT)["Records"]))
    inner = F.when(F.col("r.body").isNotNull(), F.from_json("r.body", EVENT)["Records"])
    records = F.when(F.col("r").isNull(), None).when(F.size(inner) > 0, inner).otherwise(F.array(F.col("r")))
    text = F.when(F.col("r").isNull(), F.col(column)).when(F.col("r.body").isNotNull() & inner.isNull(), F.col("r.body"))
    parsed = outer.select("event_id", text.alias("raw_body"), F.explode_outer(records).alias("rec"))
    known = parsed["raw_body"].isNull()
    return parsed.select("event_id", F.col("rec.eventName").alias("event_name"), F.col("rec.s3.bucket.name").alias("bucket"), F.url_decode("rec.s3.object.key").alias("key"), F.when(~known, F.col("raw_body")).alias("raw_body"))


def wanted_uploads(events: DataFrame, outputs: DataFrame) -> DataFrame:
    """Uploads to process: PDFs directly in uploads/, without an output yet."""
    rows = events.filter(F.col("key").startswith("uploads/") & F.lower("key").endswith(".pdf") & (F.size(F.split("key", "/")) <= 2))
    return rows.join(outputs, "key", "left_anti")


def topics_of(courses: DataFrame) -> DataFrame:
    """(course, chapter_no, chapter, topic_no, topic) of course trees (course, chapters)."""
    chapters = courses.select("course", F.posexplode("chapters").alias("chapter_no", "c"))
    return chapters.select("course", "chapter_no", F.col("c.id").alias("chapter"), F.posexplode("c.topics").alias("topic_no", "t")).select("course", "chapter_no", "chapter", "topic_no", F.col("t.id").alias("topic"))


def irregular_tables(rows: DataFrame) -> DataFrame:
    """Tables of (table_id, row, cells) with more than one row width, or with no row at all (row is
    null); not such of two rows of which the second's width is a multiple of the first's."""
    widths = F.count_distinct(F.when(F.col("row").isNotNull(), F.col("cells")))
    facts = rows.groupBy("table_id").agg(widths.alias("widths"), F.count("row").alias("n_rows"), F.min_by("cells", "row").alias("first"), F.max_by("cells", "row").alias("last"))
    two = (F.col("n_rows") == 2) & (F.col("first") > 0) & (F.col("last") > F.col("first")) & (F.col("last") % F.col("first") == 0)
    return facts.select("table_id", "widths", ((F.col("n_rows") == 0) | ((F.col("widths") > 1) & ~F.coalesce(two, F.lit(False)))).alias("irregular"))


def layout_tables(tables: DataFrame) -> DataFrame:
    """tables (table_id, rows, cells, summary) with is_layout: small ones without a summary of more
    than 40 characters."""
    told = F.length(F.trim(F.coalesce("summary", F.lit("")))) > 40
    small = ((F.col("rows") == 1) & (F.col("cells") == 1)) | ((F.col("rows") <= 2) & (F.col("cells") <= 4))
    return tables.withColumn("is_layout", ~told & small)


def unsuppressed(suspicious: DataFrame, actions: DataFrame) -> DataFrame:
    """Suspicious figures (doc_id, figure) but those into which actions (doc_id, action) put a text."""
    told = actions.select("doc_id", F.regexp_extract("action", r"^figure(\d+): added /ActualText", 1).try_cast("long").alias("figure")).filter("figure is not null")
    return suspicious.join(told.distinct(), ["doc_id", "figure"], "left_anti")


def fix_status(elements: DataFrame, history: DataFrame) -> DataFrame:
    """Per document of elements (doc_id, element_id): in all, fixed ones by the history (doc_id,
    element_id, change_no, undone), and remaining. The history is appended to: undoing adds a row."""
    now = history.groupBy("doc_id", "element_id").agg(F.max_by("undone", "change_no").alias("undone")).filter("not undone").withColumn("is_fixed", F.lit(True))
    rows = elements.select("doc_id", "element_id").distinct().join(now, ["doc_id", "element_id"], "left").groupBy("doc_id")
    return rows.agg(F.count("*").alias("total"), F.count("is_fixed").alias("fixed")).withColumn("remaining", F.col("total") - F.col("fixed"))


def standing(history: DataFrame) -> DataFrame:
    """The fixes of the history (doc_id, element_id, change_no, undone, before) that stand, each with
    place: 1 for the one that the next undo takes back.

    Fixes and undos match as last in, first out: how many fixes stand after a change is a running sum,
    which undos without a fix to take back do not lower below zero; a fix stands if that number never
    falls below its own again."""
    element = Window.partitionBy("doc_id", "element_id").orderBy("change_no")
    so_far = element.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = history.withColumn("sum", F.sum(F.when(F.col("undone"), -1).otherwise(1)).over(so_far))
    rows = rows.withColumn("depth", F.col("sum") - F.least(F.min("sum").over(so_far), F.lit(0)))
    later = F.min("depth").over(element.rowsBetween(1, Window.unboundedFollowing))
    kept = rows.withColumn("later", later).filter(~F.col("undone") & (F.col("later").isNull() | (F.col("later") >= F.col("depth"))))
    top = F.max("depth").over(Window.partitionBy("doc_id", "element_id"))
    return kept.withColumn("place", (top - F.col("depth") + 1).cast("int")).drop("sum", "depth", "later")


def undo(history: DataFrame, times: int = 1) -> DataFrame:
    """Rows to append that undo each element's last changes that stand, as many as times: doc_id,
    element_id, change_no, undone, html (what was there before that change). The last of them has the
    text before the times-th last change."""
    last = history.groupBy("doc_id", "element_id").agg(F.max("change_no").alias("n"))
    back = standing(history).filter(F.col("place") <= times).join(last, ["doc_id", "element_id"])
    return back.select("doc_id", "element_id", (F.col("n") + F.col("place")).alias("change_no"), F.lit(True).alias("undone"), F.col("before").alias("html"))


def ambiguous_glyphs(pairs: DataFrame) -> DataFrame:
    """Per font of (font, src, dst): codes of at most four digits that share their letter with another."""
    return pairs.filter(F.length("src") <= 4).groupBy("font").agg((F.count("*") - F.count_distinct("dst")).alias("ambiguous"))


def unmatched_marks(marks: DataFrame, structure: DataFrame) -> DataFrame:
    """Marks of pages (doc_id, page, mcid) that no structure element names."""
    return marks.join(structure, ["doc_id", "page", "mcid"], "left_anti")


def struct_audit(nodes: DataFrame) -> DataFrame:
    """Per document of structure nodes (doc_id, kind, index, alt, summary, ths): counts and indices."""
    is_figure, is_table = F.col("kind") == "Figure", F.col("kind") == "Table"
    listed = F.sort_array(F.collect_list(F.when(is_figure & (F.trim(F.coalesce("alt", F.lit(""))) == ""), F.col("index"))))
    return nodes.groupBy("doc_id").agg(
        F.count_if(is_figure).alias("figures"), F.array_join(listed.cast("array<string>"), ",").alias("figures_without_alt"), F.count_if(is_table).alias("tables"),
        F.count_if(is_table & F.col("summary").isNull()).alias("tables_without_summary"), F.count_if(is_table & (F.coalesce("ths", F.lit(0)) == 0)).alias("tables_without_th"),
    )


def grouped_names(controls: DataFrame) -> DataFrame:
    """Groups of controls (doc_id, name) with the same part before the first underscore, of two and more."""
    return controls.groupBy("doc_id", F.substring_index("name", "_", 1).alias("prefix")).agg(F.count("*").alias("n")).filter("n >= 2")
