"""A document's pages as one page."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.operators.remediate import Document
from pagewright.sources.html_tree import Node

# Fixed value: the rules for the classes of a combined document.
STYLE = (
    ".page-break { page-break-after: always; margin-bottom: 30px; border-bottom: 1px dashed #ccc; padding-bottom: 30px; }"
    " .page-container { margin-bottom: 2em; }"
    " .page-title { margin-top: 1em; padding-top: 1em; border-top: 1px solid #eee; font-size: 1.5em; color: #333; }"
)


def page_parts(pages: DataFrame) -> DataFrame:
    """doc_id, page, head, content: of each page (doc_id, page, html) its head's markup and that of the
    elements in its body; text that stands in the body by itself is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html in batch.column(2).to_pylist():
                d = Document(html or "")
                head, body = d.first("head"), d.first("body")
                out.append((d.markup(head.kids) if head else "", d.markup([k for k in body.kids if isinstance(k, Node)]) if body else ""))
            heads, contents = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, pa.string()), pa.array(contents, pa.string())], names=["doc_id", "page", "head", "content"])

    rows = pages.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("page").cast("long").alias("page"), "html")
    return rows.mapInArrow(run, "doc_id long, page long, head string, content string")


def combined_documents(pages: DataFrame) -> DataFrame:
    """doc_id, pages, html: per document of (doc_id, page, html) one page, with the first page's head, a
    titled container for each page in order, and a break between each two."""
    order = Window.partitionBy("doc_id").orderBy("page")
    numbered = page_parts(pages).withColumn("no", F.row_number().over(order))
    no = F.col("no").cast("string")
    box = F.concat(F.lit('<div class="page-container" id="page-'), no, F.lit('"><h2 class="page-title">Page '), no, F.lit("</h2>"), "content", F.lit("</div>"))
    rows = numbered.groupBy("doc_id").agg(F.count("*").alias("pages"), F.min_by("head", "no").alias("head"), F.array_sort(F.collect_list(F.struct("no", box.alias("box")))).alias("boxes"))
    body = F.array_join(F.transform("boxes", lambda x: x["box"]), '<div class="page-break"></div>')
    return rows.select("doc_id", "pages", F.concat(F.lit("<html><head>"), "head", F.lit(f"<style>{STYLE}</style></head><body>"), body, F.lit("</body></html>")).alias("html"))
