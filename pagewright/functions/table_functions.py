"""Table functions for SQL texts, to be registered in a session."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, LongType, MapType, StringType, StructField, StructType

from pagewright.sources.html_tree import COLUMNS, element_rows


#: Spark's types by name; a table function is analysed where no session can parse one.
KINDS: dict[str, DataType] = {
    "long": LongType(), "int": IntegerType(), "string": StringType(), "boolean": BooleanType(), "map<string,string>": MapType(StringType(), StringType()), "array<string>": ArrayType(StringType()), "array<int>": ArrayType(IntegerType()),
}


def _names(columns: str | None) -> list[str]:
    found = [c.strip() for c in (columns or "").split(",") if c.strip()] or list(COLUMNS)
    unknown = [c for c in found if c not in COLUMNS]
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}; there are {', '.join(COLUMNS)}")
    return found


class ParseHtml:
    """parse_html(id, html, 'tag,attrs'): a row per element, with the named columns of the element table
    (all without the third argument), which alone are worked out. The schema follows from the names."""

    @staticmethod
    def analyze(doc_id: AnalyzeArgument, html: AnalyzeArgument, columns: AnalyzeArgument | None = None) -> AnalyzeResult:
        if columns is not None and not columns.isConstantExpression:
            raise ValueError("the columns of parse_html must be a constant")
        names = _names(columns.value if columns is not None else None)
        return AnalyzeResult(StructType([StructField(c, KINDS[COLUMNS[c][0]]) for c in names]))

    def eval(self, doc_id: int | None, html: str | None, columns: str | None = None) -> Iterator[tuple]:
        names = tuple(_names(columns))
        maps = [k for k, c in enumerate(names) if COLUMNS[c][0].startswith("map")]
        for row in element_rows(doc_id, html, names):
            cells = list(row)
            for k in maps:
                cells[k] = dict(cells[k])
            yield tuple(cells)


def register(spark: SparkSession) -> None:
    spark.udtf.register("parse_html", udtf(ParseHtml))
