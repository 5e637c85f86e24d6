"""Text rules as Column expressions: alt texts, names, slugs, estimates, replies of models."""

from __future__ import annotations

import difflib
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# What the alt-text rules look for.
TRUNCATED_LIST = r"(?i)(?:stages?|steps?|phases?|parts?|points?|items?|types?|examples?|diagrams?)\s*:\s*\d+\s*$"
TRUNCATED_DIGIT = r":\s*\d+\s*$"
TABLE_PREFIX = r"(?i)^(?:a )?table(?: with| showing| describing| of)\b"
TABLE_COLUMNS = r"(?i)columns?(?: are)?(?: labeled| labelled| include)"
EQUATION_WORDS = ("equals", "subscript", "superscript", "open parenthesis", "close parenthesis", "to the power of", "divided by")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def is_equation(text: Column) -> Column:
    return F.lower(text).rlike("|".join(EQUATION_WORDS))


def alt_reasons(alt: Column, classes: Column) -> Column:
    """Why a figure's alt text looks incomplete or wrong, as an array; empty for blank text."""
    text = strip(F.coalesce(alt, F.lit("")))
    classes = F.coalesce(classes, F.expr("cast(array() as array<string>)"))
    truncated = F.when(text.rlike(TRUNCATED_LIST), "truncated_list_enumeration").when(text.rlike(TRUNCATED_DIGIT) & (F.length(text) < 200), "truncated_colon_digit")
    formula = F.exists(classes, lambda c: c.contains("inlineFormula")) & (F.length(text) < 80) & ~is_equation(text)
    tabular = text.rlike(TABLE_PREFIX) | (text.rlike(TABLE_COLUMNS) & text.rlike(r"(?i)\brows?\b"))
    whole = (text.rlike(TABLE_COLUMNS) & (F.length(text) >= 150)) | (text.rlike(TABLE_PREFIX) & (F.length(text) >= 200))
    table = tabular & ~whole & ~F.exists(classes, lambda c: c.contains("table-figure-reverted"))
    found = F.array_compact(F.array(truncated, F.when(formula, "inline_formula_caption_only"), F.when(table, "table_tagged_as_figure")))
    return F.when(text == "", F.expr("cast(array() as array<string>)")).otherwise(found)


def clean_alt(alt: Column) -> Column:
    """Without quotes around, an "image of" at the start and full stops at the end; first letter upper."""
    text = strip(F.regexp_replace(strip(alt), r"^[\"']+|[\"']+$", ""))
    text = F.regexp_replace(text, r"(?i)^(?:an? )?(?:image|picture|photo|photograph|graphic) (?:of|showing|depicting)\s+", "")
    text = F.regexp_replace(text, r"\.+$", "")
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))


# Fixed value: the tokens that an image adds to a call.
IMAGE_TOKENS = 1000


def token_estimate(text: Column, images: Column | int = 0) -> Column:
    """A quarter of the characters, at least 1, 0 for empty text; and IMAGE_TOKENS for each image."""
    n = F.length(F.coalesce(text, F.lit("")))
    return F.when(n > 0, F.greatest(F.lit(1), F.floor(n / 4).cast("int"))).otherwise(0) + IMAGE_TOKENS * (F.lit(images) if isinstance(images, int) else images)


def header_key(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"\s+", " "), "[^a-z0-9 ]", ""))


def header_id(text: Column, index: Column) -> Column:
    slug = F.regexp_replace(F.lower(F.substring(text, 1, 20)), "[^a-z0-9]", "-")
    return F.when(slug.rlike("^[a-z]"), F.concat(F.lit("th-"), slug)).otherwise(F.concat(F.lit("header-"), index.cast("string")))


def scope_of(in_head: Column, row: Column, column: Column, attrs: Column | None = None) -> Column:
    """col or row, by the cell's place, else by what its role and classes say, else col."""
    role, classes = (F.lower(F.coalesce(attrs[k], F.lit(""))) if attrs is not None else F.lit("") for k in ("role", "class"))
    told = F.when(role.contains("rowheader") | classes.rlike("row-?header"), "row")
    return F.when(in_head, "col").when(row == 0, "col").when(column == 0, "row").otherwise(F.coalesce(told, F.lit("col")))


def domain(url: Column) -> Column:
    return F.regexp_extract(url, r"https?://(?:www\.)?([^/]+)", 1)


def safe_name(name: Column) -> Column:
    """Spaces to underscores, runs of these to one, other special characters away, trimmed of them."""
    text = F.regexp_replace(F.regexp_replace(name, " ", "_"), "_+", "_")
    text = F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9_.-]", ""), "^_+|_+$", "")
    return F.when(text == "", "document").otherwise(text)


def natural_key(name: Column) -> Column:
    """An array to sort by: the parts of a name, its digit runs as numbers, the others as they are."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.transform(parts, lambda x: F.struct(F.when(x.rlike(r"^\d"), x.try_cast("decimal(38,0)")).alias("number"), F.when(x.rlike(r"^\D"), x).alias("letters")))


def common_prefix(least: Column, most: Column) -> Column:
    """What all names of a group begin with, from its least and its greatest lower-case name, which
    begin alike only as far as all do; empty unless longer than 3 characters."""
    shared = F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.length(least), F.length(most)), F.lit(1))), lambda n: F.substring(least, F.lit(1), n) == F.substring(most, F.lit(1), n))
    n = F.coalesce(F.array_max(shared), F.lit(0))
    return F.when(n > 3, F.substring(least, F.lit(1), n)).otherwise("")


def object_key(stage: Column, name: Column, extension: Column) -> Column:
    """stage/base.extension, base being the name without folder and extension."""
    base = F.regexp_replace(F.regexp_extract(name, "([^/]*)$", 1), r"\.[^.]*$", "")
    return F.concat(stage, F.lit("/"), base, F.lit("."), F.regexp_replace(extension, r"^\.", ""))


def selector(tag: Column, attrs: Column, nth: Column | None = None) -> Column:
    """A CSS selector: by id, else by classes, else by the first data attribute, else by an image's
    file, else by its place among its like (from the second on)."""
    data = F.filter(F.map_entries(attrs), lambda x: x["key"].startswith("data-"))
    classes = F.array_join(F.filter(F.split(F.coalesce(attrs["class"], F.lit("")), r"\s+"), lambda c: c != ""), ".")
    source = F.regexp_extract(F.coalesce(attrs["src"], F.lit("")), "([^/]*)$", 1)
    place = F.lit(None).cast("string") if nth is None else F.when(nth > 1, F.concat(tag, F.lit(":nth-of-type("), nth.cast("string"), F.lit(")")))
    return F.coalesce(
        F.when(F.coalesce(attrs["id"], F.lit("")) != "", F.concat(tag, F.lit("#"), attrs["id"])),
        F.when(classes != "", F.concat(tag, F.lit("."), classes)),
        F.when(F.size(data) > 0, F.concat(tag, F.lit("["), F.get(data, F.lit(0))["key"], F.lit("='"), F.get(data, F.lit(0))["value"], F.lit("']"))),
        F.when((tag == "img") & (F.coalesce(attrs["src"], F.lit("")) != ""), F.concat(tag, F.lit("[src$='"), source, F.lit("']"))),
        place,
        tag,
    )


def payload_lines(payload: Column) -> Column:
    """The lines "Key: value" of a payload as a map, and the last other line under Status."""
    lines = F.filter(F.transform(F.split(payload, "\n", -1), strip), lambda x: x != "")
    pairs, others = F.filter(lines, lambda x: x.contains(": ")), F.filter(lines, lambda x: ~x.contains(": "))
    entries = F.transform(pairs, lambda x: F.struct(F.trim(F.regexp_extract(x, "^(.*?): ", 1)).alias("key"), F.trim(F.regexp_replace(x, "^.*?: ", "")).alias("value")))
    told = F.when(F.size(others) > 0, F.array(F.struct(F.lit("Status").alias("key"), F.element_at(others, -1).alias("value")))).otherwise(F.slice(entries, 1, 0))
    # the last line of a key counts
    every = F.concat(entries, told)
    return F.map_from_entries(F.filter(every, lambda x, i: ~F.exists(F.slice(every, i + 2, F.size(every)), lambda y: y["key"] == x["key"])))


# Symbols that stand for glyphs without a letter.
SYMBOLS = "□●αβ\ufffd"


def needs_encoding_repair(text: Column) -> Column:
    """True for a text with such a symbol, or a short one with a letter between colons."""
    bare = strip(F.coalesce(text, F.lit("")))
    return bare.rlike(f"[{SYMBOLS}]") | ((F.length(bare) <= 40) & bare.rlike(":[A-Za-z]:"))


# What stands in a list step, and how it is spoken, in this order.
SPOKEN_STEPS = (
    (r"(?i)Cl\s*-\s*", "chloride, Cl minus, "), ("(?i)Cl/", "chloride, Cl minus, "), (r"(?i)HCO\s*3\s*-\s*", "bicarbonate, H C O 3 minus, "), (r"(?i)HCO\s*3/", "bicarbonate, H C O 3 minus, "),
    (r"\[", "open bracket "), (r"\]", "close bracket "), ("!", "increased "), (r"\(\s*", "open parenthesis "), (r"\s*\)", " close parenthesis"),
)


def spoken_step(text: Column) -> Column:
    """A list step in words: its number, ions, brackets."""
    bare = strip(F.regexp_replace(text, r"\s+", " "))
    # fixed value: the minus of some fonts, as an escape or a character
    bare = F.regexp_replace(bare, r"\\320|\u00D0", " minus ")
    bare = F.regexp_replace(bare, r"^(\d+)\s*\)\s*", "Step $1. ")
    words = reduce(lambda c, k: F.regexp_replace(c, k[0], k[1]), SPOKEN_STEPS, bare)
    return F.regexp_replace(F.regexp_replace(words, r"\s+", " "), "^[ ,]+|[ ,]+$", "")


def ended_references(html: Column) -> Column:
    """Markup of which &amp;, &lt; and &gt; alone are decoded. Any other & stands for itself, also where
    HTML would take it for a reference, as that without its semicolon."""
    return F.regexp_replace(html, "&(?!(?:amp|lt|gt);)", "&amp;")


def page_number(path: Column) -> Column:
    return F.regexp_extract(path, r"(?i)page[_-]?(\d+)\.html$", 1).try_cast("int")


def merged_key(key: Column) -> Column:
    return F.regexp_replace(key, "([^/]+)$", "FINAL_$1")


def content_type(path: Column) -> Column:
    # Fixed values.
    kinds = {"html": "text/html", "htm": "text/html", "css": "text/css", "js": "application/javascript", "json": "application/json", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "svg": "image/svg+xml", "pdf": "application/pdf", "txt": "text/plain", "csv": "text/csv"}
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return reduce(lambda c, k: c.when(extension == k, kinds[k]), kinds, F.when(F.lit(False), "")).otherwise("application/octet-stream")


def job_id(bucket: Column, key: Column, at: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", bucket, key, at)), 1, 12)


def reply_map(reply: Column, key: Column | None = None) -> Column:
    """A model's reply as a map: the JSON without its fence, else what stands between the outer
    braces, else, where the key that was asked for is given, the text after that key, else null."""
    kind = "map<string,string>"
    bare = strip(F.regexp_replace(F.regexp_replace(strip(reply), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    found = F.coalesce(F.from_json(F.when(bare.startswith("{"), bare), kind), F.from_json(F.when(inner != "", inner), kind))
    if key is None:
        return found
    pattern = F.concat(F.lit('"\\Q'), key, F.lit("\\E" + r'"\s*:\s*"((?:[^"\\]|\\.)*)"'))
    told = F.call_function("regexp_extract", bare, pattern, F.lit(1))
    there = F.call_function("rlike", bare, pattern)
    return F.coalesce(found, F.when(there, F.create_map(key, F.replace(told, F.lit('\\"'), F.lit('"')))))


def title_source(first: Column, first_three: Column, pages: Column) -> Column:
    """The first page if it has 50 words or is the only one, else the first three."""
    n = F.when(strip(first) == "", 0).otherwise(F.size(F.split(strip(first), r"\s+")))
    return strip(F.when((n >= 50) | (pages == 1), first).otherwise(first_three))


# Fixed values in glyph_pairs: the keywords of character maps.
def glyph_pairs(data: Column) -> Column:
    """(src, dst) of the lines "<src> <dst>" of a character map outside its code-space ranges."""
    body = F.regexp_replace(data, r"(?s)begincodespacerange.*?endcodespacerange", "")
    src = F.regexp_extract_all(body, F.lit(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>"), F.lit(1))
    dst = F.regexp_extract_all(body, F.lit(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>"), F.lit(2))
    return F.transform(F.arrays_zip(src.alias("s"), dst.alias("d")), lambda x: F.struct(F.upper(x["s"]).alias("src"), F.decode(F.unhex(x["d"]), "UTF-16BE").alias("dst")))


# Ions as they are spoken.
SPOKEN = (("Cl-", "chloride, Cl minus"), ("HCO3-", "bicarbonate, H C O 3 minus"), (r"Na\+", "sodium, N a plus"), (r"K\+", "potassium, K plus"), (r"Ca2\+", "calcium, C a 2 plus"), ("/", " divided by "), ("-", " minus"), (r"\+", " plus"))
SPOKEN_ALONE = (("cl", "chloride, Cl"), ("hco3", "bicarbonate, H C O 3"), ("na", "sodium, N a"), ("k", "potassium, K"), ("ca", "calcium, C a"), ("glucose", "glucose"))
# Fixed value: a transporter's caption; something must stand before the two ions.
TRANSPORT = r"(?i)^(.+?)\s+([A-Za-z0-9+\-]+)-/([A-Za-z0-9+\-]+)-\s+(Antiporter|Symporter|Uniporter|Transporter|Pump|Porter)\.?$"


def spoken_formula(caption: Column) -> Column:
    """A short formula caption in words; long captions that are in words already stay."""
    text = strip(caption)

    def alone(c: Column) -> Column:
        bare = F.regexp_replace(F.trim(c), "-+$", "")
        return reduce(lambda out, k: out.when(F.lower(bare) == k[0], k[1]), SPOKEN_ALONE, F.when(F.lit(False), "")).otherwise(bare)

    before, left, right, carrier = (F.regexp_extract(text, TRANSPORT, k) for k in (1, 2, 3, 4))
    lead = F.when(F.trim(before) == "", "").otherwise(F.concat(F.trim(before), F.lit(" ")))
    exchange = F.concat(lead, carrier, F.lit(" exchanging "), alone(left), F.lit(" minus and "), alone(right), F.lit(" minus, written as "), left, F.lit(" minus divided by "), right, F.lit(" minus."))
    words = reduce(lambda c, k: F.regexp_replace(c, k[0], k[1]), SPOKEN, text)
    words = F.when(is_equation(words), words).otherwise(F.concat(words, F.lit(". Spoken formula notation for inline chemistry text.")))
    return F.when((text == "") | (is_equation(text) & (F.length(text) >= 40)), text).when(text.rlike(TRANSPORT), exchange).otherwise(F.trim(F.regexp_replace(words, r"\s+", " ")))


def prose_headers(alt: Column) -> Column:
    """The quoted column names of a table told in prose."""
    part = F.regexp_extract(alt, r"(?is)columns?(?: are)?(?: labeled| labelled| include|:\s*)(.+?)(?:\.\s*(?:rows?|the first row|another row)|\.\s*$)", 1)
    return F.regexp_extract_all(part, F.lit("'([^']+)'"), F.lit(1))


# The three ways in which rows of such tables are told, each with three cells.
ORDINAL = "(?:the )?(?:first|second|third|fourth|fifth) row"
ROW_QUOTED = rf"(?is){ORDINAL} contains\s+'([^']*)'\s+under 'Transporter',\s+'([^']*)'\s+under 'Tissue Expression',\s+and\s+'([^']*)'\s+under 'Biological Role'"
ROW_UNDER = rf"(?is){ORDINAL}[^.]*?under 'Transporter'(?: is blank| says '([^']*)')[^.]*?under 'Tissue Expression'(?: it)? says '([^']*)'[^.]*?under 'Biological Role'(?: it)? says '([^']*)'"
ROW_FREE = rf"(?is)(?:another row includes|rows include|{ORDINAL} contains)\s+'?(GLUT\d+)'?\s+with tissue expression in\s+(.+?)\s+and biological role of\s+(.+?)(?=\.\s*(?:another row|$)|\.$|$)"


def prose_rows(alt: Column) -> Column:
    """The rows, arrays of three cells, of a table told in prose: of the first way that gives any."""

    def told(pattern: str, last: str = "") -> Column:
        cells = [F.regexp_extract_all(alt, F.lit(pattern), F.lit(k)) for k in (1, 2, 3)]
        rows = F.arrays_zip(*[c.alias(n) for c, n in zip(cells, "abc", strict=True)])
        return F.transform(rows, lambda x: F.array(strip(F.coalesce(x["a"], F.lit(""))), strip(x["b"]), F.regexp_replace(strip(x["c"]), last, "") if last else strip(x["c"])))

    quoted, under, free = told(ROW_QUOTED), told(ROW_UNDER), told(ROW_FREE, r"\.+$")
    return F.when(F.size(quoted) > 0, quoted).when(F.size(under) > 0, under).otherwise(free)


# Fixed value: what a normalised header is made of.
HEADER_SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def letter_counts(key: Column) -> Column:
    return F.array(*[F.length(key) - F.length(F.replace(key, F.lit(c), F.lit(""))) for c in HEADER_SIGNS])


def likeness_bound(counts: Column, other: Column, lengths: Column) -> Column:
    """Above what the ratio of two keys can't lie: twice the letters that both have, by their lengths
    together. Matching blocks are letters in common, in order; this leaves the order out."""
    common = F.aggregate(F.zip_with(counts, other, lambda a, b: F.least(a, b)), F.lit(0), lambda s, x: s + x)
    return F.when(lengths > 0, 2.0 * common / lengths).otherwise(1.0)


@F.pandas_udf(DoubleType())
def likeness(one: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(one, other, strict=True)], dtype=float)


#: How alike a header must be.
LIKE = 0.6


def header_pairs(wanted: DataFrame, headers: DataFrame, key: list[str], of: list[str]) -> DataFrame:
    """The pairs of wanted (key, of, wanted) and headers (of, header_no, header) that may be alike: with
    same, and bound of the ratio LIKE or more. All of it is in built-in functions."""
    w = wanted.select(*dict.fromkeys([*key, *of]), header_key(F.col("wanted")).alias("w")).withColumn("w_counts", letter_counts(F.col("w")))
    h = headers.select(*of, "header_no", "header", header_key(F.col("header")).alias("h")).withColumn("h_counts", letter_counts(F.col("h")))
    both = w.join(h, of).withColumn("same", F.col("w") == F.col("h"))
    return both.filter(F.col("same") | (likeness_bound(F.col("w_counts"), F.col("h_counts"), F.length("w") + F.length("h")) >= LIKE)).drop("w_counts", "h_counts")


def matched_headers(wanted: DataFrame, headers: DataFrame, key: list[str], of: list[str]) -> DataFrame:
    """For each of wanted (key, of, wanted) the header among headers (of, header_no, header) of the same
    table that equals it when normalised, the first one, else the most alike, of equals the first; null
    if none is alike. Only pairs that letters in common allow are compared in Python."""
    pairs = header_pairs(wanted, headers, key, of)
    same = pairs.filter("same").withColumn("ratio", F.lit(2.0))
    rest = pairs.filter("not same").join(same.select(*key).distinct(), key, "left_anti").withColumn("ratio", likeness("w", "h")).filter(F.col("ratio") >= LIKE)
    best = same.unionByName(rest).groupBy(*key).agg(F.max_by("header", F.struct("ratio", -F.col("header_no"))).alias("header"))
    return wanted.select(*key).join(best, key, "left")


@F.pandas_udf(StringType())
def nearest_header(wanted: pd.Series, headers: pd.Series) -> pd.Series:
    """The header that equals wanted when normalised, else the most alike (ratio 0.6 or more)."""

    def key(s: str) -> str:
        return re.sub("[^a-z0-9 ]", "", re.sub(r"\s+", " ", s.lower())).strip()

    def one(w: str | None, hs: list[str] | None) -> str | None:
        if w is None or hs is None:
            return None
        for h in hs:
            if key(h) == key(w):
                return h
        scored = [(difflib.SequenceMatcher(None, key(w), key(h)).ratio(), -i, h) for i, h in enumerate(hs)]
        best = max(scored, default=(0.0, 0, None))
        return best[2] if best[0] >= 0.6 else None

    return pd.Series([one(w, h) for w, h in zip(wanted, headers, strict=True)], dtype=object)
