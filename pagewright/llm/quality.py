"""Quality rules: a threshold table compiled into one Spark projection.

A Threshold names a measure and the range in which it must lie. compile_rules() turns the table
into expressions over measures that are built-in functions of the text alone, so that rules run
inside one map-only projection: no shuffle, no join, no user function. Repeated word windows are
found within the row: word hashes are folded pairwise into 2-, 4- and 8-word hashes (64 bits), and
only texts in which two windows agree sort them to count the words that they cover.

Defined cases: a table without a lang column, a null lang and any other language than the four leave
the stop words out; null and blank texts have no words, fail the base rule and are rejected; rows that
repeat are judged one by one; texts are read whole whatever their length; an empty table gives an
empty result; further columns have no influence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, numbered, pick, position

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be at by this have from or an not"
    " le la les de des et un une est que qui dans pour pas sur du au par"
    " der die das und den von zu mit ist ein eine nicht im auf für dem"
    " el los las y en que del se por con una su para es no lo"
).split()

# The codes of those languages.
STOP_LANGS = ("en", "fr", "de", "es")

WINDOW = 8


@dataclass(frozen=True)
class Threshold:
    """A measure must be at least least and at most most (None: no bound). A rule applies to texts
    of from words words on, and where the measure is not null."""

    measure: str
    least: float | None = None
    most: float | None = None
    words: int = 0


#: The method's table. base_failed is judged before it; these bounds catch what no prose in any of
#: the languages comes near: word lengths, symbols, lines and function words. The stop words are of
#: four languages in Latin script; texts mainly in other scripts are not held to them.
THRESHOLDS = (
    Threshold("n_words", 20),
    Threshold("mean_word_chars", 2.0, 15.0),
    Threshold("symbols_per_word", None, 0.30),
    Threshold("dup_line_share", None, 0.50),
    Threshold("bullet_line_share", None, 0.90),
    Threshold("ellipsis_line_share", None, 0.50),
    Threshold("letter_runs_per_word", 0.50, None),
    Threshold("stop_words", 1, None, 60),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _stop_words(lang: Column) -> Column:
    """Different stop words of the text; null where lang isn't one of their languages (its part before
    the first hyphen or underscore counts)."""
    return F.when(F.lower(F.regexp_extract(lang.cast("string"), "^[A-Za-z]*", 0)).isin(*STOP_LANGS), F.col("q_stops"))


def measured(rows: DataFrame, text: str, lang: Column, keep: list[str]) -> DataFrame:
    """keep and the measures of the text column, in the language lang. The selects are one projection when planned, or
    few where Spark avoids computing an expression twice."""
    step = rows.select(*keep, lang.alias("q_lang"), F.coalesce(F.col(text), F.lit("")).alias("q_text"))
    step = step.withColumns({"q_words": F.filter(F.split("q_text", WHITE, -1), lambda w: w != ""), "q_lines": F.filter(F.split("q_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    step = step.withColumn("q_stops", F.size(F.array_intersect("q_words", F.array(*map(F.lit, dict.fromkeys(STOP_WORDS))))))
    n = F.size("q_words")
    dots = F.col("q_text").contains("...") | F.col("q_text").contains("…")
    step = step.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("q_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.size("q_lines").alias("q_n_lines"),
        F.size(F.filter("q_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*(?:[-*•‣▪◦]|[0-9]{1,3}[.)])[\x20\x09-\x0D]"))).alias("q_bullets"),
        F.when(dots, F.size(F.filter("q_lines", lambda x: x.rlike(r"(?:\.\.\.|…)[\x20\x09-\x0D]*$")))).otherwise(0).alias("q_ellipses"),
        F.regexp_count("q_text", F.lit(r"\p{L}+")).alias("q_letter_runs"),
        _stop_words(F.col("q_lang")).alias("stop_words"),
        F.transform("q_words", lambda w: F.xxhash64(w)).alias("q_windows"),
    )
    fold, others = 1, [c for c in step.columns if c != "q_windows"]
    while fold < WINDOW:  # each fold in a select of its own, so that no array is computed twice
        later = F.slice("q_windows", fold + 1, 1 << 30)
        step = step.select(*others, F.zip_with("q_windows", later, lambda a, b: F.xxhash64(a, b)).alias("q_windows"))
        fold *= 2
    step = step.withColumn("q_windows", F.slice("q_windows", F.lit(1), F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(0))))
    tied = F.size(F.array_distinct("q_windows")) < F.size("q_windows")
    ordered = F.sort_array(F.transform("q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("q_sorted", F.when(tied, ordered))
    after = F.slice("q_sorted", 2, 1 << 30)
    before = F.concat(F.slice("q_sorted", 1, 1), F.col("q_sorted"))
    alike = F.zip_with(F.zip_with("q_sorted", after, lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), (a["h"] == b["h"]).alias("next"))), before, lambda a, b: F.struct(a["i"].alias("i"), (F.coalesce(a["next"], F.lit(False)) | ((a["h"] == b["h"]) & (a["i"] != b["i"]))).alias("twice")))
    places = F.sort_array(F.transform(F.filter(alike, lambda x: x["i"].isNotNull() & x["twice"]), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + WINDOW).alias("end"), (acc["n"] + F.least(F.lit(WINDOW), i + WINDOW - acc["end"])).alias("n")),
        lambda acc: acc["n"],
    )
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("q_n_lines"), F.lit(1))
    return step.select(
        *keep,
        *BASE[:4],
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.col("word_chars") / words).alias("mean_word_chars"),
        (F.col("n_symbols") / words).alias("symbols_per_word"),
        (F.col("n_dup_lines") / lines).alias("dup_line_share"),
        (F.col("q_bullets") / lines).alias("bullet_line_share"),
        (F.col("q_ellipses") / lines).alias("ellipsis_line_share"),
        (F.col("q_letter_runs") / words).alias("letter_runs_per_word"),
        "stop_words",
    )


def compile_rules(table: tuple[Threshold, ...] = THRESHOLDS) -> Column:
    """True where every threshold holds."""
    verdict = F.lit(True)
    for t in table:
        held = F.lit(True)
        if t.least is not None:
            held = held & (F.col(t.measure) >= t.least)
        if t.most is not None:
            held = held & (F.col(t.measure) <= t.most)
        held = held if not t.words else held | (F.col("n_words") < t.words)
        verdict = verdict & F.coalesce(held, F.lit(True))
    return verdict


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _with_lang(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    if lang_col.lower() in (c.lower() for c in docs.columns):
        return pick(docs, id_col, text_col, lang_col).toDF("doc_id", "text", "lang")
    return pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("lang", F.lit(None).cast("string"))


def quality_report(docs: DataFrame, table: tuple[Threshold, ...] = THRESHOLDS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, the base measures, base_failed, kept, and the table's ratios, for each row."""
    rows = measured(_with_lang(docs, id_col, text_col, lang_col), "text", F.col("lang"), ["doc_id"])
    ratios = [t.measure for t in table if t.measure not in BASE]
    return rows.select("doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & compile_rules(table)).alias("kept"), *dict.fromkeys(ratios))


def of_quality(docs: DataFrame, table: tuple[Threshold, ...] = THRESHOLDS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    plain, names = numbered(docs)
    lang = F.col(f"c{position(docs, lang_col)}") if lang_col.lower() in (c.lower() for c in docs.columns) else F.lit(None).cast("string")
    rows = measured(plain, f"c{position(docs, text_col)}", lang, names)
    # a row number that the filter reads keeps the optimizer from moving the filter below the folds,
    # where every array would be computed again for each use of it
    judged = rows.select(*names, (~base_failed() & compile_rules(table)).alias("q_kept"), F.monotonically_increasing_id().alias("q_row"))
    return judged.filter("q_kept and q_row >= 0").select(*names).toDF(*docs.columns)
