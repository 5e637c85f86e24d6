r"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. A ledger holds, for each
blob, which rules in which version have been run and what each of them found. A scan runs only over
pairs of blob and rule version that the ledger lacks, and each distinct blob once however many paths
and versions share it; findings join back to all paths. Spans are stored under their rule's kind and
version, so a scan with other rules, or other versions, takes from a ledger what its own rules found
and nothing else. A table is scanned in INCREMENTS, each on the ledger of those before it, so that
the texts in flight are a part of the table. Only Spark's built-in functions are used.

A rule's spans are its leftmost non-overlapping matches. regexp_extract_all with the pattern
\G(gap)(match) gives each match together with the text before it, so running sums of lengths give
the positions in code points, in one pass over the text.

Defined cases: null text is the empty blob; ids may be null or repeat, each row gets its result;
matches that end at the same place or start together are ordered by start, then rule; an empty
table gives an empty result and no ledger rows; further columns have no influence. Texts of any
length are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, pick, salted_join


@dataclass(frozen=True)
class Rule:
    """A kind of secret. pattern must not match the empty string; kept are matches of which the
    part (0: all, n: group n) has at least least code points. hint is a cheap pattern that any
    text with a match contains. A changed rule gets a new version."""

    kind: str
    version: int
    pattern: str
    hint: str
    part: int = 0
    least: int = 1
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in their order.
BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "(?i)password|passwd|secret|token|api_?key", 2, 12, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", "AKIA", 0, 18, True),
    Rule("hex", 1, r"[0-9a-f]{16,}", "[0-9a-f]{16}", 0, 16, True),
)
# Further public token formats.
MORE_RULES = (
    Rule("hub", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", "-----BEGIN "),
)
RULES = BASE_RULES + MORE_RULES

#: Parts of a table that are scanned one after the other.
INCREMENTS = 2

SPANS = "array<struct<start:int,rule:string,stop:int>>"
LEDGER = f"blob binary, scanned array<string>, spans {SPANS}"


def _none() -> Column:
    return F.expr(f"cast(array() as {SPANS})")


def rule_spans(text: Column, rule: Rule) -> Column:
    """The spans of one rule in a text, as an array of struct(start, rule, stop); rule is kind@version."""
    pattern = rf"\G(?s:.*?)({rule.pattern})"
    whole, match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    tested = F.regexp_extract_all(text, F.lit(pattern), F.lit(1 + rule.part)) if rule.part else match
    found = F.arrays_zip(
        F.transform(whole, F.length).alias("step"), F.transform(match, F.length).alias("size"), F.transform(tested, F.length).alias("tested")
    )

    def add(acc: Column, x: Column) -> Column:
        stop = acc["at"] + x["step"]
        span = F.struct((stop - x["size"]).alias("start"), F.lit(rule.name).alias("rule"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(x["tested"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(found, F.struct(F.lit(0).alias("at"), _none().alias("spans")), add, lambda acc: acc["spans"])
    return F.when(text.rlike(rule.hint), spans).otherwise(_none())


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows for versions (blob, text): each distinct blob once, with the rules it lacks."""
    names = [r.name for r in rules]
    blobs = versions.dropDuplicates(["blob"])  # combines in each task, so that copies do not gather
    if ledger is not None:
        seen = ledger.select("blob", F.explode("scanned").alias("r")).filter(F.col("r").isin(names)).groupBy("blob").agg(F.collect_set("r").alias("seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.expr("cast(array() as array<string>)"))).filter(F.size("seen") < len(names))
    else:
        blobs = blobs.withColumn("seen", F.expr("cast(array() as array<string>)"))
    missing = [~F.array_contains("seen", r.name) for r in rules]
    found = [F.when(m, rule_spans(F.col("text"), r)).otherwise(_none()) for r, m in zip(rules, missing, strict=True)]
    scanned = F.array_compact(F.array(*[F.when(m, F.lit(r.name)) for r, m in zip(rules, missing, strict=True)]))
    return blobs.select("blob", scanned.alias("scanned"), F.concat(*found).alias("spans"))


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", increments: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(path, blob, spans) for every row, and the ledger rows to append. Spans are ordered by start,
    then by their rule's place in rules; rules may differ from those of the ledger in any way."""
    addressed = pick(docs, id_col, text_col).toDF("path", "text").withColumn("text", F.coalesce("text", F.lit("")))
    addressed = addressed.withColumn("blob", F.unhex(F.sha2("text", 256)))
    paths = durable(addressed.select("path", "blob"), "blob-paths")
    new: DataFrame | None = None
    for k in range(increments):
        part = addressed.filter(F.pmod(F.xxhash64("path"), F.lit(increments)) == k) if increments > 1 else addressed
        before = ledger if new is None else new if ledger is None else ledger.select("blob", "scanned", "spans").unionByName(new)
        rows = durable(scan_unseen(part.select("blob", "text"), before, rules), "blob-ledger")
        new = rows if new is None else new.unionByName(rows)
    names = [r.name for r in rules]
    every = new if ledger is None else ledger.select("blob", "scanned", "spans").unionByName(new)
    number = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    mine = every.select("blob", F.explode("spans").alias("s")).filter(F.col("s.rule").isin(names))
    numbered = F.struct(F.col("s.start").alias("start"), number[F.col("s.rule")].alias("rule"), F.col("s.stop").alias("stop"))
    # a blob may have been scanned with one rule in two ledgers; its spans are the same and count once
    found = mine.groupBy("blob").agg(F.array_sort(F.collect_set(numbered)).alias("spans"))
    joined = salted_join(paths, found, ["blob"], F.xxhash64("path", F.monotonically_increasing_id()))
    return joined.select("path", "blob", F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,rule:int,stop:int>>)")).alias("spans")), new


def written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"], s["stop"])), ",")


def secrets_report(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans, for each document."""
    found, _ = scan(docs, ledger, rules, increments=INCREMENTS)
    base = [i for i, r in enumerate(rules) if r.base]

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == number)).cast("long")

    return found.select(
        F.col("path").alias("doc_id"),
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(rules) if r.base],
        F.sha2(written(F.filter("spans", lambda s: s["rule"].isin(base)), rules), 256).alias("base_sha256"),
        written(F.col("spans"), rules).alias("spans"),
    )
