"""License scans: an Aho-Corasick automaton over words and tags, and expressions by shunting yard.

A text's words, joined by single spaces, go once through an automaton of all phrases, which end at
spaces, so that a match is a place where a phrase's words stand consecutively. A second automaton
finds identifier tags; what follows one on its line is read as a licence expression. A shunting yard
orders its operators (with before and before or, parentheses first) and evaluates the result: "or"
leaves a choice, "and" binds to both, "with" adds an exception to one licence. The expression ends
where the text can't go on as one; its longest prefix that is whole counts.

A text's score is the strength of what was found: 1 for an expression, NOTICE for a phrase, MENTION
for a word that only speaks of licences, 0 for nothing.

Each text is read whole, by one map over Arrow batches; nothing is shuffled.

Defined cases: null and empty texts have no words, labels or places and a score of 0; rows that
repeat are scanned one by one; matches that overlap all count; an unknown identifier ends an
expression, and a tag without an expression adds nothing; an empty table gives an empty result;
further columns, whatever their names, have no influence.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, pick, position, small_batches, texts

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further phrases by which notices name a licence, and words that speak of licences.
NOTICES = {
    "permission is hereby granted free of charge": "mit", "licensed under the apache": "apache", "lesser general public license": "lgpl", "affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "isc license": "isc",
    "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0",
    "creative commons attribution": "cc-by", "dedicated to the public domain": "public-domain", "all rights reserved": "proprietary",
}
MENTIONS = ("license", "licence", "licensed", "copyright")
# Tags before an expression, and the beginnings of identifiers with their labels.
TAGS = ("spdx-license-identifier:", "license-expression:")
IDENTIFIERS = {
    "mit": "mit", "apache-": "apache", "gpl-": "gpl", "lgpl-": "lgpl", "agpl-": "agpl", "mpl-": "mpl", "epl-": "epl", "bsd-": "bsd", "isc": "isc", "zlib": "zlib", "unlicense": "public-domain",
    "cc0-": "cc0", "cc-by-": "cc-by", "cc-by-sa-": "cc-by-sa", "cc-by-nc-": "cc-by-nc", "cc-by-nd-": "cc-by-nd", "cc-by-nc-sa-": "cc-by-nc-sa", "cc-by-nc-nd-": "cc-by-nc-nd",
}
PERMISSIVE = ("mit", "apache", "bsd", "isc", "zlib", "public-domain", "cc0", "cc-by")
EXCEPTION = r"[a-z0-9.-]+-exception[a-z0-9.-]*"
NOTICE, MENTION = 0.9, 0.3

TOKEN = re.compile(r"[()]|[a-z0-9.+-]+|[^\x20\t]")
# what separates words: ASCII but digits and letters
_BLANK = bytes(32 if b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) else b for b in bytes(range(256)).lower())
_FULL = re.compile(r"(?:" + "|".join(re.escape(k) + (r"[0-9][a-z0-9.+-]*" if k.endswith("-") else "") for k in sorted(IDENTIFIERS, key=len, reverse=True)) + ")")


def label_of(identifier: str) -> str | None:
    """The label of a licence identifier in lower case: by its name, or its name and a version."""
    if not _FULL.fullmatch(identifier):
        return None
    return IDENTIFIERS[max((k for k in IDENTIFIERS if identifier.startswith(k)), key=len)]


class Expression(NamedTuple):
    """labels of the licences named; canonical, with parentheses around every pair; permissive, if
    one may choose to be bound by permissive licences alone."""

    text: str
    labels: tuple[str, ...]
    canonical: str
    permissive: bool


RANK = {"or": 1, "and": 2, "with": 3}


def _apply(op: str, operands: list[tuple[str, bool]]) -> None:
    (right, b), (left, a) = operands.pop(), operands.pop()
    # an exception lifts duties but makes no licence permissive that isn't
    operands.append((f"({left} {op} {right})", (a or b) if op == "or" else (a and b) if op == "and" else a))


def _evaluated(tokens: list[str]) -> tuple[str, bool]:
    """The shunting yard over a whole expression's tokens."""
    operands: list[tuple[str, bool]] = []
    ops: list[str] = []
    for t in tokens:
        if t == "(":
            ops.append(t)
        elif t == ")":
            while ops[-1] != "(":
                _apply(ops.pop(), operands)
            ops.pop()
        elif t in RANK:
            while ops and ops[-1] != "(" and RANK[ops[-1]] >= RANK[t]:
                _apply(ops.pop(), operands)
            ops.append(t)
        else:
            operands.append((t, label_of(t) in PERMISSIVE))
    while ops:
        _apply(ops.pop(), operands)
    return operands[0]


def parsed(line: str) -> Expression | None:
    """The longest expression that line, in lower case, begins with."""
    tokens, whole, end, depth, expect = [], 0, 0, 0, "licence"
    for m in TOKEN.finditer(line):
        t = m[0]
        if expect == "licence":
            if t == "(":
                depth += 1
            elif label_of(t):
                expect = "any"
            else:
                break
        elif expect == "exception":
            if not re.fullmatch(EXCEPTION, t):
                break
            expect = "operator"
        elif t in ("and", "or"):
            expect = "licence"
        elif t == "with" and expect == "any":
            expect = "exception"
        elif t == ")" and depth:
            depth, expect = depth - 1, "operator"
        else:
            break
        tokens.append(t)
        if not depth and expect in ("any", "operator"):
            whole, end = len(tokens), m.end()
    if not whole:
        return None
    canonical, permissive = _evaluated(tokens[:whole])
    labels = [label_of(t) for t in tokens[:whole]]
    return Expression(line[:end].strip(), tuple(sorted({x for x in labels if x})), canonical, permissive)


class Scan(NamedTuple):
    n_words: int
    places: list[tuple[int, str]]  # first word and phrase, base ones and notices
    expressions: list[Expression]
    mentions: bool


def scanner() -> Callable[[bytes | None], Scan]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase in (*BASE, *NOTICES, *MENTIONS):
        phrases.add_word(f" {phrase} ", phrase)
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()

    def scan(text: bytes | None) -> Scan:
        low = (text or b"").lower()
        words = low.translate(_BLANK).split()
        line = f" {b' '.join(words).decode()} "
        found = sorted((end - len(phrase) - 1, phrase) for end, phrase in phrases.iter(line))
        places, at, word, mentions = [], 0, 0, False
        for begin, phrase in found:
            word += line.count(" ", at, begin)
            at = begin
            if phrase in BASE or phrase in NOTICES:
                places.append((word, phrase))
            else:
                mentions = True
        expressions = []
        if any(tag.encode() in low for tag in TAGS):
            plain = low.decode()
            for end, _ in tags.iter(plain):
                rest = re.compile("[^\r\n]*").match(plain, end + 1)[0]
                if (e := parsed(rest)) is not None:
                    expressions.append(e)
        return Scan(len(words), places, expressions, mentions)

    return scan


MATCH = (
    "n_words long, places array<struct<word:long,phrase:string,label:string,base:boolean>>,"
    "expressions array<struct<text:string,labels:array<string>,canonical:string,permissive:boolean>>, mentions boolean"
)
_PLACES = pa.list_(pa.struct([("word", pa.int64()), ("phrase", pa.string()), ("label", pa.string()), ("base", pa.bool_())]))
_EXPRESSIONS = pa.list_(pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("canonical", pa.string()), ("permissive", pa.bool_())]))


def licences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs, with their other columns as c0, c1, ..., their words, places of phrases, and
    expressions."""
    small_batches(docs.sparkSession)
    plain, names = numbered(docs)
    text = names[position(docs, text_col)]
    kept = [n for n in names if n != text]
    kinds = {f.name: f.dataType.simpleString() for f in plain.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            found = [scan(t) for t in texts(batch, text)]
            places = [[{"word": w, "phrase": p, "label": BASE.get(p) or NOTICES[p], "base": p in BASE} for w, p in s.places] for s in found]
            expressions = [[e._asdict() for e in s.expressions] for s in found]
            made = [pa.array([s.n_words for s in found], pa.int64()), pa.array(places, _PLACES), pa.array(expressions, _EXPRESSIONS), pa.array([s.mentions for s in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in kept], *made], names=[*kept, "n_words", "places", "expressions", "mentions"])

    schema = ", ".join([*[f"{n} {kinds[n]}" for n in kept], MATCH])
    return plain.select(*kept, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


def _joined(labels: Column) -> Column:
    return F.array_join(F.sort_array(F.array_distinct(labels)), ",")


def licence_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_expressions."""
    rows = licences(pick(docs, id_col, text_col).toDF("doc_id", "text"), "text").withColumnRenamed("c0", "doc_id")
    base = F.filter("places", lambda p: p["base"])
    named = F.concat(F.transform("places", lambda p: p["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))
    words = F.transform(base, lambda p: p["word"])
    score = F.when(F.size("expressions") > 0, 1.0).when(F.size("places") > 0, NOTICE).when(F.col("mentions"), MENTION).otherwise(0.0)
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        _joined(F.transform(base, lambda p: p["label"])).alias("base_labels"), _joined(named).alias("labels"), score.cast("double").alias("score"), F.size("expressions").cast("long").alias("n_expressions"),
    )


def _places(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"ws[i + {k}] = '{w}'" if k else f"ws[i] = '{w}'" for k, w in enumerate(words))
    return f"list_filter(range(1, len(ws) - {len(words) - 2}), lambda i: {same})"


_ALL = {**BASE, **NOTICES}
_LABEL = "CASE " + " ".join(f"WHEN regexp_full_match(tok, '{re.escape(k)}{'[0-9][a-z0-9.+-]*' if k.endswith('-') else ''}') THEN '{v}'" for k, v in sorted(IDENTIFIERS.items(), key=lambda x: -len(x[0]))).replace("\\-", "-") + " END"
OP12_SQL = rf"""
WITH RECURSIVE
d AS (SELECT doc_id, row_number() OVER () AS row, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
p AS (SELECT *, {", ".join(f"{_places(k)} AS p{i}" for i, k in enumerate(_ALL))} FROM w),
x AS (SELECT row, unnest(regexp_extract_all(t, '(?:{"|".join(TAGS)})([^\r\n]*)', 1)) AS line, generate_subscripts(regexp_extract_all(t, '(?:{"|".join(TAGS)})([^\r\n]*)', 1), 1) AS tag FROM d),
k AS (SELECT row, tag, i, tok, {_LABEL} AS label, tok SIMILAR TO '{EXCEPTION}' AS exception FROM (
        SELECT row, tag, unnest(regexp_extract_all(line, '[()]|[a-z0-9.+-]+|[^\x20\t]')) AS tok, generate_subscripts(regexp_extract_all(line, '[()]|[a-z0-9.+-]+|[^\x20\t]'), 1) AS i FROM x)),
s(row, tag, i, depth, expect, seen, good) AS (
  SELECT row, tag, CAST(0 AS BIGINT), 0, 'licence', CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR[]) FROM x UNION ALL
  SELECT row, tag, i, depth, expect, seen, CASE WHEN depth = 0 AND expect IN ('any', 'operator') THEN seen ELSE good END FROM (
    SELECT s.row, s.tag, k.i, s.depth + CASE k.tok WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END AS depth, good,
           CASE WHEN s.expect = 'licence' AND k.tok = '(' THEN 'licence' WHEN s.expect = 'licence' AND k.label IS NOT NULL THEN 'any' WHEN s.expect = 'exception' AND k.exception THEN 'operator'
                WHEN s.expect IN ('any', 'operator') AND k.tok IN ('and', 'or') THEN 'licence' WHEN s.expect = 'any' AND k.tok = 'with' THEN 'exception'
                WHEN s.expect IN ('any', 'operator') AND k.tok = ')' AND s.depth > 0 THEN 'operator' END AS expect,
           CASE WHEN s.expect = 'licence' AND k.label IS NOT NULL THEN list_append(seen, k.label) ELSE seen END AS seen
    FROM s JOIN k ON k.row = s.row AND k.tag = s.tag AND k.i = s.i + 1) WHERE expect IS NOT NULL),
e AS (SELECT row, tag, arg_max(good, i) AS labels FROM s GROUP BY row, tag HAVING arg_max(good, i) IS NOT NULL),
y AS (SELECT row, count(*) AS n, flatten(list(labels)) AS labels FROM e GROUP BY row),
b AS (SELECT p.*, coalesce(y.n, 0) AS n_expressions, list_concat(p0, p1, p2) AS base, list_concat({", ".join(f"p{i}" for i in range(len(_ALL)))}) AS every,
        list_concat({", ".join(f"CASE WHEN len(p{i}) > 0 THEN ['{v}'] ELSE [] END" for i, v in enumerate(_ALL.values()))}, coalesce(y.labels, [])) AS named FROM p LEFT JOIN y ON y.row = p.row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(base) AS BIGINT) AS n_base, list_min(base) - 1 AS first_word, list_max(base) - 1 AS last_word,
       concat_ws(',', {", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{v}' END" for v, i in sorted((v, i) for i, v in enumerate(BASE.values())))}) AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(named)), ','), '') AS labels,
       CAST(CASE WHEN n_expressions > 0 THEN 1.0 WHEN len(every) > 0 THEN {NOTICE} WHEN list_has_any(ws, {list(MENTIONS)}) THEN {MENTION} ELSE 0.0 END AS DOUBLE) AS score, CAST(n_expressions AS BIGINT) AS n_expressions
FROM b
"""
