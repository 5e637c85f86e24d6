"""DuckDB SQL with the rows that the queries must return, where SQL can express them."""

from __future__ import annotations

from .exact import OP4_SQL
from .licences import OP12_SQL
from .merkle import OP11_SQL
from .negatives import OP13_SQL
from .quality import STOP_LANGS, STOP_WORDS, THRESHOLDS
from .warc import OP6_SQL

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP2_SQL = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM k),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM f WHERE first < doc_id),
x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
y AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.j) AS kept, count(*) AS n
      FROM x ANTI JOIN c ON x.doc_id = c.doc_id AND x.j = c.j GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(y.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(y.kept, '')) AS kept_sha256
FROM w LEFT JOIN y ON w.doc_id = y.doc_id
"""


def _kind(name: str, number: int, pattern: str, value_group: int, least: int) -> str:
    wrapped = rf"(?s:(.*?))({pattern})".replace("'", "''")
    return rf"""
  SELECT doc_id, '{name}' AS kind, {number} AS k, stop - size AS start, stop FROM (
    SELECT doc_id, i, length(m) AS size, length(v) AS tested,
           CAST(sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS stop
    FROM (SELECT doc_id, unnest(regexp_extract_all(t, '{wrapped}', 1)) AS g, unnest(regexp_extract_all(t, '{wrapped}', 2)) AS m,
                 unnest(regexp_extract_all(t, '{wrapped}', {value_group})) AS v, generate_subscripts(regexp_extract_all(t, '{wrapped}', 1), 1) AS i
          FROM d)) WHERE tested >= {least}"""


OP3_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join([
    _kind("assign", 0, r'''((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', 4, 12),
    _kind("access", 1, "AKIA[A-Z0-9]+", 2, 18),
    _kind("hex", 2, "[0-9a-f]+", 2, 16),
    _kind("hub", 3, "gh[pousr]_[A-Za-z0-9]{36,}", 2, 1),
    _kind("jwt", 4, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 2, 1),
    _kind("pem", 5, "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 2, 1),
])}),
a AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3) AS base,
             count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.a, 0) AS n_assign, coalesce(a.c, 0) AS n_access, coalesce(a.h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""

OP7_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) AS g FROM w WHERE len(ws) >= 3
        UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) IN (1, 2))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a WHERE r.root < e.b),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def _held() -> str:
    out = []
    for t in THRESHOLDS:
        held = [f"{t.measure} >= {t.least}"] * (t.least is not None) + [f"{t.measure} <= {t.most}"] * (t.most is not None)
        out.append("(" + " AND ".join(held) + (f" OR n_words < {t.words} OR {t.measure} IS NULL" if t.words else "") + ")")
    return " AND ".join(out)


OP8_SQL = rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS} AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM k),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM f WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words, greatest(len(ws), 1) AS nw, greatest(len(ls), 1) AS nl,
             len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*(?:[-*•‣▪◦]|[0-9]{{1,3}}[.)])[\x20\x09-\x0D]'))) AS bullets,
             len(list_filter(ls, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\x09-\x0D]*$'))) AS dots,
             len(regexp_extract_all(t, '\p{{L}}+')) AS runs,
             CAST(len(list_intersect(ws, {list(dict.fromkeys(STOP_WORDS))})) AS INTEGER) AS stops,
             CASE WHEN lower(regexp_extract(lang, '^[A-Za-z]*')) IN {STOP_LANGS} THEN stops END AS stop_words
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
r AS (SELECT *, word_chars / nw AS mean_word_chars, n_symbols / nw AS symbols_per_word, n_dup_lines / nl AS dup_line_share,
             bullets / nl AS bullet_line_share, dots / nl AS ellipsis_line_share, runs / nw AS letter_runs_per_word,
             n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_held()} AS kept,
       mean_word_chars, symbols_per_word, dup_line_share, bullet_line_share, ellipsis_line_share, letter_runs_per_word, stop_words
FROM r
"""

ORACLES = {
    "op2_substring_dedup": OP2_SQL,
    "op3_secret_scan": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op6_warc": OP6_SQL,
    "op7_minhash_near_dedup": OP7_SQL,
    "op8_quality_rules": OP8_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_license_scan": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
