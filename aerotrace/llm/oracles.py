"""SQL (DuckDB) for operators whose whole result it can express."""

from __future__ import annotations

from aerotrace.llm.quality import RULES, STOP_WORDS

_WORD = "[^\\x20\\x09-\\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
        ELSE w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""


def _op10() -> str:
    value = {
        "mean_word_chars": "word_chars / n", "symbols_per_word": "n_symbols / n", "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "stop_word_ratio": "stop / n", "letter_word_ratio": "lettered / n", "upper_word_ratio": "upper / n",
    }
    failed = ", ".join(
        f"CASE WHEN {' OR '.join([f'{value[m]} < {lo}'] * (lo is not None) + [f'{value[m]} > {hi}'] * (hi is not None))} THEN '{name}' END"
        for name, m, lo, hi in RULES)
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i FROM (SELECT rid, regexp_extract_all(text, '{_WORD}') AS l FROM d)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS often FROM (
        SELECT rid, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY rid ORDER BY i))
      WHERE b IS NOT NULL AND c IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT i + k) AS rep FROM (SELECT rid, i, unnest([0, 1, 2]) AS k FROM g WHERE often > 1) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM (
        SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
c AS (SELECT rid, count(*) AS n, sum(length(w)) AS word_chars, count(*) FILTER (lower(w) IN ({stop})) AS stop,
        count(*) FILTER (regexp_matches(w, '\\pL')) AS lettered, count(*) FILTER (upper(w) = w AND lower(w) <> w) AS upper FROM w GROUP BY rid),
m AS (SELECT doc_id, n, coalesce(n, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        coalesce(dup, 0) AS n_dup_lines, n_lines, coalesce(rep, 0) AS n_repeat_words, stop, lettered, upper
      FROM d LEFT JOIN c USING (rid) LEFT JOIN l USING (rid) LEFT JOIN rep USING (rid)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',', {failed}) AS failed_rules FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, failed_rules,
  NOT base_failed AND failed_rules = '' AS kept FROM v
"""


OP10_SQL = _op10()
