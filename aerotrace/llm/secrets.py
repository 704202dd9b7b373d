"""Secret scan over a trigram inverted index, in DataFrame expressions only.

Each rule's regular expression is reduced to a Boolean trigram query: the
literal strings that every match must hold give their trigrams.  Postings of
the rules' trigrams are built over the whole lower-cased texts, intersected per
rule, and only candidate texts are matched with the expression itself.  A rule
without mandatory trigrams scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.quality import let


@dataclass(frozen=True)
class Rule:
    """``least`` code points are needed in ``group`` of a match (else the
    match is dropped, though it still uses up its text)."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: Fixed rules; base kinds first, in their order.
RULES = (
    Rule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", "[0-9a-f]{32,}", 0, 32, True),
    Rule("github", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)

_MOST_STRINGS = 64  # alternatives followed at once; beyond that a part asks for nothing


def trigram_query(pattern: str) -> list[list[frozenset]]:
    """Conjunction of disjunctions of trigram sets, lower-cased: a text can
    match only if, for every clause, all trigrams of some alternative occur.
    No clause: the pattern has no mandatory trigram."""
    clauses: list[list[frozenset]] = []

    def grams(text):
        return frozenset(text[i:i + 3] for i in range(len(text) - 2))

    def close(strings):
        sets = {grams(s.lower()) for s in strings}
        if sets and all(sets):
            clauses.append([s for s in sets if not any(o < s for o in sets)])
        return {""}

    def spell(tree) -> set | None:
        """All strings that a subpattern can match, None if not a small set."""
        strings = {""}
        for op, arg in tree:
            if op is sre.LITERAL:
                own = {chr(arg)}
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
                own = {chr(a) for _, a in arg}
            elif op is sre.BRANCH:
                parts = [spell(t) for t in arg[1]]
                own = None if None in parts else set().union(*parts)
            elif op is sre.SUBPATTERN:
                own = spell(arg[3])
            elif op is sre.MAX_REPEAT and arg[1] == 1:
                own = spell(arg[2])
                own = own if own is None or arg[0] else own | {""}
            else:
                own = None
            if own is None or len(own) * len(strings) > _MOST_STRINGS:
                return None
            strings = {a + b for a in strings for b in own}
        return strings

    strings = {""}
    for item in _parser.parse(pattern):
        own = spell([item])
        if own is None or len(own) * len(strings) > _MOST_STRINGS:
            strings = close(strings)
            strings = own if own and len(own) <= _MOST_STRINGS else {""}
        else:
            strings = {a + b for a in strings for b in own}
    close(strings)
    return clauses


def build_index(docs: DataFrame, trigrams: list[str], key: str, text: str) -> DataFrame:
    """Postings ``(trigram, key)`` of the given trigrams in the lower-cased texts."""
    terms = F.array(*[F.lit(t) for t in trigrams])
    found = let(F.lower(text), lambda low: F.filter(terms, lambda t: F.contains(low, t)))
    return docs.select(F.col(key).alias("key"), F.explode(found).alias("trigram")).select("trigram", "key")


def candidates(index: DataFrame, rules) -> DataFrame:
    """``(key, kinds)``: texts whose postings satisfy a rule's query."""
    spark = index.sparkSession
    terms = [(r.kind, c, a, t, len(alt)) for r in rules for c, clause in enumerate(trigram_query(r.pattern))
             for a, alt in enumerate(clause) for t in sorted(alt)]
    clauses = [(r.kind, len(q)) for r in rules if (q := trigram_query(r.pattern))]
    query = spark.createDataFrame(terms, "kind string, clause int, alternative int, trigram string, needed long")
    wanted = spark.createDataFrame(clauses, "kind string, clauses long")
    held = (index.join(F.broadcast(query), "trigram").groupBy("kind", "clause", "alternative", "key")
            .agg(F.count_distinct("trigram").alias("n"), F.max("needed").alias("needed")).where("n = needed"))
    met = held.groupBy("kind", "key").agg(F.count_distinct("clause").alias("met"))
    return (met.join(F.broadcast(wanted), "kind").where("met = clauses")
            .groupBy("key").agg(F.collect_set("kind").alias("kinds")))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, span); code
    points, end exclusive."""

    def located(pieces):
        whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole

        def step(acc, pair):
            start = acc["at"] + F.length(pair["before"])
            end = start + F.length(pair["whole"])
            one = F.struct(start.alias("start"), F.lit(order).alias("order"), F.concat_ws(
                ":", F.lit(rule.kind), start.cast("string"), end.cast("string")).alias("span"))
            none = F.array().cast("array<struct<start:int,order:int,span:string>>")
            return F.struct(end.alias("at"), F.when(
                F.length(pair["held"]) >= rule.least, F.concat(acc["out"], F.array(one))).otherwise(
                F.concat(acc["out"], none)).alias("out"))

        pairs = F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("before"), whole.alias("whole"), held.alias("held"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,order:int,span:string>>").alias("out"))
        return F.aggregate(pairs, start, step, lambda acc: acc["out"])

    none = F.array().cast("array<struct<start:int,order:int,span:string>>")
    return let(F.split(text, rule.pattern, -1), lambda pieces: F.when(F.size(pieces) > 1, located(pieces)).otherwise(none))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per row of ``docs``: id, n_<kind> of each base kind,
    base_sha256 (of the base spans), spans (all of them).

    A span is kind:start:end; spans are ordered by start, then by the order of
    the rules.  Null and empty texts have no span; null ids, repeated ids and
    repeated rows are scanned each; an empty table gives an empty result;
    other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    source = source.withColumn("_key", F.xxhash64("_id", "_text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({t for q in queries.values() for clause in q for alt in clause for t in alt})
    indexed = [r for r in rules if queries[r.kind]]
    hits = candidates(build_index(source, trigrams, "_key", "_text"), indexed)
    joined = source.join(hits.withColumnRenamed("key", "_key"), "_key", "left")
    none = F.array().cast("array<struct<start:int,order:int,span:string>>")
    found = [F.when(F.array_contains("kinds", r.kind), spans(F.col("_text"), r, i)).otherwise(none)
             if queries[r.kind] else spans(F.col("_text"), r, i) for i, r in enumerate(rules)]
    kept = joined.select("_id", *[f.alias(f"_s{i}") for i, f in enumerate(found)])

    def text_of(which):
        parts = [F.col(f"_s{i}") for i in which]
        return F.concat_ws(",", F.transform(F.array_sort(F.concat(*parts)), lambda s: s["span"]))

    base = [i for i, r in enumerate(rules) if r.base]
    return kept.select(
        F.col("_id").alias(id_col), *[F.size(f"_s{i}").cast("long").alias(f"n_{rules[i].kind}") for i in base],
        F.sha2(text_of(base), 256).alias("base_sha256"), text_of(range(len(rules))).alias("spans"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents under the production rules."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    one = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        one.append(f"""SELECT rid, {i} AS k, '{r.kind}' AS kind, unnest(range(len(regexp_extract_all(text, '{p}', 0)))) AS j,
  regexp_split_to_array(text, '{p}') AS pieces, regexp_extract_all(text, '{p}', 0) AS whole,
  regexp_extract_all(text, '{p}', {r.group}) AS held, {r.least} AS least FROM d WHERE regexp_matches(text, '{p}')""")
    size = lambda a: f"coalesce(list_sum([length(x) for x in {a}]), 0)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({' UNION ALL '.join(one)}),
s AS (SELECT rid, k, kind, CAST({size('pieces[1:j+1]')} + {size('whole[1:j]')} AS BIGINT) AS a, length(whole[j+1]) AS n
      FROM m WHERE length(held[j+1]) >= least),
g AS (SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) FILTER (k < 3) AS base,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) AS spans FROM s GROUP BY rid)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


OP3_SQL = _sql()
