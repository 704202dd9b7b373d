"""Document quality rules: a threshold table compiled into one projection.

Every measure is a built-in Spark expression over the text, so the whole rule
table is evaluated row by row in the JVM, without a shuffle and without user
functions.  Work per text is O(n log n) in its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the corpus languages (fixed values).
STOP_WORDS = ("the", "of", "and", "to", "a", "in", "is", "that", "for", "with", "it", "on", "as", "was", "be", "by",
              "la", "le", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "dans", "pour", "par",
              "el", "los", "las", "y", "con", "se", "del", "una", "por",
              "der", "die", "das", "und", "von", "zu", "mit", "den", "ist", "im", "nicht", "ein", "eine", "auf")

#: (rule, measure, least, most): a document passes if least <= measure <= most.
#: A null measure (no words) passes; such documents fail the base rules.
RULES = (
    ("word_length", "mean_word_chars", 2.5, 12.0),
    ("symbols", "symbols_per_word", None, 0.1),
    ("duplicate_lines", "dup_line_ratio", None, 0.4),
    ("stop_words", "stop_word_ratio", 0.03, None),
    ("letters", "letter_word_ratio", 0.7, None),
    ("upper_case", "upper_word_ratio", None, 0.6),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space; empty for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found at least twice.

    Windows are sorted by (hash, position), packed into one long each: as many
    low bits as positions need, the rest hash.  Neighbours with one hash are
    compared word by word, so a hash collision does not count."""

    def same(i, j):
        return ((F.get(words, i) == F.get(words, j)) & (F.get(words, i + 1) == F.get(words, j + 1))
                & (F.get(words, i + 2) == F.get(words, j + 2)))

    def covered(packed, width):
        low = F.expr("1L")
        place = lambda x: (x.bitwiseAND(F.pow(F.lit(2.0), width).cast("long") - low)).cast("int")
        bucket = lambda x: F.call_function("shiftright", x, width)

        def twice(x, i):
            def like(y):
                return F.coalesce((bucket(x) == bucket(y)) & same(place(x), place(y)), F.lit(False))
            return like(F.get(packed, i - 1)) | like(F.get(packed, i + 1))

        starts = F.array_sort(F.transform(F.filter(packed, twice), place))
        return F.aggregate(
            starts, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    def counted(n, width):
        windows = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.call_function("shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
                                      width).bitwiseOR(i.cast("long")))
        return let(F.sort_array(windows), lambda packed: covered(packed, width))

    n = F.size(words)
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(
        let(F.length(F.bin(n)), lambda width: counted(n, width)))


def measures(text: Column) -> Column:
    """Counts of a text, as one struct."""

    def counts(text, word):
        lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        return F.struct(
            F.size(word).cast("long").alias("n_words"),
            F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                          (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            repeated_words(word).alias("n_repeat_words"),
            F.size(F.filter(word, lambda w: F.lower(w).isin(*STOP_WORDS))).alias("stop"),
            F.size(F.filter(word, lambda w: w.rlike("\\p{L}"))).alias("lettered"),
            F.size(F.filter(word, lambda w: (F.upper(w) == w) & (F.lower(w) != w))).alias("upper"))

    return let(F.coalesce(text, F.lit("")), lambda t: let(words(t), lambda w: counts(t, w)))


def verdict(m: Column, rules=RULES, least_words: int = 50, most_repeated: float = 0.5) -> tuple[Column, Column]:
    """(base_failed, names of the failed rules) from the counts of a text."""
    n = F.nullif(m["n_words"], F.lit(0))
    value = {
        "mean_word_chars": m["word_chars"] / n,
        "symbols_per_word": m["n_symbols"] / n,
        "dup_line_ratio": m["lines"]["dup"] / F.nullif(m["lines"]["n"], F.lit(0)),
        "stop_word_ratio": m["stop"] / n,
        "letter_word_ratio": m["lettered"] / n,
        "upper_word_ratio": m["upper"] / n,
    }

    def broken(measure, least, most):
        low = value[measure] < least if least is not None else F.lit(False)
        high = value[measure] > most if most is not None else F.lit(False)
        return F.coalesce(low | high, F.lit(False))

    base = (m["n_words"] < least_words) | (m["n_repeat_words"] > most_repeated * m["n_words"])
    return base, F.array_compact(F.array(*[F.when(broken(*rule[1:]), F.lit(rule[0])) for rule in rules]))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: id, counts, base verdict, the names of the
    failed rules and the final verdict.

    A null, empty or blank text has zero counts, fails the base rule (too few
    words) and is not kept.  Null ids, repeated rows and texts of any length
    are measured like any other; an empty table gives an empty result; other
    columns of ``docs`` are ignored.
    """
    m = F.col("_m")
    base, failed = verdict(m, **limits)
    return docs.select(F.col(id_col).alias("_id"), measures(F.col(text_col)).alias("_m")).select(
        F.col("_id").alias(id_col), m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"), m["lines"]["dup"].alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"), base.alias("base_failed"),
        F.array_join(failed, ",").alias("failed_rules"), (~base & (F.size(failed) == 0)).alias("kept"))


def passing(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns.
    The counts are bound once inside the condition, so that a filter, which
    Catalyst moves below projections, does not compute them per rule."""
    def good(m):
        base, failed = verdict(m, **limits)
        return ~base & (F.size(failed) == 0)
    return docs.where(let(measures(F.col(text_col)), good))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document under the production rules."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
