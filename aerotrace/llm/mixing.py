"""Mixing sources to target weights with exact token budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.llm.prefix import running_sums
from aerotrace.session import stage_table

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Maximal runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sized(source, size)`` -> (source, source_size, weight, target).

    Sources in code point order, null last, weigh ``weights`` in turn and
    share the sum of all sizes; a target stops at ``most_epochs`` times its
    source's size and the excess goes to the others by weight.  With sources
    sorted by capacity per unit of weight, those that stop are a prefix, so the
    common level of the rest follows from prefix sums in one pass.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    ranked = running_sums(per_source, [F.col("source").asc_nulls_last()], {"rank": "one"})
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int"))
    capped = ranked.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(most_epochs))
    capped = capped.withColumn("fill", F.col("cap") / F.col("weight"))
    order = [F.col("fill"), F.col("rank")]
    filled = stage_table(running_sums(capped, order, {"cap_before": "cap", "weight_before": "weight"}), "mix-sources")
    whole = filled.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weight")).first()
    total, weight = float(whole["total"] or 0), float(whole["weight"] or 0)
    level = (F.lit(total) - F.col("cap_before")) / (F.lit(weight) - F.col("weight_before"))
    found = filled.withColumn("level", level).where("fill > level").agg(F.min_by("level", F.struct("fill", "rank")).alias("level")).first()
    share = F.lit(found["level"]) * F.col("weight") if found["level"] is not None else F.col("cap")
    return filled.select("source", "source_size", "weight", F.least(F.col("cap"), share).alias("target"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def draw_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Hash-random key of a document; one without an id draws by its text."""
    known = F.concat(F.lit(f"{seed}:"), doc_id.cast("string"))
    return F.md5(F.when(doc_id.isNotNull(), known).otherwise(F.concat(F.lit(f"{seed}::"), F.coalesce(F.md5(text.cast("binary")), F.lit("")))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: (id_col, size, source_size, target, taken).

    Every document draws a random key from a hash of the seed and its id (of
    its text if it has none); documents are range-sorted by key within their source, and prefix sums of
    sizes cut each source at its budget (the target, rounded).  A budget of
    more than one source size takes whole epochs first; the document at the
    cut is taken in part.  Reruns give the same result.

    Null or blank texts have size 0 and are taken with 0 words; null sources
    are a source of their own, last in order.  Ties in the key (rows that
    repeat an id, or a text without one) are ordered by id and size; exact
    repeats of a row are documents of their own.  An empty table gives an empty result;
    other columns are ignored.
    """
    sized = stage_table(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        draw_key(F.col(id_col), F.col(text_col), seed).alias("draw")), "mix-sizes")
    targets = source_targets(sized, weights, most_epochs)
    placed = running_sums(sized, [F.col("draw"), F.col("id").asc_nulls_last(), F.col("size")], {"before": "size"}, by=["source"])
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    joined = placed.join(t, F.col("source").eqNullSafe(F.col("_s")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return joined.withColumn("budget", budget).withColumn("epochs", epochs).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word, white space as it is."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0)), F.lit(1), n), "")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, text, source, ...), each as
    often as the mix takes it whole, and the documents at a cut once more, up
    to the end of the last word taken.  n_chars follows a cut text.

    Null, empty and blank texts use no budget and are kept once.  Rows that
    share an id and size share the smallest ``taken`` of them; a row without
    an id goes by its source and text.  Any further column passes through
    whatever its name; an empty table gives an empty result."""
    key, size, first = (unused(docs, n) for n in ("_key", "_size", "_first"))
    blank = F.lit("")
    own = F.concat_ws("#", blank, F.coalesce("source", blank), F.md5(F.coalesce("text", blank).cast("binary")))
    sized = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("string"), own)).withColumn(size, word_count(F.col("text")))
    plan = mix(sized.select(F.col(key).alias("doc_id"), "text", "source"), **options)
    plan = plan.groupBy("doc_id", "size").agg(F.min("taken").alias("taken"))
    rows = sized.join(plan.select(F.col("doc_id").alias(key), F.col("size").alias(size), F.struct("taken").alias(first)), [key, size])
    n, taken = F.col(size), F.col(f"{first}.taken")
    whole = F.when(n == 0, 1).otherwise(F.floor(taken / n)).cast("int")
    left = F.when(n == 0, 0).otherwise(taken % n).cast("int")
    copies = F.array_repeat(F.lit(0), whole)
    copies = F.when(left > 0, F.array_append(copies, left)).otherwise(copies)
    cut = rows.withColumn(first, F.explode(copies))
    part = F.col(first) > 0
    out = {"text": F.when(part, first_words(F.col("text"), F.col(first))).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(part, F.length(out["text"]).cast("long")).otherwise(F.col("n_chars"))
    return cut.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in docs.columns])


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents under the production weights."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5(CASE WHEN doc_id IS NULL THEN '{SEED}::' || coalesce(md5(text), '') ELSE '{SEED}:' || CAST(doc_id AS VARCHAR) END) AS draw
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS rnk, 3.0::DOUBLE * source_size AS cap FROM per),
filled AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS cap_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
         sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER () AS all_weight
  FROM ranked WINDOW w AS (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (total - cap_before) / (all_weight - weight_before) AS level FROM filled),
chosen AS (SELECT arg_min(level, cap_before) AS level FROM levels WHERE cap / weight > level),
targets AS (SELECT source, source_size, least(cap, coalesce(chosen.level * weight, cap)) AS target FROM filled, chosen),
placed AS (
  SELECT s.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) END AS BIGINT) AS taken
FROM placed
"""
