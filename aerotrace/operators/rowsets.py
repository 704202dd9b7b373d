"""Whole-table operators without a single-partition step: rank family, set
operations with multiplicity, grouping sets from the finest level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerotrace.operators.prefix import row_positions, running_sums
from aerotrace.session import stage_table


def rank_family(df: DataFrame, value: str, tiebreak: list[str], by: list[str] | None = None, tiles: int = 100) -> DataFrame:
    """``df`` plus row_number, rank, dense_rank, percent_rank, cume_dist and
    ntile (``tiles``) of ``value`` ascending, nulls last, within ``by`` (the
    whole table without it).

    Ranks come from a histogram of the distinct values: its prefix sums count
    the rows and the values ahead, and every row looks its value up.  Row
    numbers, which order ties by ``tiebreak`` (unique together with the
    value), are places in the range-sorted rows.  No window holds a
    group, however large, and values with many ties are one histogram row.
    """
    by = list(by or [])
    order = F.col(value).asc_nulls_last()
    one = F.lit(1).cast("long")
    counts = stage_table(df.groupBy(*by, value).agg(F.count("*").alias("_n")).withColumn("_one", one), "rank-values")
    ahead = running_sums(counts, [order], {"_before": "_n", "_values": "_one"}, by)
    total = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    numbered = row_positions(df, [order, *[F.col(c) for c in tiebreak]], by, "_row")

    def match(a, b, names):
        hit = F.lit(True)
        for c in names:
            hit = hit & a[c].eqNullSafe(b[f"_j_{c}"])
        return hit

    def renamed(t, names):
        return t.select(*[F.col(c).alias(f"_j_{c}") if c in names else F.col(c) for c in t.columns])

    if by:
        known = renamed(total, by)
        ahead = ahead.join(known, match(ahead, known, by)).select(*ahead.columns, "_total")
    else:
        ahead = ahead.withColumn("_total", F.lit(total.first()["_total"] or 0))
    found = renamed(ahead.drop("_one"), [*by, value])
    rows = numbered.join(found, match(numbered, found, [*by, value]))
    n, row = F.col("_total"), F.col("_row")
    size, more = F.expr(f"_total div {int(tiles)}"), F.expr(f"_total % {int(tiles)}")
    wide = more * (size + 1)
    tile = F.when(row < wide, F.floor(row / (size + 1)) + 1).otherwise(more + F.floor((row - wide) / F.nullif(size, F.lit(0))) + 1)
    return rows.select(
        *df.columns, (row + 1).alias("row_number"), (F.col("_before") + 1).alias("rank"), (F.col("_values") + 1).alias("dense_rank"),
        F.when(n > 1, F.col("_before") / (n - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
        ((F.col("_before") + F.col("_n")) / n).alias("cume_dist"), tile.cast("long").alias("ntile"))


def signed_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """The distinct rows of both tables with ``n_a`` and ``n_b``, how often
    each table has them; nulls are equal.  One shuffle, combined before it.
    Columns are matched by position, names are those of ``a``."""
    if len(a.columns) != len(b.columns):
        raise ValueError("both tables need the same number of columns")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    both = a.select("*", one.alias("_a"), zero.alias("_b")).union(b.select("*", zero, one))
    return both.groupBy(*a.columns).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b"))


def repeated(rows: DataFrame, times: Column, piece: int = 1024) -> DataFrame:
    """Each row ``times`` times (not at all for 0 and less), in pieces of
    bounded size, so a row of any multiplicity streams out of its task."""
    columns = rows.columns
    pieces = rows.withColumn("_times", times).where("_times > 0").withColumn(
        "_piece", F.explode(F.expr(f"sequence(0L, (_times - 1) div {piece})")))
    return pieces.withColumn("_copy", F.explode(F.expr(f"sequence(1, cast(least({piece}L, _times - _piece * {piece}) AS int))"))).select(*columns)


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a``, each as often as ``a`` has it more often than ``b``."""
    counts = signed_counts(a, b)
    return repeated(counts, F.col("n_a") - F.col("n_b")).select(*a.columns)


def intersect_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both tables, each as often as the one that has it less often."""
    counts = signed_counts(a, b)
    return repeated(counts, F.least("n_a", "n_b")).select(*a.columns)


def delivery_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """What ``new`` has more (``added``) or less (``removed``) often than
    ``old``: one row per copy, with its ``change``."""
    counts = signed_counts(old, new)
    change = F.when(F.col("n_b") > F.col("n_a"), F.lit("added")).otherwise(F.lit("removed"))
    return repeated(counts.withColumn("change", change), F.abs(F.col("n_b") - F.col("n_a"))).select("change", *old.columns)


def grouping_levels(df: DataFrame, dims: list[str], sets: list[list[str]], values: dict[str, str]) -> DataFrame:
    """Aggregates for several grouping sets of ``dims``: the dims (null where
    rolled up), ``grouping_id``, ``n_rows`` and per ``name: column`` of
    ``values`` name_n, name_sum, name_min, name_max and name_avg.

    The input is read and shuffled once, for the finest level; the coarser
    levels are rolled up from its few rows, not from copies of every input
    row.  ``grouping_id`` has a bit per dim, the first dim the highest, set
    where the dim is rolled up, which tells a null value from a subtotal.
    """
    partial = [F.count("*").alias("n_rows")]
    for name, c in values.items():
        partial += [F.count(c).alias(f"{name}_n"), F.sum(c).alias(f"{name}_sum"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max")]
    finest = df.groupBy(*dims).agg(*partial)
    merged = [F.grouping_id().cast("long").alias("grouping_id"), F.sum("n_rows").alias("n_rows")]
    for name in values:
        merged += [F.sum(f"{name}_n").alias(f"{name}_n"), F.sum(f"{name}_sum").alias(f"{name}_sum"), F.min(f"{name}_min").alias(f"{name}_min"),
                   F.max(f"{name}_max").alias(f"{name}_max")]
    out = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(*merged)
    return out.select(*dims, "grouping_id", "n_rows", *[
        x for name in values for x in (f"{name}_n", f"{name}_sum", f"{name}_min", f"{name}_max",
                                       (F.col(f"{name}_sum").cast("double") / F.nullif(f"{name}_n", F.lit(0))).alias(f"{name}_avg"))])
