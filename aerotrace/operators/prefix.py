"""Distributed prefix sums and row positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerotrace.session import stage_table


def running_sums(df: DataFrame, order: list, sums: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """``df`` plus, for each ``new: value`` of ``sums``, the sum of ``value``
    over the rows that come before a row in ``order`` (within its ``by``
    group, null being a group of its own).

    The rows are range-partitioned by (by, order) and stored with their
    partition number; one row per partition and group is then summed up front
    and each partition adds its own rows to that offset.  A group of any size
    spreads over many partitions, and only one row per partition and group
    meets in a window.  ``order`` must be total up to rows that are equal in
    all of df's columns.  An empty table gives an empty result.
    """
    by = by or []
    keys = [F.col(c).asc_nulls_last() for c in by]
    ranged = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    staged = stage_table(ranged, "prefix")
    ahead = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = (staged.groupBy("_part", *by).agg(*[F.sum(v).alias(f"_t_{n}") for n, v in sums.items()])
               .select("_part", *by, *[F.coalesce(F.sum(f"_t_{n}").over(ahead), zero).alias(f"_o_{n}") for n in sums]))
    offsets = offsets.select(F.col("_part").alias("_p2"), *[F.col(c).alias(f"_by_{c}") for c in by],
                             *[f"_o_{n}" for n in sums])
    match = F.col("_part") == F.col("_p2")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return staged.join(offsets, match).select(
        *df.columns, *[(F.col(f"_o_{n}") + F.coalesce(F.sum(v).over(inside), zero)).alias(n) for n, v in sums.items()])


def row_positions(df: DataFrame, order: list, by: list[str] | None = None, name: str = "position") -> DataFrame:
    """``df`` plus ``name``: how many rows come before the row in ``order``
    within its ``by`` group (null being a group of its own).

    Rows are range-partitioned and sorted by (by, order) and stored with their
    place in the stored partition.  One row per partition and group then says
    how many rows lie ahead of it, so the rows are shuffled once and no window
    holds them.  ``order`` must be total up to rows that are equal in all of
    df's columns.
    """
    by = by or []
    keys = [*[F.col(c).asc_nulls_last() for c in by], *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    staged = stage_table(placed, "positions").withColumn("_part", F.shiftright("_place", 33))
    parts = staged.groupBy("_part", *by).agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    ahead = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_part").alias("_p2"), *[F.col(c).alias(f"_by_{c}") for c in by],
                         (F.col("_first") - F.coalesce(F.sum("_rows").over(ahead), F.lit(0))).alias("_base"))
    match = F.col("_part") == F.col("_p2")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return staged.join(parts, match).select(*df.columns, (F.col("_place") - F.col("_base")).alias(name))
