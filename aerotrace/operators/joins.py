"""Joins: hybrid left equi-join (JN1) and ICAO address-range lookup (JN2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerotrace.functions.exprs import hex_to_long

BUCKET_BITS = 12  # 24-bit ICAO space -> at most 4096 buckets


def hybrid_left_join(scores: DataFrame, seq: DataFrame,
                     keys=("icao", "event_timestamp")) -> DataFrame:
    """JN1: every score row, with the sequence verdict when one exists.
    (icao, event_timestamp) is unique after dedup on both sides, so the
    sort-merge join has no skewed key; AQE still splits skewed partitions."""
    return scores.join(seq, list(keys), "left")


def range_lookup(df: DataFrame, ranges: DataFrame, value: str, start="range_start",
                 end="range_end", bucket_bits: int = BUCKET_BITS,
                 max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """JN2: left join each row to the inclusive, non-overlapping range that
    contains ``value`` (null or uncovered -> null range columns).

    Spark has no range-join operator; a bare ``BETWEEN`` condition plans a
    nested-loop join.  Instead both sides get an equi-join key
    ``value >> bucket_bits``: each range is expanded to the buckets it
    touches, then a hash join on the bucket is followed by the exact
    ``BETWEEN``.  The expanded rows are counted from the range widths, whatever
    their space and overlaps: up to ``max_broadcast_rows`` they are broadcast,
    so the large side is never shuffled and a hot address cannot make a hot
    partition.  Beyond it the join stays a shuffle join on the bucket, where
    AQE splits skewed partitions.
    """
    b = bucket_bits
    r = ranges.withColumn("_bucket", F.explode(F.sequence(F.shiftright(F.col(start), b),
                                                          F.shiftright(F.col(end), b))))
    l = df.withColumn("_bucket", F.shiftright(F.col(value), b))
    cond = ((l["_bucket"] == r["_bucket"]) & (l[value] >= r[start]) & (l[value] <= r[end]))
    width = F.shiftright(F.col(end), b) - F.shiftright(F.col(start), b) + 1
    expanded = ranges.agg(F.sum(width.cast("long"))).first()[0] or 0
    out = l.join(F.broadcast(r) if expanded <= max_broadcast_rows else r, cond, "left")
    return out.select(*[l[c] for c in df.columns], *[r[c] for c in ranges.columns])


def icao_country(states: DataFrame, ranges: DataFrame, icao="icao24") -> DataFrame:
    """Country of each state record from its 24-bit ICAO address."""
    with_int = states.withColumn("icao_int", hex_to_long(icao))
    return range_lookup(with_int, ranges, "icao_int")
