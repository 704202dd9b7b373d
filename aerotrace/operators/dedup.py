"""Deduplication (DED1/DED2; streaming form DED3 lives in streaming/)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys=("icao", "event_timestamp"),
          prefer: list[Column] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the first in ``prefer`` order.

    By default that is the latest ``ingestion_ts`` (null last), then the first
    ``source_file``, then the largest ``row_id`` where there is one, else the
    smallest of two hashes of the whole row (96 bits): rows that still tie are
    equal, so the survivor does not depend on partitioning.

    Written as ``row_number() = 1``, which Spark plans with a group limit
    before the shuffle: each map task passes on one row per key at most, so a
    key with any number of copies never reaches one task whole.
    """
    if prefer is None:
        prefer = [F.col("ingestion_ts").desc_nulls_last()]
        if "source_file" in df.columns:
            prefer.append(F.col("source_file").asc_nulls_last())
        if "row_id" in df.columns:
            prefer.append(F.col("row_id").desc_nulls_last())
        else:
            rest = [c for c in df.columns if c not in keys]
            prefer += [F.xxhash64(*rest), F.hash(*rest)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*prefer))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def select_exclude(df: DataFrame, *cols: str) -> DataFrame:
    """``SELECT * EXCLUDE (cols)``."""
    return df.drop(*cols)
