"""Batch scans (SRC6) and table writes used by the batch flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Session setting: number of partitions for scans that feed heavy row-wise
#: work.  Set it when the files are too few for the cores; unset, a scan keeps
#: the splits of its files.
SCAN_PARTITIONS = "aerotrace.scan.partitions"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one Parquet table; projections/filters applied later are pushed
    into the scan by Catalyst (ReadSchema / PushedFilters)."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    partitions = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df
