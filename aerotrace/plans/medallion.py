"""Composed batch flows: bronze -> silver -> gold -> ML.

Each step is a pure DataFrame function, so a whole flow is one lazy plan
that Catalyst optimises end to end (projections pruned through the windows,
filters pushed to the scan).  Where several outputs read one intermediate
result, :func:`materialize` writes it once to the shared checkpoint folder
and reads it back, which also cuts the lineage: a lost executor then
recomputes from that table, not from the raw scan.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from aerotrace.operators.backfill import backfill, default_series
from aerotrace.operators.clean import clean_traces
from aerotrace.operators.dedup import dedup
from aerotrace.operators.enrich import enrich
from aerotrace.session import shared_path, stage_table

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def silver(flat: DataFrame, staged: bool = True, rescan: bool = False) -> DataFrame:
    """dedup -> null backfill -> clean/validate (dedup first: it rewrites
    the backfill input).

    The deduplicated rows feed several branches of the keyed scan (the row
    pass, the per-chunk summary and the hot-chunk counts), so by default
    they are staged once (:func:`stage`) instead of re-running the dedup
    shuffle in each branch.

    With ``rescan`` (``flat`` is a projection of stored tables, cheap to read
    twice) its rows are counted per aircraft first.  Where no aircraft has
    more than the series' ``whole_rows``, copies included, the wide rows are
    shuffled once, by aircraft: dedup and both fills then run on the rows
    where they lie, and nothing is staged."""
    if rescan:
        s = default_series(tiebreak=())  # aircraft and time are unique after the dedup
        rows = s.uncut_rows(s.counts(flat))
        if rows is not None:
            return clean_traces(backfill(dedup(s.spread(flat, rows)), replace(s, placed=True)))
    deduped = dedup(flat)
    if staged:
        deduped = stage(deduped, "deduped")
    return clean_traces(backfill(deduped))


def gold(flat: DataFrame) -> DataFrame:
    return enrich(silver(flat))


def materialize(spark: SparkSession, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and return
    a scan of it (reliable, unlike ``localCheckpoint``)."""
    path = shared_path(spark, name)
    df.write.mode(mode).parquet(path)
    return spark.read.parquet(path)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` once as a Parquet table under ``spark.checkpoint.dir``
    (a shared folder on a cluster) and return a scan of it.

    Used where one intermediate feeds several branches of a plan -- e.g. the
    two phases of every chunked keyed scan, or the eight star tables -- so
    upstream work (dedup shuffle, windows) runs once.  Lineage is cut: a lost
    executor recomputes from this table, not from the raw input.  Unlike an
    RDD checkpoint, consumers of the Parquet table get column pruning and
    filter pushdown.  ``localCheckpoint`` is never used.

    The JVM does not compile methods above 8000 bytes, which one generated
    loop over the wide fills and cleaning rules exceeds; unless the session
    sets that limit itself, such stages of the write run as separate operators.
    """
    conf = df.sparkSession.conf
    if conf.get(METHOD_LIMIT, None) is not None:
        return stage_table(df, name)
    conf.set(METHOD_LIMIT, "8000")
    try:
        return stage_table(df, name)
    finally:
        conf.unset(METHOD_LIMIT)
