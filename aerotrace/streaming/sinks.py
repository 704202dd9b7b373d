"""Sinks (SNK1-SNK8) and the retention job.

Streaming sinks keep their own checkpoint; the foreachBatch writer is
idempotent per query and batch id (a replayed batch overwrites its own load
instead of appending twice, and no other), and no batch is pulled to the
driver: every write is distributed.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerotrace.operators.live import SERVING_COLUMNS
from aerotrace.session import drop_staged, listing, stage_table


def write_raw_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """SNK1: append Parquet files with a checkpoint of their own."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


#: The live table: a folder per month and load.  A load is one batch of one
#: streaming query, or one batch job; writing a load again replaces that load.
TABLE_PARTITIONS = ("event_month", "load_id")


def serving_batch_writer(path: str, columns: list[str] = SERVING_COLUMNS, query_id: str | None = None,
                         compact_after: int | None = 500, retain_days: int | None = None) -> Callable:
    """SNK2 batch function: writes a micro-batch into the live table under a
    load id made of the streaming query's id and the batch id.

    A batch that is replayed after a failure replaces its own load; batches of
    another checkpoint have another query id and never touch it.  An empty
    batch writes nothing.  The batch is computed once, kept while it is sorted
    and written, and always let go.  ``query_id`` is taken from the running
    query.

    Before the write, when all earlier batches are committed, a month of more
    than ``compact_after`` loads is compacted and, with ``retain_days``, rows
    that many days older than the batch's latest are expired."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        running = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = f"{query_id or running or 'batch'}-{batch_id}"
        rows = batch.select(*columns).persist()
        try:
            if rows.isEmpty():
                return
            if compact_after is not None or retain_days is not None:
                latest = rows.agg(F.max("event_time").cast("string")).first()[0] if retain_days is not None else None
                maintain(spark, path, compact_after, latest, retain_days, keep={load})
            write_states_table(rows, path, load)
        finally:
            rows.unpersist()
    return write


def maintain(spark: SparkSession, path: str, compact_after: int | None = 500, as_of: str | None = None,
             retain_days: int | None = None, keep: set[str] | frozenset = frozenset()) -> list[str]:
    """Upkeep of the live table by one listing of its folders: expire rows
    older than ``retain_days`` before ``as_of``, then compact every month of
    more than ``compact_after`` loads, leaving the loads in ``keep`` alone (a
    batch that may be written again).  Returns the months compacted."""
    if as_of is not None and retain_days is not None and _folders(spark, path):
        retain(spark, path, as_of, retain_days)
    if compact_after is None:
        return []
    loads = Counter(month for month, load in _folders(spark, path) if load not in keep)
    months = sorted(m for m, n in loads.items() if n > compact_after)
    for month in months:
        compact_month(spark, path, month, keep)
    return months


def write_serving_stream(df: DataFrame, path: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """SNK2: the live serving table through ``foreachBatch``."""
    w = df.writeStream.foreachBatch(serving_batch_writer(path)).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_fanout(df: DataFrame, sinks: list[Callable[[DataFrame], StreamingQuery]]) -> list[StreamingQuery]:
    """SNK3: one transformed stream -> several independent sinks.  Callers
    wait with ``spark.streams.awaitAnyTermination()`` so a failing sink is
    noticed."""
    return [start(df) for start in sinks]


def states_layout(df: DataFrame, time_col: str = "event_time", key_col: str = "icao24",
                  partitions: int | None = None) -> DataFrame:
    """SNK4: month partition column + (time, aircraft) order inside files,
    so partition pruning and Parquet min/max statistics skip data.

    Range partitioning on (month, time, aircraft) samples the data and cuts
    it into even ranges: a busy month is split over many writer tasks (a
    hash on the month alone would put a whole month into one task), and each
    file covers a narrow, sorted time range."""
    out = (df.withColumn("event_month", F.date_format(time_col, "yyyyMM"))
           .withColumn("ingested_at", F.coalesce(F.col("ingested_at"), F.localtimestamp())
                       if "ingested_at" in df.columns else F.localtimestamp()))
    ranged = (out.repartitionByRange(partitions, "event_month", time_col, key_col) if partitions
              else out.repartitionByRange("event_month", time_col, key_col))
    return ranged.sortWithinPartitions(time_col, key_col)


def write_states_table(df: DataFrame, path: str, load_id: str | None = None) -> str:
    """SNK4 write: adds ``df`` to the live table as one load and returns its
    id.  Rows of other loads stay, also those of the same month; the same load
    id again replaces that load only (dynamic overwrite of exactly its
    folders)."""
    load = load_id or f"load-{uuid.uuid4().hex}"
    (states_layout(df).withColumn("load_id", F.lit(load)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*TABLE_PARTITIONS).parquet(path))
    return load


def read_states_table(spark: SparkSession, path: str) -> DataFrame:
    """The live table without its load column; months prune as partitions."""
    return _table(spark, path).drop("load_id")


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumns({c: F.col(c).cast("string") for c in TABLE_PARTITIONS})


def _folders(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(month, load) folders of the table, by one listing of the file system."""
    listed = listing(spark, f"{path.rstrip('/')}/event_month=*/load_id=*")
    return [(m, unquote(load)) for m, load in re.findall(r"/event_month=([^/;,]+)/load_id=([^/;,]+);", listed)]


def _delete(spark: SparkSession, path: str, folders: list[tuple[str, str]]) -> None:
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for month, load in folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/event_month={month}/load_id={load}")
        target.getFileSystem(conf).delete(target, True)


def compact_month(spark: SparkSession, path: str, month: str, keep: set[str] | frozenset = frozenset()) -> str:
    """Rewrite the loads of one month, but those in ``keep``, as a single
    load, sorted anew; the old loads are deleted after the new one is written."""
    old = [f for f in _folders(spark, path) if f[0] == month and f[1] not in keep]
    here = _table(spark, path).where(F.col("event_month") == month).where(~F.col("load_id").isin(*keep)) if keep else \
        _table(spark, path).where(F.col("event_month") == month)
    rows = stage_table(here.drop(*TABLE_PARTITIONS), "compact")
    load = write_states_table(rows, path, f"compact-{uuid.uuid4().hex}")
    _delete(spark, path, old)
    drop_staged(rows)
    return load


def retain(spark: SparkSession, path: str, as_of: str, days: int = 30, time_col: str = "event_time") -> None:
    """SNK5 write-back: delete the months that lie wholly before the cut-off,
    and rewrite each load of the month that holds it without its expired rows;
    later months are not read."""
    cutoff = (datetime.fromisoformat(as_of) - timedelta(days=days)).strftime("%Y%m")
    folders = _folders(spark, path)
    _delete(spark, path, [f for f in folders if f[0] < cutoff])
    here = [f for f in folders if f[0] == cutoff]
    if not here:
        return
    table = _table(spark, path).where(F.col("event_month") == cutoff)
    left = stage_table(expire(table, as_of, days, time_col), "retain")
    kept = {r["load_id"] for r in left.select("load_id").distinct().collect()}
    for _, load in here:
        if load in kept:
            write_states_table(left.where(F.col("load_id") == load).drop(*TABLE_PARTITIONS), path, load)
    _delete(spark, path, [f for f in here if f[1] not in kept])
    drop_staged(left)


def expire(df: DataFrame, as_of: str, days: int = 30, time_col: str = "event_time") -> DataFrame:
    """SNK5: rows whose ``time + days`` lies in the past (relative to the
    given ``as_of``, never the wall clock) are dropped."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(F.col(time_col) > cutoff)


def save(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK6: full overwrite."""
    df.write.mode("overwrite").format(fmt).save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK7: create-if-absent then append."""
    df.write.mode("append").format(fmt).save(path)


def write_feed_stream(df: DataFrame, path: str, checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """SNK8: raw landed Parquet -> serving feed -> append.  A failed write
    fails the micro-batch, which is retried from the checkpoint."""
    from aerotrace.operators.live import to_ml_feed
    return write_raw_stream(to_ml_feed(df), path, checkpoint, trigger or {"availableNow": True})
