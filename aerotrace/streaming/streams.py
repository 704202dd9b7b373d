"""Structured Streaming plans (SRC1, SRC5, SNK1-SNK3, SNK8, GF1/WN4/DED3
streaming forms).

The same DataFrame operators as the batch path are applied to streaming
DataFrames; only sources, sinks, watermarks and triggers differ.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerotrace.functions.exprs import epoch_micros_ntz, ntz_from_micros
from aerotrace.operators.live import transform_states
from aerotrace.session import stage_table
from aerotrace.sources.states import STATE_SCHEMA, read_states_stream
from aerotrace.streaming import sinks


def read_landed_stream(spark: SparkSession, path: str, schema: T.StructType = STATE_SCHEMA,
                       pattern: str = "part-*.parquet", max_files: int | None = None) -> DataFrame:
    """SRC5: incrementally pick up landed Parquet files.  The checkpoint of
    the consuming query records processed files (replacing a hand-kept
    log); a file is committed only after its batch's write succeeded."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def live_states(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                path: str | None = None) -> DataFrame:
    """SRC1 -> SRC2 -> PL*: the transformed live state stream."""
    return transform_states(read_states_stream(spark, fmt, options, path))


def start_live(spark: SparkSession, raw_path: str, serving_path: str, checkpoint_root: str,
               fmt: str = "kafka", options: dict | None = None, path: str | None = None,
               trigger: dict | None = None) -> list[StreamingQuery]:
    """SNK3: fan one transformed stream out to the raw Parquet sink and the
    serving table, each with its own checkpoint."""
    df = live_states(spark, fmt, options, path)
    root = checkpoint_root.rstrip("/")
    return sinks.start_fanout(df, [
        lambda d: sinks.write_raw_stream(d, raw_path, f"{root}/raw", trigger),
        lambda d: sinks.write_serving_stream(d, serving_path, f"{root}/serving", trigger),
    ])


EVENT_INSTANT = "_event_instant"


def with_instant(df: DataFrame, time_col: str) -> DataFrame:
    """Watermarks need a TIMESTAMP (instant) column; an NTZ event time (UTC
    wall clock) is mapped to the same instant without the session zone."""
    if isinstance(df.schema[time_col].dataType, T.TimestampNTZType):
        return df.withColumn(EVENT_INSTANT, F.timestamp_micros(epoch_micros_ntz(time_col)))
    return df.withColumn(EVENT_INSTANT, F.col(time_col))


def to_wall_clock(c) -> "F.Column":
    return ntz_from_micros(F.unix_micros(c))


def dedup_stream(df: DataFrame, keys=("icao", "event_timestamp"), time_col: str = "event_timestamp",
                 delay: str = "10 minutes") -> DataFrame:
    """DED3: drop repeats of ``keys`` arriving within the watermark delay;
    state older than the watermark is evicted, so state stays bounded."""
    return (with_instant(df, time_col).withWatermark(EVENT_INSTANT, delay)
            .dropDuplicatesWithinWatermark(list(keys)).drop(EVENT_INSTANT))


def active_aircraft_stream(df: DataFrame, minutes: int = 1, delay: str = "2 minutes",
                           time_col: str = "event_time", key: str = "icao24") -> DataFrame:
    """GF1 streaming form: distinct aircraft per tumbling window; exact
    distinct counts are not supported on streams, the HyperLogLog sketch is
    (bounded state per window)."""
    return (with_instant(df, time_col).withWatermark(EVENT_INSTANT, delay)
            .groupBy(F.window(EVENT_INSTANT, f"{minutes} minutes").alias("w"))
            .agg(F.approx_count_distinct(key).alias("active_aircraft"))
            .select(to_wall_clock(F.col("w.start")).alias("window_start"), "active_aircraft"))


def episode_stream(df: DataFrame, gap: str = "5 minutes", delay: str = "10 minutes",
                   time_col: str = "event_timestamp", key: str = "icao",
                   score: str = "xgb_anomaly_score", threshold: float = 5.0) -> DataFrame:
    """WN4 streaming form: anomaly episodes as session windows per aircraft."""
    return (with_instant(df.filter(F.col(score) >= F.lit(threshold)), time_col)
            .withWatermark(EVENT_INSTANT, delay)
            .groupBy(key, F.session_window(EVENT_INSTANT, gap).alias("s"))
            .agg(F.count("*").alias("n_points"), F.max(score).alias("peak_score"))
            .select(key, to_wall_clock(F.col("s.start")).alias("episode_start"),
                    to_wall_clock(F.col("s.end")).alias("episode_end"), "n_points", "peak_score"))


def verdict_join(scores: DataFrame, verdicts: DataFrame, how: str = "left", key: str = "icao",
                 score_time: str = "event_timestamp", verdict_time: str = "verdict_timestamp", early: str = "0 seconds",
                 late: str = "30 minutes", score_delay: str = "10 minutes", verdict_delay: str = "10 minutes") -> DataFrame:
    """Scored states with the sequence verdicts that come for them, at most
    ``early`` before and ``late`` after the state (both ends included): every
    score with each of its verdicts, and with nulls where none can come any
    more (``how="left"``), or the pairs only (``"inner"``).

    On streams both sides have a watermark, and the time range tells Spark
    when a waiting row cannot find a partner any more: its state is dropped,
    and an unmatched score comes out then.  Rows behind their watermark are
    dropped.  The same call on tables is the batch join.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    s = with_instant(scores, score_time).withColumnRenamed(EVENT_INSTANT, "_score_at").withWatermark("_score_at", score_delay)
    v = with_instant(verdicts, verdict_time).withColumnRenamed(EVENT_INSTANT, "_verdict_at").withColumnRenamed(key, "_verdict_key") \
        .withWatermark("_verdict_at", verdict_delay)
    match = F.expr(f"`{key}` = _verdict_key AND _verdict_at >= _score_at - INTERVAL {early} AND _verdict_at <= _score_at + INTERVAL {late}")
    return s.join(v, match, how).drop("_score_at", "_verdict_at", "_verdict_key")


def unprocessed_files(listed: DataFrame, processed: DataFrame, col: str = "path") -> DataFrame:
    """SE2 batch form of "files not yet processed": an anti join of the
    current listing against the processed log (the streaming file source
    keeps this log in its checkpoint instead).  Empty files are skipped."""
    live = listed.filter(F.col("length") > 0) if "length" in listed.columns else listed
    return live.join(processed.select(col).distinct(), col, "left_anti")


def process_new_files(spark: SparkSession, source: str, target: str, log: str, schema: T.StructType, transform,
                      pattern: str = "part-*.parquet") -> DataFrame:
    """SNK8 as a batch job that fails the file, not the run: the files that
    ``log`` does not have as done are read together, a file that cannot be
    opened is left out and logged as failed (and tried again next time), all
    others are transformed, written as one load, and logged as done.  Returns
    the log of this run: (path, length, status, load).

    Only the paths of the new files pass the driver, as for any read.  The
    load is written before the log, so a run that dies in between is repeated
    under the same load id (a digest of its files) and replaces its own load."""
    listed = list_files(spark, source, pattern)
    logged = F.col("status") == "done"
    try:
        done = spark.read.parquet(log).where(logged).select("path")
    except AnalysisException:  # no run yet
        done = spark.createDataFrame([], "path string")
    new = stage_table(unprocessed_files(listed, done).select("path", "length"), "new-files")
    paths = sorted(r["path"] for r in new.select("path").collect())
    load = hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]
    if paths:
        rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths).withColumn("_file", F.col("_metadata.file_path"))
        rows = stage_table(rows, "new-rows")  # what could be read, once
        seen = rows.select("_file").distinct()
        transform(rows.drop("_file")).write.mode("overwrite").parquet(f"{target.rstrip('/')}/load={load}")
    else:
        seen = spark.createDataFrame([], "_file string")
    decoded = F.url_decode(F.regexp_replace(F.col("_file"), "\\+", "%2B"))
    same = F.regexp_replace(decoded, "^file:/+", "file:/") == F.regexp_replace("path", "^file:/+", "file:/")
    status = F.when(F.col("_file").isNull(), "failed").otherwise("done").alias("status")
    out = stage_table(new.join(seen, same, "left").select("path", "length", status, F.lit(load).alias("load")), "file-log")
    out.write.mode("append").parquet(log)
    return out


def list_files(spark: SparkSession, path: str, pattern: str = "part-*.parquet") -> DataFrame:
    """Listing of landed files (path, length, modificationTime) as a DataFrame."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
            .select("path", "length", "modificationTime"))
