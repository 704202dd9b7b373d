"""Chunked keyed scans must equal the plain one-partition-per-key windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerotrace.operators import series
from aerotrace.sources import fixtures
from paths import SF001

COLS = ["lat", "alt_geom", "squawk", "registration"]


def _plain(df):
    w = Window.partitionBy("icao").orderBy("event_timestamp", "row_id")
    fw = w.rowsBetween(Window.unboundedPreceding, 0)
    bw = w.rowsBetween(0, Window.unboundedFollowing)
    return df.select("row_id",
                     *[F.last(c, True).over(fw).alias(f"ffill_{c}") for c in COLS],
                     *[F.first(c, True).over(bw).alias(f"bfill_{c}") for c in COLS],
                     F.lag("lat").over(w).alias("prev_lat"),
                     F.lead("squawk").over(w).alias("next_squawk"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fill_and_shift_equal_plain_windows(spark):
    t = fixtures.traces(spark, SF001)
    expected = _rows(_plain(t))
    for chunk in (600, 86400 * 3, 86400 * 365):
        s = series.Series.of("icao", "event_timestamp", "row_id", chunk_seconds=chunk)
        filled = series.fill(t, s, forward=COLS, backward=COLS)
        shifted = series.shift(filled, s, lags={"prev_lat": "lat"}, leads={"next_squawk": "squawk"})
        got = shifted.select("row_id", *[f"ffill_{c}" for c in COLS], *[f"bfill_{c}" for c in COLS],
                             "prev_lat", "next_squawk")
        assert _rows(got) == expected, chunk


def test_tail_history_equals_plain_window(spark):
    t = fixtures.traces(spark, SF001).filter(F.col("lat").isNotNull())
    w = Window.partitionBy("icao").orderBy("event_timestamp", "row_id").rowsBetween(-5, -1)
    plain = t.select("row_id", F.collect_list(F.struct("lat", "lon")).over(w).alias("h"))
    expected = _rows(plain)
    s = series.Series.of("icao", "event_timestamp", "row_id", chunk_seconds=3600)
    got = series.tail_history(t, s, ["lat", "lon"], 5, out="h").select("row_id", "h")
    assert _rows(got) == expected


def test_gap_sessions(spark):
    t = fixtures.traces(spark, SF001)
    s = series.Series.of("icao", "event_timestamp", "row_id", chunk_seconds=7200)
    got = series.gap_sessions(t, s, 6 * 3600).select("row_id", "session_start")
    w = Window.partitionBy("icao").orderBy("event_timestamp", "row_id")
    prev = F.lag("event_timestamp").over(w)
    flagged = t.select("icao", "event_timestamp", "row_id",
                       F.when(prev.isNull() | (F.col("event_timestamp") > prev + F.expr("INTERVAL 6 HOURS")),
                              F.col("event_timestamp")).alias("st"))
    plain = flagged.select("row_id", F.last("st", True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)).alias("session_start"))
    assert _rows(got) == _rows(plain)


def test_hot_chunks_split_by_row_count_equal_plain_windows(spark):
    """Chunks above ``max_chunk_rows`` are cut finer until all fit, with hot
    chunks broadcast or joined by shuffle.  Results never change."""
    t = fixtures.traces(spark, SF001)
    expected = _rows(_plain(t))
    for limit in (1, 100_000):
        s = series.Series.of("icao", "event_timestamp", "row_id", chunk_seconds=86400 * 365,
                             max_chunk_rows=3, broadcast_chunks=limit)
        d = s.with_chunk(t)
        per_chunk = d.groupBy("icao", series.CHUNK).count()
        assert per_chunk.agg(F.max("count")).first()[0] <= 3
        assert d.count() == t.count()
        filled = series.fill(t, s, forward=COLS, backward=COLS)
        shifted = series.shift(filled, s, lags={"prev_lat": "lat"}, leads={"next_squawk": "squawk"})
        got = shifted.select("row_id", *[f"ffill_{c}" for c in COLS], *[f"bfill_{c}" for c in COLS],
                             "prev_lat", "next_squawk")
        assert _rows(got) == expected, limit
    s = series.Series.of("icao", "event_timestamp", "row_id", chunk_seconds=86400 * 365, max_chunk_rows=3)
    tl = t.filter(F.col("lat").isNotNull())
    w = Window.partitionBy("icao").orderBy("event_timestamp", "row_id").rowsBetween(-5, -1)
    plain = tl.select("row_id", F.collect_list(F.struct("lat", "lon")).over(w).alias("h"))
    got = series.tail_history(tl, s, ["lat", "lon"], 5, out="h").select("row_id", "h")
    assert _rows(got) == _rows(plain)


def test_whole_and_cut_keys_equal_plain_windows(spark):
    """Keys of up to ``whole_rows`` rows are one chunk, longer ones are cut:
    all, some (a null key and null times among them) or none."""
    t = fixtures.traces(spark, SF001).withColumns({
        "icao": F.when(F.col("row_id") % 7 != 0, F.col("icao")),
        "event_timestamp": F.when(F.col("row_id") % 11 != 0, F.col("event_timestamp"))})
    rows = lambda df: sorted(map(str, df.collect()))
    expected = rows(_plain(t))
    w = Window.partitionBy("icao").orderBy("event_timestamp", "row_id").rowsBetween(-5, -1)
    histories = rows(t.select("row_id", F.collect_list(F.struct("squawk")).over(w).alias("h")))
    for limit in (1, 80, 10_000):
        s = series.Series.of("icao", "event_timestamp", "row_id", whole_rows=limit, broadcast_chunks=limit)
        filled = series.fill(t, s, forward=COLS, backward=COLS)
        shifted = series.shift(filled, s, lags={"prev_lat": "lat"}, leads={"next_squawk": "squawk"})
        got = shifted.select("row_id", *[f"ffill_{c}" for c in COLS], *[f"bfill_{c}" for c in COLS],
                             "prev_lat", "next_squawk")
        assert rows(got) == expected, limit
        got = series.tail_history(t, s, ["squawk"], 5, out="h").select("row_id", "h")
        assert rows(got) == histories, limit


def test_short_series_are_scanned_with_one_exchange(spark):
    """Backfill, lags and histories of aircraft that fit a task exchange the
    rows once and build no summary and no carry rows."""
    from aerotrace.operators import ml
    from aerotrace.operators.backfill import backfill
    from aerotrace.operators.clean import clean_traces
    from aerotrace.session import stage_table
    t = stage_table(fixtures.traces(spark, SF001), "short-series")
    clean = stage_table(clean_traces(t), "short-series")
    feats = ml.angle_features(ml.usable_rows(clean))
    for df in (backfill(t), ml.flight_features(clean), ml.sequence_windows(feats)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" not in plan and "Aggregate" not in plan
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_silver_shuffles_wide_rows_once(spark, monkeypatch):
    """Dedup and fills of aircraft that fit a task run where one exchange put
    the rows, nothing is staged, and a large table takes partitions by its
    rows; a longer aircraft goes the staged way.  The rows are the same."""
    from aerotrace.functions import constants as K
    from aerotrace.plans import medallion
    t = fixtures.traces_dup(spark, SF001).withColumns({
        "icao": F.when(F.col("row_id") % 7 != 0, F.col("icao")),
        "event_timestamp": F.when(F.col("row_id") % 11 != 0, F.col("event_timestamp"))})
    rows = lambda df: sorted(map(str, df.collect()))
    expected = rows(medallion.silver(t))
    assert expected
    got = medallion.silver(t, rescan=True)
    assert rows(got) == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    assert set(got.inputFiles()) == set(t.inputFiles())
    monkeypatch.setattr(series, "TASK_ROWS", 20)
    small = medallion.silver(t, rescan=True)
    assert rows(small) == expected
    plan = small._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert f"{-(-t.count() // 20)}), REPARTITION_BY_NUM" in plan
    monkeypatch.setattr(K, "WHOLE_SERIES_ROWS", 3)
    long = medallion.silver(t, rescan=True)
    assert rows(long) == expected and not set(long.inputFiles()) & set(t.inputFiles())


def test_staged_tables_are_written_in_compiled_pieces(spark, monkeypatch):
    """The method limit holds for the write only, and a session's own stays."""
    from aerotrace.plans import medallion
    seen, write = [], medallion.stage_table
    monkeypatch.setattr(medallion, "stage_table",
                        lambda df, name: seen.append(spark.conf.get(medallion.METHOD_LIMIT)) or write(df, name))
    before = spark.conf.get(medallion.METHOD_LIMIT)
    assert medallion.stage(spark.range(3), "limit").count() == 3
    assert seen == ["8000"] and spark.conf.get(medallion.METHOD_LIMIT) == before
    spark.conf.set(medallion.METHOD_LIMIT, "20000")
    try:
        medallion.stage(spark.range(3), "limit")
        assert seen[1] == spark.conf.get(medallion.METHOD_LIMIT) == "20000"
    finally:
        spark.conf.unset(medallion.METHOD_LIMIT)
