"""Hand-made edge rows for each rule branch, plus operator laws."""

import datetime as dt
import json
import math
import os
import tempfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from aerotrace.operators import bronze, clean, enrich, joins, live, ml, panels, star
from aerotrace.operators.backfill import backfill
from aerotrace.operators.dedup import dedup
from aerotrace.plans import medallion
from aerotrace.sources import fixtures as fx
from paths import SF001


def one(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_altitude_band_boundaries(spark):
    df = one(spark, [(9999.99, False), (10000.0, False), (24999.99, False), (25000.0, None),
                     (40000.0, False), (None, True), (None, None), (500.0, True)],
             "alt double, ground boolean")
    got = [r[0] for r in df.select(panels.altitude_band("ground", "alt")).collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "VERY_HIGH", "GROUND", "UNKNOWN", "GROUND"]


def test_phase_and_climb_strict_bounds(spark):
    df = one(spark, [(2.5, False), (2.51, False), (-2.5, None), (-2.51, False), (None, False), (9.0, True)],
             "vertical_rate double, on_ground boolean")
    assert [r[0] for r in df.select(live.flight_phase()).collect()] == \
        ["CRUISE", "CLIMB", "CRUISE", "DESCENT", "CRUISE", "GROUND"]
    df2 = one(spark, [(300.0, False), (300.5, False), (-300.0, False), (-301.0, False), (None, False),
                      (900.0, True)], "resolved_vert_rate double, is_on_ground boolean")
    assert [r[0] for r in df2.select(enrich.climb_state()).collect()] == \
        ["LEVEL", "CLIMB", "LEVEL", "DESCENT", "LEVEL", "ON_GROUND"]


def test_callsign_rules(spark):
    raw = ["UNKNOWN", "UAL12", "X", "ABCDEFGHIJKLM", "ual12", "   ", None, "N12 AB"]
    df = one(spark, [(x,) for x in raw], "flight string")
    cleaned = df.select(clean.valid_callsign().alias("flight"))
    assert [r[0] for r in cleaned.collect()] == ["UNKNOWN", "UAL12", None, None, "UAL12", None, None,
                                                 "N12 AB"]
    classes = [r[0] for r in cleaned.select(enrich.callsign_class()).collect()]
    assert classes == ["GENERAL_AVIATION", "AIRLINE", "UNKNOWN", "UNKNOWN", "AIRLINE", "UNKNOWN",
                       "UNKNOWN", "OTHER"]


def test_squawk_and_emergency(spark):
    df = one(spark, [("7700", "NONE"), ("0000", "NONE"), ("8000", "NONE"), ("77", "NONE"),
                     (None, "NONE"), (None, "LIFEGUARD"), ("1200", "OTHER"), ("7500", "NO")],
             "squawk string, emergency string")
    sq = df.select(clean.valid_squawk().alias("squawk"), "emergency")
    assert [r[0] for r in sq.collect()] == ["7700", "0000", None, None, None, None, "1200", "7500"]
    assert [r[0] for r in sq.select(enrich.squawk_category()).collect()] == \
        ["GENERAL_EMERGENCY", "NORMAL", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", "NORMAL", "HIJACK"]
    assert [r[0] for r in sq.select(enrich.has_emergency()).collect()] == \
        [True, False, False, False, False, True, False, True]
    em = one(spark, [(x,) for x in [" lifeguard ", "", None, "nordo", "weird", "RESERVED"]], "emergency string")
    assert [r[0] for r in em.select(clean.emergency_enum()).collect()] == \
        ["LIFEGUARD", "NONE", "NONE", "NORDO", "OTHER", "RESERVED"]


def test_hex_and_alt_baro(spark):
    df = one(spark, [("UNKNOWN",), ("~a1b2c3",), ("",), ("4b1804",), (None,)], "icao24 string")
    assert [r[0] for r in df.select(live.hex_to_long("icao24")).collect()] == [None, None, None, 4921348, None]
    alts = one(spark, [("ground",), ("Ground",), ("abc",), ("-50",), (None,)], "alt_baro string")
    got = alts.select(clean.alt_baro_ft(), clean.on_ground_flag()).collect()
    assert [tuple(r) for r in got] == [(0.0, True), (0.0, True), (None, False), (-50.0, False), (None, False)]


def test_position_type_enum(spark):
    df = one(spark, [(x,) for x in ["adsr-icao", "mode_s", "ADSC", " ", None, "tisb_other"]], "position_type string")
    assert [r[0] for r in df.select(clean.position_type_enum()).collect()] == \
        ["ADSR_ICAO", "MODE_S", "ADSC", "OTHER", "OTHER", "OTHER"]


def test_category_maps(spark):
    df = one(spark, [(8, "B1"), (13, "C4"), (None, None), (99, "b7")], "code int, category string")
    got = df.select(live.emitter_category_label("code"),
                    live.map_lookup(live.K.FEED_CATEGORY, "code", "A3"),
                    enrich.category_label(F.upper("category"))).collect()
    assert [tuple(r) for r in got] == [("ROTORCRAFT", "B1", "Glider / Sailplane"),
                                       ("RESERVED", "A3", "Unknown category"),
                                       ("UNKNOWN", "A3", "Unknown category"),
                                       ("UNKNOWN", "A3", "Space Vehicle")]


def test_surrogate_key_is_null_safe(spark):
    df = one(spark, [(None, "a"), ("a", None), ("a", "b"), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(star.surrogate_key("x", "y")).collect()]
    assert keys[0] != keys[1] and keys[2] == keys[3] and all(k >= 0 for k in keys)
    # values that hold the marks of the key's own text form
    odd = ["", "n", "|", "a|b", "1:a", "a", "c", "b|c", "0:", None, "\u0001"]
    pairs = [(x, y) for x in odd for y in odd]
    df = one(spark, pairs, "x string, y string")
    assert df.select(star.identity_key("x", "y").alias("k")).distinct().count() == len(pairs)
    assert df.select(star.surrogate_key("x", "y").alias("k")).distinct().count() == len(pairs)


def test_dedup_idempotent_and_latest_ingest_wins(spark):
    dup = fx.traces_dup(spark, SF001)
    once = dedup(dup)
    twice = dedup(once)
    assert once.count() == twice.count() == fx.traces(spark, SF001).count()
    survivors = once.filter(F.col("row_id") >= 1_000_000_000).count()
    # copies carry a later ingest (when the original had one) and must win
    expected = fx.traces(spark, SF001).filter((F.col("row_id") % 50 == 0)
                                             & F.col("ingestion_ts").isNotNull()).count()
    assert survivors >= expected


def test_dedup_survivor_does_not_depend_on_partitioning(spark):
    """42 columns, no row_id, copies with one ingestion time: the survivor is
    the same under any partitioning, and the first source file wins."""
    t = fx.traces(spark, SF001).drop("row_id").limit(5)
    copies = t.crossJoin(spark.range(40)).withColumn("roll", F.col("id").cast("double")).withColumn(
        "source_file", F.when(F.col("id") % 4 == 0, "b.json").otherwise("a.json")).drop("id")
    seen = set()
    for n in (1, 2, 3, 7, 16):
        out = dedup(copies.repartition(n, F.rand(n)))
        assert out.count() == 5 and out.where("source_file <> 'a.json'").count() == 0
        seen.add(tuple(sorted((r.icao, r.roll) for r in out.collect())))
    assert len(seen) == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_backfill_never_changes_non_null(spark):
    t = fx.traces(spark, SF001)
    b = backfill(t)
    cols = ["lat", "squawk", "registration", "roll", "nav_heading"]
    joined = t.alias("a").join(b.alias("b"), "row_id")
    for c in cols:
        assert joined.filter(F.col(f"a.{c}").isNotNull() & (F.col(f"a.{c}") != F.col(f"b.{c}"))).count() == 0


def test_every_fact_key_exists_in_its_dimension(spark):
    g = medallion.gold(fx.traces(spark, SF001))
    tables = star.build_star(g)
    f = tables["fact_flight_trace"]
    for name, (key, _) in star.DIMENSIONS.items():
        missing = f.join(tables[name], key, "left_anti").count()
        assert missing == 0, name
    assert star.star_join(g).count() == f.count()  # unique dims: no fan-out


def test_trace_document_edge_cases(spark):
    docs = [
        json.dumps({"icao": "abc123", "timestamp": 1704067200, "trace": []}),
        json.dumps({"icao": "abc124", "timestamp": 1704067200}),
        '{"icao": "abc125", "trace": [[0, 1',
        json.dumps({"icao": "abc126", "timestamp": 1704067200.7,
                    "trace": [[1.5, 10.0, 20.0, "ground", 100, 90, 9, -64, None],
                              [2.25, 11.0, 21.0, 12000, 101, 91, None, 0, {"flight": "UAL1 ", "nic": 8},
                               "adsb_icao", 12100, 64, 250, -1.5]]}),
    ]
    raw = spark.createDataFrame([(d, "f.json", dt.date(2024, 1, 1), None) for d in docs],
                                "raw_json string, source_file string, data_date date, ingestion_ts timestamp_ntz")
    flat = bronze.flatten_traces(raw).orderBy("event_timestamp").collect()
    assert len(flat) == 2
    a, b = flat
    assert a.icao == "abc126" and a.alt_baro == "ground" and a.flight is None and a.position_type is None
    assert a.is_stale is True and a.is_geom_alt is True and a.is_new_leg is False
    assert a.event_timestamp == dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    assert b.alt_baro == "12000" and b.flight == "UAL1 " and b.nic == 8 and b.trace_flags is None
    assert b.is_stale is None and b.roll == -1.5 and b.alt_geom == 12100.0


def test_read_trace_files_strips_outer_array(spark):
    d = tempfile.mkdtemp(prefix="aerotrace-test-", dir="/tmp")
    doc = {"icao": "abc200", "timestamp": 1704067200, "trace": [[0, 1.0, 2.0, 100]]}
    with open(os.path.join(d, "trace_full_abc200.json"), "w") as f:
        json.dump(doc, f)
    with open(os.path.join(d, "trace_full_many.json"), "w") as f:
        json.dump([doc, dict(doc, icao="abc201")], f)
    with open(os.path.join(d, "other.json"), "w") as f:
        json.dump(doc, f)
    raw = bronze.read_trace_files(spark, d, "2024-01-01")
    flat = bronze.flatten_traces(raw)
    assert sorted(r.icao for r in flat.collect()) == ["abc200", "abc200", "abc201"]
    assert all(r.source_file.endswith(".json") and "other" not in r.source_file for r in flat.collect())


def test_hybrid_labels(spark):
    rows = [("A", 5.0, 5.0, 0.0, 0.0, 0.0, 0.0, None), ("B", None, None, None, None, None, None, True),
            ("C", 6.0, 1.0, 1000.0, 0.0, 0.0, 0.0, False), ("D", 6.0, 0.0, 0.0, 0.0, 0.0, 6.0, True)]
    df = one(spark, rows, "icao string, xgb_anomaly_score double, position_error_km double, "
                          "altitude_error_ft double, ground_speed_error double, vert_rate_error double, "
                          "track_error double, chronos_confirmed boolean")
    df = df.withColumn("event_timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    verdicts = df.where("chronos_confirmed IS NOT NULL").select(
        "icao", "event_timestamp", F.lit(0.5).alias("chronos_score"), "chronos_confirmed")
    out = ml.hybrid(df.drop("chronos_confirmed"), verdicts).orderBy("icao").select(
        "icao", "xgb_is_anomaly", "primary_anomaly_reason", "hybrid_anomaly_label").collect()
    assert [tuple(r) for r in out] == [("A", True, "POSITION", True), ("B", False, "POSITION", False),
                                       ("C", True, "POSITION", False), ("D", True, "TRACK", True)]


@pytest.mark.parametrize("n,expected", [(32, 0), (33, 1), (40, 8)])
def test_sequence_window_counts(spark, n, expected):
    base = dt.datetime(2024, 1, 1)
    rows = [Row(icao="X", event_timestamp=base + dt.timedelta(seconds=37 * i), row_id=i,
                lat=float(i), lon=0.0, resolved_altitude=0.0, ground_speed=0.0,
                resolved_vert_rate=0.0, track_sin=0.0, track_cos=1.0) for i in range(n)]
    df = spark.createDataFrame(rows).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
    s = ml.Series.of("icao", "event_timestamp", "row_id", chunk_seconds=300)
    w = ml.sequence_windows(df, 32, s)
    got = w.collect()
    assert len(got) == expected
    for r in got:
        assert [h.lat for h in r.history] == [float(x) for x in range(r.row_id - 32, r.row_id)]


def test_range_join_boundaries(spark):
    ranges = one(spark, [(16, 31, "P"), (4096, 8191, "Q")], "range_start long, range_end long, country string")
    pts = one(spark, [(15,), (16,), (31,), (32,), (4095,), (4096,), (8191,), (None,)], "v long")
    for limit in (256, 257):  # 1 + 256 expanded rows: shuffle join beyond the bound, broadcast within it
        j = joins.range_lookup(pts, ranges, "v", bucket_bits=4, max_broadcast_rows=limit)
        hinted = "broadcast" in j._jdf.queryExecution().analyzed().toString().lower()
        assert hinted == (limit == 257)
        got = j.orderBy("v").collect()
        assert [(r.v, r.country) for r in got] == [(None, None), (15, None), (16, "P"), (31, "P"), (32, None),
                                                   (4095, None), (4096, "Q"), (8191, "Q")]


def test_retention_uses_given_as_of(spark):
    from aerotrace.streaming.sinks import expire
    df = one(spark, [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 20),)], "event_time timestamp_ntz")
    assert expire(df, "2024-02-05 00:00:00", 30).count() == 1


def _sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_aircraft_days_are_one_document_unless_long(spark):
    """Without ``slice_minutes`` a day is one document;
    a day of more than ``max_points`` reports is cut."""
    t = fx.traces(spark, SF001)
    days = bronze.trace_documents(t)
    assert days.count() == t.select("icao", "data_date").distinct().count()
    busy = t.withColumn("icao", F.when(F.col("row_id") % 2 == 0, "a00001").otherwise(F.col("icao")))
    cut = bronze.trace_documents(busy, max_points=4)
    assert cut.select(F.max(F.size(F.from_json(F.get_json_object("raw_json", "$.trace"), "array<string>")))).first()[0] <= 4
    assert _sorted_rows(bronze.flatten_traces(cut)) == _sorted_rows(bronze.flatten_traces(bronze.trace_documents(busy)))


def test_document_and_payload_slices_do_not_change_rows(spark):
    """Documents are cut by time and number of reports, payloads by the position
    of a record; flattening / unpacking gives the same rows."""
    from aerotrace.sources.states import state_payloads, unpack_states
    t = fx.traces(spark, SF001)
    whole = bronze.trace_documents(t, slice_minutes=1440)
    assert whole.count() == t.select("icao", "data_date").distinct().count()
    fine = bronze.trace_documents(t, slice_minutes=1)
    assert fine.count() == t.select("icao", F.date_trunc("minute", "event_timestamp")).distinct().count()
    assert _sorted_rows(bronze.flatten_traces(fine)) == _sorted_rows(bronze.flatten_traces(whole))
    small = bronze.trace_documents(t, slice_minutes=1440, max_points=2)
    assert small.select(F.max(F.size(F.from_json(F.get_json_object("raw_json", "$.trace"), "array<string>")))).first()[0] <= 2
    assert _sorted_rows(bronze.flatten_traces(small)) == _sorted_rows(bronze.flatten_traces(whole))
    st = fx.states(spark, SF001)
    one_part = state_payloads(st, poll_seconds=3600, rows_per_payload=10**6)
    many = state_payloads(st, poll_seconds=3600, rows_per_payload=7)
    sizes = [r.n for r in many.select(F.size(F.from_json(F.get_json_object("payload", "$.states"), "array<string>")).alias("n")).collect()]
    assert many.count() > one_part.count() and max(sizes) == 7
    assert _sorted_rows(unpack_states(many).drop("sensors")) == _sorted_rows(unpack_states(one_part).drop("sensors"))


def test_category_thresholds_are_exact_on_a_million_rows(spark):
    """Beyond any sketch's capacity the threshold is still the exact order
    statistic, for a hot category, a small one and one without scores."""
    n = 1_200_000
    df = spark.range(n).select(
        F.when(F.col("id") % 1000 == 0, "small").when(F.col("id") % 1000 == 1, None).otherwise("hot").alias("category"),
        (F.pmod(F.xxhash64("id"), F.lit(10**12)) / 1e9).alias("xgb_anomaly_score"))
    df = df.unionByName(spark.createDataFrame([("none", None)], "category string, xgb_anomaly_score double"))
    pdf = df.toPandas()
    got = {r.category: r.threshold for r in ml.category_thresholds(df).collect()}

    def exact(scores):
        scores = sorted(scores)
        return scores[max(1, math.ceil(len(scores) * 0.99)) - 1]
    scored = pdf.dropna(subset=["xgb_anomaly_score"])
    groups = scored.assign(category=scored["category"].fillna("")).groupby("category")["xgb_anomaly_score"]
    want = {k or None: exact(v) for k, v in groups}
    assert got == want | {"none": exact(scored["xgb_anomaly_score"])}


def test_daily_coverage_and_position_types_are_ordered(spark):
    from aerotrace.operators import panels
    t = fx.traces(spark, SF001).repartition(7)
    days = [r.data_date for r in panels.val_daily_coverage(t).collect()]
    assert days == sorted(days) and len(days) > 3
    records = [r.records for r in panels.val_position_types(t).collect()]
    assert records == sorted(records, reverse=True) and len(records) > 3


def test_staging_needs_a_shared_folder_off_local():
    from aerotrace.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_changed_input_builds_the_tables_anew(spark):
    import shutil

    from aerotrace.plans import catalog
    d = tempfile.mkdtemp(prefix="aerotrace-test-", dir="/tmp")
    for name in ("events", "nation"):
        shutil.copyfile(os.path.join(SF001, f"{name}.parquet"), os.path.join(d, f"{name}.parquet"))
    before = catalog.silver(spark, d).count()
    events = spark.read.parquet(os.path.join(SF001, "events.parquet"))
    less = events.where(F.col("user_id") % 2 == 0).toPandas()
    less.to_parquet(os.path.join(d, "events.parquet"), coerce_timestamps="us")
    spark.catalog.refreshByPath(os.path.join(d, "events.parquet"))
    assert 0 < catalog.silver(spark, d).count() < before


def test_label_maps_from_configuration(spark):
    from aerotrace.functions.exprs import read_map
    from aerotrace.operators import enrich, live
    d = tempfile.mkdtemp(prefix="aerotrace-test-", dir="/tmp")
    text = os.path.join(d, "map.yaml")
    with open(text, "w", encoding="utf-8") as f:
        f.write('# codes\nA1: Light\n"A2": "Small: one"  # quoted\n3: \'Rotor # craft\'\n\n')
    assert read_map(text) == {"A1": "Light", "A2": "Small: one", "3": "Rotor # craft"}
    with open(os.path.join(d, "map.json"), "w", encoding="utf-8") as f:
        f.write('{"3": "Glider"}')
    df = one(spark, [("A2", 3), ("zz", 4)], "category string, code int")
    got = df.select(enrich.category_label("category", read_map(text)), live.emitter_category_label("code", read_map(os.path.join(d, "map.json")))).collect()
    assert [tuple(r) for r in got] == [("Small: one", "Glider"), ("Unknown category", "UNKNOWN")]
    with open(text, "a", encoding="utf-8") as f:
        f.write("no colon here\n")
    with pytest.raises(ValueError, match="label"):
        read_map(text)
