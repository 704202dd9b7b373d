"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, base_dir)``, reads the driver tables under
``base_dir`` (through the fixture views) and returns a DataFrame.  Queries
that need a staged intermediate (silver, scored features, the tables of a
keyed scan) run the jobs that write it when they are built.
``ORACLE[name]`` holds the same computation as DuckDB SQL over the same
tables, for the cross-engine correctness check.  Float outputs that pass
through transcendental functions are rounded to 6 digits in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerotrace.functions import constants as K
from aerotrace.functions.exprs import hex_to_long, identity_key, null_if_blank, round6, surrogate_key
from aerotrace.operators import backfill as bf
from aerotrace.operators import clean as cl
from aerotrace.operators import enrich as en
from aerotrace.operators import joins, live, ml, panels, star
from aerotrace.operators.dedup import dedup
from aerotrace.plans import medallion
from aerotrace.plans import oracle as O
from aerotrace.session import drop_staged
from aerotrace.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared inputs
def traces(spark, b):
    return fx.traces(spark, b)


def states(spark, b):
    return fx.states(spark, b)


# Medallion tables (silver, scored features) are materialised once per
# session and input directory and then read by every downstream query, as
# the tables they are; each query still starts from the given tables.
# A table is built anew when the files under the input directory change.
_TABLES: dict[tuple, tuple] = {}


def _table(spark, b, name, build):
    key, version = (spark.sparkContext.applicationId, b.rstrip("/"), name), fx.version(spark, b)
    held = _TABLES.get(key)
    if held is None or held[0] != version:
        if held is not None:
            drop_staged(held[1])
        _TABLES[key] = (version, medallion.stage(build(), name))
    return _TABLES[key][1]


def silver(spark, b):
    return _table(spark, b, "silver", lambda: medallion.silver(fx.traces(spark, b), rescan=True))


def gold(spark, b):
    from aerotrace.operators.enrich import enrich
    return enrich(silver(spark, b))


def live_table(spark, b):
    return live.transform_states(fx.states(spark, b))


def scored(spark, b):
    return _table(spark, b, "scored", lambda: ml.residuals(ml.persistence_predictions(
        ml.flight_features(silver(spark, b)))))


def column_queries(prefix_base: str, base: Callable, sql_head: str, sql_from: str,
                   items: dict[str, tuple[Callable[[], dict[str, Column]], dict[str, str]]],
                   key="row_id"):
    """Register one query per row-level expression: (key, outputs...)."""
    for name, (spark_cols, sql_cols) in items.items():
        def fn(spark, b, _cols=spark_cols):
            return base(spark, b).select(key, *[c.alias(n) for n, c in _cols().items()])
        sql = (sql_head + f"SELECT {key}, "
               + ", ".join(f"{v} AS {k}" for k, v in sql_cols.items()) + f" FROM {sql_from}")
        register(name, sql)(fn)


# ---------------------------------------------------------------------------
# 2.1 sources
def _state_json():
    return F.to_json(F.struct(*[F.col(c) for c in O.STATE_COLS]))


@register("scan_table", fx.oracle_ctes("traces") + "SELECT * FROM traces")
def q_scan_table(spark, b):
    return fx.traces(spark, b)


def _state_json_rows(spark, b):
    st = fx.states(spark, b)
    # every 97th record arrives truncated (malformed JSON)
    js = F.when(F.col("row_id") % 97 == 0, F.substring(_state_json(), 1, 20)).otherwise(_state_json())
    return st.select("row_id", js.alias("value"))


@register("parse_state_json",
          fx.oracle_ctes("states") + "SELECT row_id, "
          + ", ".join(f"CASE WHEN row_id % 97 = 0 THEN NULL ELSE {c} END AS {c}" for c in O.STATE_COLS)
          + " FROM states")
def q_parse_state_json(spark, b):
    from aerotrace.sources.states import parse_states
    return parse_states(_state_json_rows(spark, b)).drop("sensors")


@register("unpack_state_array",
          fx.oracle_ctes("states") + "SELECT "
          + ", ".join(f"CASE WHEN row_id % 89 = 0 AND '{c}' IN ('spi', 'position_source', 'category') "
                      f"THEN NULL ELSE {c} END AS {c}" for c in O.STATE_COLS)
          + " FROM states")
def q_unpack_state_array(spark, b):
    from aerotrace.sources.states import state_payloads, unpack_states
    # fixture records are a minute apart: one payload per hour of records
    return unpack_states(state_payloads(fx.states(spark, b), poll_seconds=3600)).drop("sensors")


# ---------------------------------------------------------------------------
# 2.3 live projections (per expression) and the composed transform
_S = fx.oracle_ctes("states")
_LIVE_BAND = ("CASE WHEN on_ground = true THEN 'GROUND' WHEN {a} IS NULL THEN 'UNKNOWN' "
              "WHEN {a} < 10000 THEN 'LOW' WHEN {a} < 25000 THEN 'MEDIUM' "
              "WHEN {a} < 40000 THEN 'HIGH' ELSE 'VERY_HIGH' END")
# Spark rounds the shortest decimal form of a double HALF_UP; DuckDB rounds the
# binary value, so the oracle rounds that decimal text to state the same rule.


def _round2(x: str) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12)), 2) AS DOUBLE)"


_ALT_FT = _round2("coalesce(baro_altitude, geo_altitude) * 3.28084")
LIVE_SQL = {
    "icao24": "coalesce(icao24, 'UNKNOWN')",
    "callsign": "coalesce(trim(callsign), '')",
    "event_time": "make_timestamp(coalesce(last_contact, time_position) * 1000000)",
    "altitude_ft": _ALT_FT,
    "altitude_band": _LIVE_BAND.format(a=_ALT_FT),
    "velocity_kmh": _round2("velocity * 3.6"),
    "velocity_knots": _round2("velocity * 1.94384"),
    "flight_phase": ("CASE WHEN on_ground = true THEN 'GROUND' WHEN vertical_rate > 2.5 THEN 'CLIMB' "
                     "WHEN vertical_rate < -2.5 THEN 'DESCENT' ELSE 'CRUISE' END"),
    "spi": "coalesce(CAST(spi AS TINYINT), CAST(0 AS TINYINT))",
    "on_ground": "coalesce(CAST(on_ground AS TINYINT), CAST(0 AS TINYINT))",
    "squawk": "coalesce(squawk, '')",
    "position_source": O.case_map("position_source", K.POSITION_SOURCE, "UNKNOWN", False),
    "aircraft_category": O.case_map("category", K.LIVE_CATEGORY, "UNKNOWN", False),
    "icao24_int": ("CASE WHEN regexp_matches(coalesce(icao24, 'UNKNOWN'), '^[0-9A-Fa-f]{6}$') "
                   "THEN CAST(('0x' || coalesce(icao24, 'UNKNOWN')) AS BIGINT) END"),
}
column_queries("live", states, _S, "states", {
    "icao_default": (lambda: {"icao24": live.icao_default()}, {"icao24": LIVE_SQL["icao24"]}),
    "callsign_trim": (lambda: {"callsign": live.callsign_trim()}, {"callsign": LIVE_SQL["callsign"]}),
    "event_time": (lambda: {"event_time": live.event_time()}, {"event_time": LIVE_SQL["event_time"]}),
    "altitude_ft": (lambda: {"altitude_ft": live.altitude_ft()}, {"altitude_ft": LIVE_SQL["altitude_ft"]}),
    "altitude_band": (lambda: {"altitude_band": panels.altitude_band("on_ground", "_a")},
                      {"altitude_band": LIVE_SQL["altitude_band"]}),
    "velocity_units": (lambda: live.velocity_units(), {k: LIVE_SQL[k] for k in ("velocity_kmh", "velocity_knots")}),
    "flight_phase": (lambda: {"flight_phase": live.flight_phase()}, {"flight_phase": LIVE_SQL["flight_phase"]}),
    "bool_to_byte": (lambda: {"spi": live.bool_to_byte("spi"), "on_ground": live.bool_to_byte("on_ground")},
                     {"spi": LIVE_SQL["spi"], "on_ground": LIVE_SQL["on_ground"]}),
    "squawk_blank": (lambda: {"squawk": live.squawk_blank()}, {"squawk": LIVE_SQL["squawk"]}),
    "position_source_label": (lambda: {"position_source": live.position_source_label()},
                              {"position_source": LIVE_SQL["position_source"]}),
    "emitter_category_label": (lambda: {"aircraft_category": live.emitter_category_label()},
                               {"aircraft_category": LIVE_SQL["aircraft_category"]}),
    "icao_to_int": (lambda: {"icao24_int": hex_to_long(live.icao_default())},
                    {"icao24_int": LIVE_SQL["icao24_int"]}),
    "cast_double": (lambda: {c: F.col(c).cast("double") for c in ("latitude", "longitude", "baro_altitude",
                                                          "geo_altitude", "vertical_rate", "true_track")},
                    {c: f"CAST({c} AS DOUBLE)" for c in ("latitude", "longitude", "baro_altitude",
                                                         "geo_altitude", "vertical_rate", "true_track")}),
})
# altitude_band needs the computed altitude first
QUERIES["altitude_band"] = lambda spark, b: states(spark, b).withColumn("_a", live.altitude_ft()) \
    .select("row_id", panels.altitude_band("on_ground", "_a").alias("altitude_band"))

LIVE_OUT = ["icao24", "callsign", "origin_country", "time_position", "last_contact", "event_time",
            "latitude", "longitude", "baro_altitude", "geo_altitude", "altitude_ft", "altitude_band",
            "velocity", "velocity_kmh", "velocity_knots", "vertical_rate", "flight_phase", "true_track",
            "squawk", "spi", "on_ground", "position_source", "category", "aircraft_category", "row_id",
            "icao24_int"]
LIVE_TABLE_SQL = ("SELECT " + ", ".join(f"{LIVE_SQL.get(c, c)} AS {c}" for c in LIVE_OUT) + " FROM states")


@register("live_transform", _S + LIVE_TABLE_SQL)
def q_live_transform(spark, b):
    return live_table(spark, b)


@register("drop_sensors", _S.rstrip("\n") + ",\nparsed AS (SELECT row_id, "
          + ", ".join(f"CASE WHEN row_id % 97 = 0 THEN NULL ELSE {c} END AS {c}" for c in O.STATE_COLS)
          + " FROM states)\n" + LIVE_TABLE_SQL.replace("FROM states", "FROM parsed"))
def q_drop_sensors(spark, b):
    from aerotrace.sources.states import parse_states
    return live.transform_states(parse_states(_state_json_rows(spark, b)))


# ---------------------------------------------------------------------------
# 2.4 serving feed
FEED_SQL = {
    "icao": "upper(icao24)",
    "segment_id": "CAST(NULL AS VARCHAR)",
    "event_unix_ts": "last_contact",
    "lat": "latitude",
    "lon": "longitude",
    "resolved_altitude": "round(baro_altitude * 3.28084, 6)",
    "ground_speed": "round(velocity * 1.94384, 6)",
    "resolved_vert_rate": "round(vertical_rate * 196.85, 6)",
    "track_sin": "round(sin(radians(true_track)), 6)",
    "track_cos": "round(cos(radians(true_track)), 6)",
    "nav_heading_sin": "round(sin(radians(true_track)), 6)",
    "nav_heading_cos": "round(cos(radians(true_track)), 6)",
    "category": O.case_map("category", K.FEED_CATEGORY, "A3", False),
    "flight": "trim(coalesce(callsign, ''))",
    "nic": "8",
    "sil": "3",
}
_ROUNDED_FEED = {"resolved_altitude", "ground_speed", "resolved_vert_rate", "track_sin", "track_cos",
                 "nav_heading_sin", "nav_heading_cos"}


def _feed(spark, b):
    f = live.to_ml_feed(states(spark, b))
    return f.select(*[round6(c).alias(c) if c in _ROUNDED_FEED else F.col(c) for c in f.columns])


def _feed_sql(cols, where=""):
    return (_S + "SELECT row_id, " + ", ".join(f"{FEED_SQL[c]} AS {c}" for c in cols)
            + " FROM states" + where)


@register("ml_feed", _feed_sql(live.FEED_COLUMNS, " WHERE latitude IS NOT NULL AND longitude IS NOT NULL"))
def q_ml_feed(spark, b):
    return _feed(spark, b)


for _name, _cols in {"feed_heading": ["track_sin", "track_cos", "nav_heading_sin", "nav_heading_cos"],
                     "feed_units": ["resolved_altitude", "ground_speed", "resolved_vert_rate"],
                     "feed_category": ["category"],
                     "feed_constants": ["segment_id", "nic", "sil", "icao", "flight", "event_unix_ts"]}.items():
    register(_name, _feed_sql(_cols, " WHERE latitude IS NOT NULL AND longitude IS NOT NULL"))(
        lambda spark, b, _c=_cols: _feed(spark, b).select("row_id", *_c))


@register("feed_drop_no_position",
          _S + "SELECT row_id, latitude AS lat, longitude AS lon FROM states "
          "WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def q_feed_drop(spark, b):
    return _feed(spark, b).select("row_id", "lat", "lon")


# ---------------------------------------------------------------------------
# 2.5 bronze flatten (documents built from the flat rows, then flattened back)
_FLAT = ("SELECT " + ", ".join(
    [f"{c}" for c in O.TRACE_COLS if c not in ("registration", "aircraft_type", "description",
                                                "db_flags", "source_file", "ingestion_ts", "row_id")]
    + ["max(registration) OVER d AS registration", "max(aircraft_type) OVER d AS aircraft_type",
       "max(description) OVER d AS description", "max(db_flags) OVER d AS db_flags",
       "source_file", "max(ingestion_ts) OVER d AS ingestion_ts"])
    + " FROM traces WINDOW d AS (PARTITION BY icao, data_date)")
BRONZE_SQL = fx.oracle_ctes("traces") + _FLAT


@register("bronze_flatten", BRONZE_SQL)
def q_bronze_flatten(spark, b):
    from aerotrace.operators.bronze import flatten_traces, trace_documents
    return flatten_traces(trace_documents(fx.traces(spark, b)))


@register("flatten_trace", fx.oracle_ctes("traces")
          + "SELECT icao, data_date, count(*) AS n_points FROM traces GROUP BY icao, data_date")
def q_flatten_trace(spark, b):
    from aerotrace.operators.bronze import flatten_traces, trace_documents
    return flatten_traces(trace_documents(fx.traces(spark, b))) \
        .groupBy("icao", "data_date").agg(F.count("*").alias("n_points"))


_FL_PARTS = {
    "json_path_cast": ["registration", "aircraft_type", "description", "db_flags"],
    "array_slot_extract": ["lat", "lon", "alt_baro", "ground_speed", "track", "trace_flags", "vert_rate",
                           "position_type", "alt_geom", "geom_vert_rate", "ias", "roll"],
    "nested_object_extract": ["flight", "squawk", "emergency", "category", "nav_altitude_mcp",
                              "nav_altitude_fms", "nav_heading", "nav_qnh", "nic", "rc", "nac_p", "nac_v",
                              "sil", "sil_type", "gva", "sda", "version"],
    "event_timestamp": [],
    "lineage": ["source_file", "ingestion_ts", "data_date"],
}
_DOC_LEVEL = {"registration", "aircraft_type", "description", "db_flags", "ingestion_ts"}


def _flat(spark, b):
    from aerotrace.operators.bronze import flatten_traces, trace_documents
    return flatten_traces(trace_documents(fx.traces(spark, b)))


for _name, _cols in _FL_PARTS.items():
    register(_name, fx.oracle_ctes("traces") + "SELECT icao, event_timestamp"
             + "".join(f", max({c}) OVER d AS {c}" if c in _DOC_LEVEL else f", {c}" for c in _cols)
             + " FROM traces WINDOW d AS (PARTITION BY icao, data_date)")(
        lambda spark, b, _c=_cols: _flat(spark, b).select("icao", "event_timestamp", *_c))


@register("flag_bits", fx.oracle_ctes("traces")
          + "SELECT event_timestamp, icao, trace_flags, trace_flags & 1 > 0 AS is_stale, "
            "trace_flags & 2 > 0 AS is_new_leg, trace_flags & 4 > 0 AS is_geom_rate, "
            "trace_flags & 8 > 0 AS is_geom_alt FROM traces")
def q_flag_bits(spark, b):
    from aerotrace.operators.bronze import flatten_traces, trace_documents
    return flatten_traces(trace_documents(fx.traces(spark, b))).select(
        "event_timestamp", "icao", "trace_flags", "is_stale", "is_new_leg", "is_geom_rate", "is_geom_alt")


# ---------------------------------------------------------------------------
# 2.6 dedup
@register("dedup_icao_ts", fx.oracle_ctes("traces_dup") + O.dedup_sql("traces_dup"))
def q_dedup(spark, b):
    return dedup(fx.traces_dup(spark, b))


@register("select_exclude", fx.oracle_ctes("traces") + "SELECT * EXCLUDE (row_id) FROM traces")
def q_select_exclude(spark, b):
    return fx.traces(spark, b).drop("row_id")


# ---------------------------------------------------------------------------
# 2.7 backfill
_BF_HEAD = O.chain("dedup")


def _bf_query(cols: list[str]):
    def fn(spark, b):
        return bf.backfill(dedup(fx.traces(spark, b))).select("row_id", *cols)
    sql = (_BF_HEAD + "SELECT row_id, " + ", ".join(f"{O.backfill_expr(c)} AS {c}" for c in cols)
           + f" FROM dedup WINDOW wp AS ({O.W_PREV}), wn AS ({O.W_NEXT})")
    return fn, sql


for _name, _cols in {
    "ffill_identity": K.STABLE_IDENTITY_FIELDS,
    "ffill_callsign": ["flight"],
    "ffill_semistable": [c for c in K.SEMI_STABLE_FIELDS if c != "nav_heading"],
    "fill_neighbors": K.CONTINUOUS_FIELDS,
    "ffill_roll": ["roll"],
    "ffill_alt_baro": ["alt_baro"],
    "default_categorical": list(K.CATEGORICAL_DEFAULTS),
    "default_boolean": K.BOOLEAN_FLAGS,
    "default_flags": ["trace_flags"],
}.items():
    _fn, _sql = _bf_query(_cols)
    register(_name, _sql)(_fn)


@register("silver_backfill", _BF_HEAD.rstrip("\n") + ",\nbackfilled AS (" + O.backfill_sql("dedup")
          + ")\nSELECT * FROM backfilled")
def q_silver_backfill(spark, b):
    return bf.backfill(medallion.stage(dedup(fx.traces(spark, b)), "deduped"))


_BOUND = {"squawk": 300.0, "roll": 5.0, "nav_qnh": 300.0}


@register("ffill_bounded", fx.oracle_ctes("traces") + "SELECT row_id, " + ", ".join(
    f"coalesce({c}, CASE WHEN date_diff('microsecond', last_value(CASE WHEN {c} IS NOT NULL THEN "
    f"event_timestamp END IGNORE NULLS) OVER wp, event_timestamp) <= {int(s * 1e6)} "
    f"THEN last_value({c} IGNORE NULLS) OVER wp END) AS {c}" for c, s in _BOUND.items())
    + f" FROM traces WINDOW wp AS ({O.W_PREV})")
def q_ffill_bounded(spark, b):
    return bf.ffill_bounded(fx.traces(spark, b), _BOUND).select("row_id", *_BOUND)


_INTERP = {"lat": 86400.0, "alt_geom": 43200.0}


def _interp_sql(c, s):
    t0 = f"last_value(CASE WHEN {c} IS NOT NULL THEN event_timestamp END IGNORE NULLS) OVER wp"
    t1 = f"first_value(CASE WHEN {c} IS NOT NULL THEN event_timestamp END IGNORE NULLS) OVER wn"
    v0 = f"last_value({c} IGNORE NULLS) OVER wp"
    v1 = f"first_value({c} IGNORE NULLS) OVER wn"
    span = f"date_diff('microsecond', {t0}, {t1})"
    frac = (f"CASE WHEN {span} > 0 THEN CAST(date_diff('microsecond', {t0}, event_timestamp) AS DOUBLE) "
            f"/ {span} ELSE 0.0 END")
    return (f"round(coalesce({c}, CASE WHEN {span} <= {int(s * 1e6)} THEN {v0} + ({v1} - {v0}) * {frac} END), 6)"
            f" AS {c}")


@register("interpolate_short_gap", fx.oracle_ctes("traces") + "SELECT row_id, "
          + ", ".join(_interp_sql(c, s) for c, s in _INTERP.items())
          + f" FROM traces WINDOW wp AS ({O.W_PREV}), wn AS ({O.W_NEXT})")
def q_interpolate(spark, b):
    out = bf.interpolate_short_gap(fx.traces(spark, b), _INTERP)
    return out.select("row_id", *[round6(c).alias(c) for c in _INTERP])


_GAP = 21600  # seconds without a report that end a session


@register("ffill_in_session", fx.oracle_ctes("traces").rstrip("\n") + f""",
fl AS (SELECT *, CASE WHEN lag(event_timestamp) OVER ({O.W_ORD}) IS NULL OR date_diff('microsecond',
  lag(event_timestamp) OVER ({O.W_ORD}), event_timestamp) > {_GAP * 1000000} THEN event_timestamp END AS st FROM traces),
se AS (SELECT *, last_value(st IGNORE NULLS) OVER ({O.W_PREV}) AS session_start FROM fl)
SELECT row_id, session_start, coalesce(flight, last_value(flight IGNORE NULLS) OVER (PARTITION BY icao, session_start
  ORDER BY event_timestamp, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS flight FROM se""")
def q_ffill_in_session(spark, b):
    sessions = bf.gap_session(fx.traces(spark, b), _GAP)
    return bf.ffill_in_session(sessions, ["flight"], "session_start").select("row_id", "session_start", "flight")


# ---------------------------------------------------------------------------
# 2.8 cleaning (each rule on the raw flat rows) and the composed step
_T = fx.oracle_ctes("traces")
column_queries("clean", traces, _T, "traces", {
    "normalize_identity": (lambda: {k: v for k, v in cl.normalize_identity().items()},
                           {k: O.CLEAN_EXPR[k] for k in ("icao", "registration", "aircraft_type", "description",
                                                             "category")}),
    "null_if_blank": (lambda: {"description": null_if_blank("description")},
                      {"description": "nullif(trim(description), '')"}),
    "valid_callsign": (lambda: {"flight": cl.valid_callsign()}, {"flight": O.CLEAN_EXPR["flight"]}),
    "valid_squawk": (lambda: {"squawk": cl.valid_squawk()}, {"squawk": O.CLEAN_EXPR["squawk"]}),
    "emergency_enum": (lambda: {"emergency": cl.emergency_enum()}, {"emergency": O.CLEAN_EXPR["emergency"]}),
    "on_ground_flag": (lambda: {"is_on_ground": cl.on_ground_flag()}, {"is_on_ground": O.CLEAN_ADDED["is_on_ground"]}),
    "alt_baro_ft": (lambda: {"alt_baro_ft": cl.alt_baro_ft()}, {"alt_baro_ft": O.CLEAN_ADDED["alt_baro_ft"]}),
    "resolved_altitude": (lambda: {"resolved_altitude": cl.resolved("is_geom_alt", F.col("alt_geom"), cl.alt_baro_ft())},
                          {"resolved_altitude": O.CLEAN_ADDED["resolved_altitude"]}),
    "resolved_vert_rate": (lambda: {"resolved_vert_rate": cl.resolved("is_geom_rate", F.col("geom_vert_rate"),
                                                              F.col("vert_rate"))},
                           {"resolved_vert_rate": O.CLEAN_ADDED["resolved_vert_rate"]}),
    "valid_range": (lambda: {c: cl.valid_range(c, lo, hi) for c, (lo, hi) in K.MOTION_RANGES.items()},
                    {c: O.CLEAN_EXPR[c] for c in K.MOTION_RANGES}),
    "integrity_ranges": (lambda: {c: cl.valid_range(c, lo, hi) for c, (lo, hi) in K.INTEGRITY_RANGES.items()},
                         {c: O.CLEAN_EXPR[c] for c in K.INTEGRITY_RANGES}),
    "position_type_enum": (lambda: {"position_type": cl.position_type_enum()},
                           {"position_type": O.CLEAN_EXPR["position_type"]}),
    "daily_session_id": (lambda: {"aircraft_session_id": cl.daily_session_id()},
                         {"aircraft_session_id": O.sk("upper(trim(icao))", "CAST(event_timestamp AS DATE)")}),
})
# daily_session_id is defined on the normalised ICAO
QUERIES["daily_session_id"] = lambda spark, b: traces(spark, b).withColumn(
    "icao", F.upper(F.trim("icao"))).select("row_id", cl.daily_session_id().alias("aircraft_session_id"))


@register("drop_unidentified", _T + f"SELECT row_id FROM traces WHERE {O.IDENTIFIED}")
def q_drop_unidentified(spark, b):
    return traces(spark, b).filter(cl.identified(cl.normalize_identity())).select("row_id")


@register("drop_stale", _T + "SELECT row_id FROM traces WHERE NOT coalesce(is_stale, false)")
def q_drop_stale(spark, b):
    return traces(spark, b).filter(~F.coalesce(F.col("is_stale"), F.lit(False))).select("row_id")


@register("silver_clean", O.chain("silver") + "SELECT * FROM silver")
def q_silver_clean(spark, b):
    # the full dedup -> backfill -> clean plan (not the materialised table)
    return medallion.silver(fx.traces(spark, b), rescan=True)


# The whole seam from documents on, with re-delivered reports: no row_id, so
# rows that tie in the dedup are told apart by their own values only.
@register("documents_to_silver", O.chain("silver", "traces_dup", _FLAT.replace(
    "source_file", "source_file, 0 AS row_id", 1).replace("FROM traces", "FROM traces_dup"))
    + "SELECT * EXCLUDE (row_id) FROM silver")
def q_documents_to_silver(spark, b):
    from aerotrace.operators.bronze import flatten_traces, trace_documents
    return medallion.silver(flatten_traces(trace_documents(fx.traces_dup(spark, b))))


@register("drop_redundant", O.chain("silver") + "SELECT * EXCLUDE (aircraft_session_id) FROM silver")
def q_drop_redundant(spark, b):
    return silver(spark, b).drop("aircraft_session_id")


# ---------------------------------------------------------------------------
# 2.9 enrichment (on silver)
_SIL = O.chain("silver")
_EN_ITEMS = {
    "category_label": ["category_label"],
    "callsign_class": ["callsign_class"],
    "squawk_category": ["squawk_category"],
    "has_emergency": ["has_emergency"],
    "date_parts": ["event_date", "event_hour", "event_minute", "event_dow", "event_month", "event_year"],
    "ingestion_lag": ["ingestion_lag_seconds"],
    "climb_state": ["climb_state"],
    "signal_integrity": ["signal_integrity_class"],
}
for _name, _cols in _EN_ITEMS.items():
    register(_name, _SIL + "SELECT row_id, " + ", ".join(f"{O.GOLD_EXPR[c]} AS {c}" for c in _cols)
             + " FROM silver")(lambda spark, b, _c=_cols: gold(spark, b).select("row_id", *_c))


@register("gold_enrich", O.chain("gold") + "SELECT * FROM gold")
def q_gold_enrich(spark, b):
    return gold(spark, b)


# ---------------------------------------------------------------------------
# 2.10 keys and star schema
_G = O.chain("gold")


@register("surrogate_key", _G + f"SELECT row_id, {O.ik('icao', 'event_timestamp')} AS trace_key, "
          f"{O.sk('icao', 'registration', 'aircraft_type')} AS aircraft_key FROM gold")
def q_surrogate_key(spark, b):
    return gold(spark, b).select("row_id", identity_key("icao", "event_timestamp").alias("trace_key"),
                                 surrogate_key("icao", "registration", "aircraft_type").alias("aircraft_key"))


for _dim, (_key, _attrs) in star.DIMENSIONS.items():
    register(_dim, _G + f"SELECT DISTINCT {O.sk(*star.KEYS[_key])} AS {_key}, {', '.join(_attrs)} FROM gold")(
        lambda spark, b, _d=_dim: star.dimension(gold(spark, b), _d))


@register("fact_flight_trace", _G + "SELECT " + ", ".join(
    [f"{O.ik('icao', 'event_timestamp')} AS trace_key"]
    + [f"{O.sk(*cols)} AS {k}" for k, cols in star.KEYS.items()] + star.MEASURES) + " FROM gold")
def q_fact(spark, b):
    return star.fact(gold(spark, b))


def _star_join_sql():
    dims = []
    for name, (key, attrs) in star.DIMENSIONS.items():
        keep = [a for a in attrs if a not in star.MEASURES]
        dims.append(
            f"u_{name} AS (SELECT {key}, {', '.join(keep)} FROM (SELECT {O.sk(*star.KEYS[key])} AS {key}, "
            f"{', '.join(attrs)}, row_number() OVER (PARTITION BY {O.sk(*star.KEYS[key])} "
            f"ORDER BY event_timestamp DESC, row_id DESC) AS rn FROM gold) WHERE rn = 1)")
    fact = ("f AS (SELECT " + ", ".join(
        [f"{O.ik('icao', 'event_timestamp')} AS trace_key"]
        + [f"{O.sk(*cols)} AS {k}" for k, cols in star.KEYS.items()] + star.MEASURES) + " FROM gold)")
    joins_ = " ".join(f"LEFT JOIN u_{n} USING ({k})" for n, (k, _) in star.DIMENSIONS.items())
    return _G.rstrip("\n") + ",\n" + ",\n".join(dims + [fact]) + f"\nSELECT * FROM f {joins_}"


@register("star_join", _star_join_sql())
def q_star_join(spark, b):
    return star.star_join(gold(spark, b))


# ---------------------------------------------------------------------------
# 2.11 joins
_RANGE_SQL = (fx.oracle_ctes("states", "ranges") + "SELECT s.row_id, s.icao24, s.icao_int, r.range_start, "
              "r.range_end, r.country FROM (SELECT row_id, icao24, CASE WHEN regexp_matches(icao24, "
              "'^[0-9A-Fa-f]{6}$') THEN CAST(('0x' || icao24) AS BIGINT) END AS icao_int FROM states) s "
              "LEFT JOIN ranges r ON s.icao_int BETWEEN r.range_start AND r.range_end")


@register("icao_range_join", _RANGE_SQL)
def q_icao_range_join(spark, b):
    st = fx.states(spark, b).select("row_id", "icao24")
    return joins.icao_country(st, fx.ranges(spark, b))


def _hybrid_sql(select: str) -> str:
    return (O.ml_chain().rstrip("\n") + ",\nchronos AS (" + fx.CHRONOS_SQL.format(traces="traces") + "),\n"
            "hyb AS (SELECT s.*, c.chronos_score, c.chronos_confirmed FROM scored s LEFT JOIN chronos c "
            "USING (icao, event_timestamp))\n" + select)


_REASON = ("CASE WHEN {p} = g THEN 'POSITION' WHEN {a} = g THEN 'ALTITUDE' WHEN {s} = g THEN 'SPEED' "
           "WHEN {v} = g THEN 'VERTICAL_RATE' WHEN {t} = g THEN 'TRACK' END")
_SCALED = {"p": "coalesce(position_error_km, 0.0)", "a": "coalesce(altitude_error_ft / 1000, 0.0)",
           "s": "coalesce(ground_speed_error / 100, 0.0)", "v": "coalesce(vert_rate_error / 1000, 0.0)",
           "t": "coalesce(track_error, 0.0)"}
_ANOM = "coalesce(xgb_anomaly_score >= 5.0, false)"


def _hybrid(spark, b):
    return ml.hybrid(scored(spark, b), fx.chronos_standin(spark, b))


@register("hybrid_left_join", _hybrid_sql("SELECT row_id, chronos_score, chronos_confirmed FROM hyb"))
def q_hybrid_join(spark, b):
    return _hybrid(spark, b).select("row_id", "chronos_score", "chronos_confirmed")


@register("is_anomaly", _hybrid_sql(f"SELECT row_id, {_ANOM} AS xgb_is_anomaly FROM hyb"))
def q_is_anomaly(spark, b):
    return _hybrid(spark, b).select("row_id", "xgb_is_anomaly")


@register("primary_reason", _hybrid_sql(
    "SELECT row_id, " + _REASON.format(**_SCALED) + " AS primary_anomaly_reason FROM (SELECT *, greatest("
    + ", ".join(_SCALED.values()) + ") AS g FROM hyb)"))
def q_primary_reason(spark, b):
    return _hybrid(spark, b).select("row_id", "primary_anomaly_reason")


@register("hybrid_label", _hybrid_sql(
    f"SELECT row_id, {_ANOM} AS xgb_is_anomaly, {_ANOM} AND coalesce(chronos_confirmed, true) "
    "AS hybrid_anomaly_label FROM hyb"))
def q_hybrid_label(spark, b):
    return _hybrid(spark, b).select("row_id", "xgb_is_anomaly", "hybrid_anomaly_label")


# ---------------------------------------------------------------------------
# 2.12 aggregations
_BRONZE = fx.oracle_ctes("traces")


@register("val_daily_coverage", _BRONZE + "SELECT data_date, count(*) AS total_rows, count(DISTINCT icao) "
          "AS unique_aircraft, count(DISTINCT flight) AS unique_flights, min(event_timestamp) AS first_event, "
          "max(event_timestamp) AS last_event FROM traces GROUP BY data_date ORDER BY data_date")
def q_val_daily(spark, b):
    return panels.val_daily_coverage(traces(spark, b))


@register("val_missing_counts", _BRONZE + "SELECT count(*) AS total_rows, CAST(count_if(icao IS NULL) AS BIGINT) AS "
          "missing_icao, CAST(count_if(lat IS NULL OR lon IS NULL) AS BIGINT) AS missing_position, "
          "CAST(count_if(event_timestamp IS NULL) AS BIGINT) AS missing_event_timestamp FROM traces")
def q_val_missing(spark, b):
    return panels.val_missing_counts(traces(spark, b))


@register("val_position_types", _BRONZE + "SELECT position_type, count(*) AS records FROM traces "
          "GROUP BY position_type ORDER BY records DESC")
def q_val_position_types(spark, b):
    return panels.val_position_types(traces(spark, b))


_MAE_PAIRS = {n: f"pred_{n}" for _, n in O.SHIFT_SRC.values()}


@register("target_mae", O.ml_chain() + " UNION ALL ".join(
    f"SELECT '{t}' AS target, round(avg(abs({t} - {p})), 6) AS mae FROM resid" for t, p in _MAE_PAIRS.items()))
def q_target_mae(spark, b):
    r = panels.target_mae(ml.persistence_predictions(ml.flight_features(silver(spark, b))), _MAE_PAIRS)
    return r.select("target", round6("mae").alias("mae"))


_L = _S.rstrip("\n") + ",\nlive AS (" + LIVE_TABLE_SQL + ")\n"


def _live_q(name, sql, fn):
    register(name, _L + sql)(lambda spark, b: fn(live_table(spark, b)))


_live_q("active_aircraft_trend", "SELECT date_trunc('minute', event_time) AS window_start, "
        "count(DISTINCT icao24) AS active_aircraft FROM live GROUP BY 1", panels.active_aircraft_trend)
_live_q("geo_grid_density", "SELECT CAST(floor(latitude / 1.0) * 1.0 AS DOUBLE) AS lat_cell, "
        "CAST(floor(longitude / 1.0) * 1.0 AS DOUBLE) AS lon_cell, count(*) AS n_rows, count(DISTINCT icao24) "
        "AS n_aircraft FROM live WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2",
        panels.geo_grid_density)
_live_q("missing_geo_pct", "SELECT round(100.0 * count_if(latitude IS NULL OR longitude IS NULL) / count(*), 6) "
        "AS missing_geo_pct FROM live", panels.missing_geo_pct)
_live_q("missing_key_fields", "SELECT count(*) AS total_rows, CAST(count_if(icao24 IS NULL OR trim(icao24) = '' OR "
        "icao24 = 'UNKNOWN') AS BIGINT) AS missing_icao24, CAST(count_if(callsign IS NULL OR trim(callsign) = '') AS BIGINT) AS "
        "missing_callsign, CAST(count_if(squawk IS NULL OR trim(squawk) = '') AS BIGINT) AS missing_squawk, "
        "CAST(count_if(latitude IS NULL OR longitude IS NULL) AS BIGINT) AS missing_position, CAST(count_if(altitude_ft IS NULL) AS BIGINT) "
        "AS missing_altitude, CAST(count_if(velocity_knots IS NULL) AS BIGINT) AS missing_velocity FROM live",
        panels.missing_key_fields)
_live_q("phase_distribution", "SELECT flight_phase, n_rows, round(100.0 * n_rows / sum(n_rows) OVER (), 6) "
        "AS share_pct FROM (SELECT flight_phase, count(*) AS n_rows FROM live GROUP BY 1)",
        panels.phase_distribution)
_live_q("fastest_aircraft", "SELECT icao24, max(velocity_knots) AS max_velocity_knots FROM live GROUP BY 1 "
        "HAVING max(velocity_knots) IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 10", panels.fastest_aircraft)
_live_q("high_speed_outliers", "SELECT * FROM live WHERE velocity_knots > 600.0", panels.high_speed_outliers)
_live_q("extreme_vertical_rate", "SELECT * FROM live WHERE abs(vertical_rate) > 25.0",
        panels.extreme_vertical_rate)
_live_q("top_steep_descents", "SELECT * FROM live WHERE flight_phase = 'DESCENT' AND vertical_rate IS NOT NULL "
        "ORDER BY vertical_rate, row_id LIMIT 10", panels.top_steep_descents)
_live_q("source_quality", "SELECT position_source, n_rows, round(100.0 * n_rows / sum(n_rows) OVER (), 6) AS "
        "share_pct, missing_geo_pct FROM (SELECT position_source, count(*) AS n_rows, round(100.0 * "
        "count_if(latitude IS NULL OR longitude IS NULL) / count(*), 6) AS missing_geo_pct FROM live GROUP BY 1)",
        panels.source_quality)
_live_q("top_countries", "SELECT origin_country, count(*) AS n_rows, count(DISTINCT icao24) AS n_aircraft "
        "FROM live GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", panels.top_countries)
_LAGGED = ("SELECT *, event_time + to_seconds(90 + row_id % 7) AS ingested_at FROM live")
register("stream_lag", _L + "SELECT date_trunc('minute', event_time) AS minute, round(avg(CAST(date_diff("
         "'second', event_time, ingested_at) AS DOUBLE)), 6) AS avg_lag_s, max(CAST(date_diff('second', "
         "event_time, ingested_at) AS DOUBLE)) AS max_lag_s FROM (" + _LAGGED + ") GROUP BY 1")(
    lambda spark, b: panels.stream_lag(live_table(spark, b).withColumn(
        "ingested_at", F.timestamp_add("SECOND", F.lit(90) + F.col("row_id") % 7, F.col("event_time")))))


def _gold_q(name, sql, fn):
    register(name, _G + sql)(lambda spark, b: fn(gold(spark, b)))


_gold_q("aircraft_count_over_time", "SELECT event_date, count(DISTINCT icao) AS n_aircraft FROM gold GROUP BY 1",
        panels.aircraft_count_over_time)
_gold_q("avg_velocity_over_time", "SELECT event_date, round(avg(ground_speed), 6) AS avg_ground_speed FROM gold "
        "GROUP BY 1", panels.avg_velocity_over_time)
_gold_q("avg_altitude_over_time", "SELECT event_date, round(avg(resolved_altitude), 6) AS avg_altitude FROM gold "
        "GROUP BY 1", panels.avg_altitude_over_time)
_gold_q("phase_distribution_hist", "SELECT climb_state, count(*) AS n_rows FROM gold GROUP BY 1",
        panels.phase_distribution_hist)
_gold_q("vert_rate_histogram", "SELECT CAST(floor(resolved_vert_rate / 500) * 500 AS BIGINT) AS "
        "vert_rate_bucket, count(*) AS n_rows FROM gold GROUP BY 1", panels.vert_rate_histogram)
_gold_q("active_aircraft_kpi", "SELECT count(DISTINCT icao) AS active_aircraft FROM gold",
        panels.active_aircraft_kpi)
_gold_q("airborne_ground_split", "SELECT is_on_ground, count(*) AS n_rows FROM gold GROUP BY 1",
        panels.airborne_ground_split)
_gold_q("altitude_band_hist", "SELECT CASE WHEN is_on_ground = true THEN 'GROUND' WHEN resolved_altitude IS NULL "
        "THEN 'UNKNOWN' WHEN resolved_altitude < 10000 THEN 'LOW' WHEN resolved_altitude < 25000 THEN 'MEDIUM' "
        "WHEN resolved_altitude < 40000 THEN 'HIGH' ELSE 'VERY_HIGH' END AS altitude_band, count(*) AS n_rows "
        "FROM gold GROUP BY 1", panels.altitude_band_hist)


# ---------------------------------------------------------------------------
# 2.13 windows and 2.16 ML data operators
_ML = O.ml_chain()
_LAGS = [p for p, _ in O.SHIFT_SRC.values()]
_LEADS = [n for _, n in O.SHIFT_SRC.values()]


def _feat(spark, b):
    return ml.flight_features(silver(spark, b))


def _r6(cols):
    return [round6(c).alias(c) for c in cols]


register("lag_features", _ML + "SELECT row_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in _LAGS)
         + " FROM features")(lambda spark, b: _feat(spark, b).select("row_id", *_r6(_LAGS)))
register("lead_targets", _ML + "SELECT row_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in _LEADS)
         + " FROM features")(lambda spark, b: _feat(spark, b).select("row_id", *_r6(_LEADS)))
register("usable_rows", _ML + "SELECT row_id FROM usable")(
    lambda spark, b: ml.usable_rows(silver(spark, b)).select("row_id"))
register("track_sincos", _ML + "SELECT row_id, round(track_sin, 6) AS track_sin, round(track_cos, 6) AS "
         "track_cos, event_unix_ts FROM usable")(
    lambda spark, b: ml.angle_features(ml.usable_rows(silver(spark, b))).select(
        "row_id", *_r6(["track_sin", "track_cos"]), "event_unix_ts"))
register("target_filter", _ML + "SELECT row_id FROM features")(
    lambda spark, b: _feat(spark, b).select("row_id"))
_FEAT_OUT = ["icao", "event_timestamp", "row_id", "lat", "lon", "resolved_altitude", "ground_speed",
             "resolved_vert_rate", "track_sin", "track_cos", "event_unix_ts", *_LAGS, *_LEADS]
register("flight_features", _ML + "SELECT " + ", ".join(
    c if c in ("icao", "event_timestamp", "row_id", "event_unix_ts") else f"round({c}, 6) AS {c}"
    for c in _FEAT_OUT) + " FROM features")(
    lambda spark, b: _feat(spark, b).select(*[F.col(c) if c in ("icao", "event_timestamp", "row_id",
                                                                   "event_unix_ts") else round6(c).alias(c)
                                              for c in _FEAT_OUT]))
_ERRS = ["position_error_km", "altitude_error_ft", "ground_speed_error", "vert_rate_error", "track_error"]
register("position_error_km", _ML + "SELECT row_id, round(position_error_km, 6) AS position_error_km FROM resid")(
    lambda spark, b: scored(spark, b).select("row_id", round6("position_error_km").alias("position_error_km")))
register("residual_errors", _ML + "SELECT row_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in _ERRS[1:])
         + " FROM resid")(lambda spark, b: scored(spark, b).select("row_id", *_r6(_ERRS[1:])))
register("anomaly_score", _ML + "SELECT row_id, round(xgb_anomaly_score, 6) AS xgb_anomaly_score FROM scored")(
    lambda spark, b: scored(spark, b).select("row_id", round6("xgb_anomaly_score").alias("xgb_anomaly_score")))

_SEQ_N = K.SEQUENCE_LENGTH


_SEQ_F = list(K.SEQUENCE_FIELDS)


def _seq_sql(select):
    cols = ", ".join(f"first_value({c}) OVER h AS first_{c}, last_value({c}) OVER h AS last_{c}, "
                     f"sum(coalesce({c}, 0)) OVER h AS sum_{c}" for c in _SEQ_F)
    hist = (f"SELECT icao, event_timestamp, row_id, {', '.join(f'{c} AS actual_{c}' for c in _SEQ_F)}, "
            f"count(*) OVER h AS n, {cols} FROM usable "
            f"WINDOW h AS ({O.W_ORD} ROWS BETWEEN {_SEQ_N} PRECEDING AND 1 PRECEDING)")
    return _ML.rstrip("\n") + f",\nseq AS (SELECT * FROM ({hist}) WHERE n = {_SEQ_N})\n" + select


def _windows(spark, b, size=_SEQ_N):
    feats = ml.angle_features(ml.usable_rows(silver(spark, b)))
    return ml.sequence_windows(feats, size)


@register("sequence_windows", _seq_sql("SELECT icao, event_timestamp, row_id, n AS history_len, " + ", ".join(
    f"round({p}_{c}, 5) AS {p}_{c}" for c in _SEQ_F for p in ("first", "last", "sum", "actual")) + " FROM seq"))
def q_sequence_windows(spark, b):
    def total(c):
        return F.aggregate(F.col(f"history.{c}"), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0)).cast("double"))
    cols = []
    for c in _SEQ_F:
        cols += [F.round(F.col("history")[0][c], 5).alias(f"first_{c}"),
                 F.round(F.element_at("history", -1)[c], 5).alias(f"last_{c}"),
                 F.round(total(c), 5).alias(f"sum_{c}"), F.round(F.col(f"actual.{c}"), 5).alias(f"actual_{c}")]
    return _windows(spark, b).select("icao", "event_timestamp", "row_id",
                                     F.size("history").cast("bigint").alias("history_len"), *cols)


@register("sequence_confirmation", _seq_sql("SELECT icao, event_timestamp, CAST(NULL AS DOUBLE) AS "
                                            "chronos_score, CAST(NULL AS BOOLEAN) AS chronos_confirmed FROM seq"))
def q_sequence_confirmation(spark, b):
    return ml.confirm(_windows(spark, b))


_EP_GAP = 86400  # seconds; anomalies of one aircraft closer than this form one episode
_EP_T = K.ANOMALY_THRESHOLD


@register("episode_grouping", _ML + f"""
, an AS (SELECT icao, event_timestamp, xgb_anomaly_score, row_id FROM scored WHERE xgb_anomaly_score >= {_EP_T}),
fl AS (SELECT *, CASE WHEN lag(event_timestamp) OVER ({O.W_ORD}) IS NULL OR date_diff('microsecond',
  lag(event_timestamp) OVER ({O.W_ORD}), event_timestamp) > {_EP_GAP * 1000000} THEN event_timestamp END AS st FROM an),
ep AS (SELECT *, last_value(st IGNORE NULLS) OVER ({O.W_PREV}) AS episode_start FROM fl)
SELECT {O.sk('icao', 'episode_start')} AS episode_id, icao, episode_start, max(event_timestamp) AS episode_end,
  count(*) AS n_points, round(max(xgb_anomaly_score), 6) AS peak_score FROM ep GROUP BY icao, episode_start""")
def q_episode_grouping(spark, b):
    e = ml.anomaly_episodes(scored(spark, b), gap_seconds=_EP_GAP, threshold=_EP_T)
    return e.withColumn("peak_score", round6("peak_score"))


@register("category_threshold", _ML + """
, q AS (SELECT category, quantile_disc(xgb_anomaly_score, 0.99) AS t FROM scored GROUP BY category),
g AS (SELECT quantile_disc(xgb_anomaly_score, 0.99) AS gt FROM scored)
SELECT category, round(coalesce(t, gt), 6) AS threshold FROM q, g""")
def q_category_threshold(spark, b):
    t = ml.category_thresholds(scored(spark, b))
    return t.select("category", round6("threshold").alias("threshold"))


# ---------------------------------------------------------------------------
# sinks expressed as queries
_AS_OF = "2024-02-03 00:00:00"


@register("retention_30d", _L + f"SELECT * FROM live WHERE event_time > TIMESTAMP '{_AS_OF}' - INTERVAL 30 DAY")
def q_retention(spark, b):
    from aerotrace.streaming.sinks import expire
    return expire(live_table(spark, b), _AS_OF, days=K.RETENTION_DAYS)


# ---------------------------------------------------------------------------
# joins over time, ranks, set operations, grouping sets, sketches
from aerotrace.plans import catalog_tables  # noqa: E402, F401  (registers its queries here)
