"""Independent SQL (DuckDB dialect) for the correctness oracle.

These texts re-state each operator in plain SQL over the same fixture
views, so the driver can compare Spark results against a second engine.
They are test oracles, not an execution path of the library.
"""

from __future__ import annotations

from aerotrace.functions import constants as K
from aerotrace.sources.fixtures import oracle_ctes

TRACE_COLS = ["icao", "registration", "aircraft_type", "description", "db_flags", "data_date",
              "event_timestamp", "lat", "lon", "alt_baro", "alt_geom", "ground_speed", "track",
              "vert_rate", "geom_vert_rate", "ias", "roll", "trace_flags", "is_stale", "is_new_leg",
              "is_geom_rate", "is_geom_alt", "position_type", "flight", "squawk", "emergency",
              "category", "nav_altitude_mcp", "nav_altitude_fms", "nav_heading", "nav_qnh", "nic",
              "rc", "nac_p", "nac_v", "sil", "sil_type", "gva", "sda", "version", "source_file",
              "ingestion_ts", "row_id"]

STATE_COLS = ["icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
              "latitude", "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate",
              "geo_altitude", "squawk", "spi", "position_source", "category"]

W_PREV = ("PARTITION BY icao ORDER BY event_timestamp, row_id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
W_NEXT = ("PARTITION BY icao ORDER BY event_timestamp, row_id "
          "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")
W_ORD = "PARTITION BY icao ORDER BY event_timestamp, row_id"


def ik(*cols: str) -> str:
    parts = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in cols)
    return f"md5({parts})"


def sk(*cols: str) -> str:
    return f"CAST(('0x' || substr({ik(*cols)}, 1, 15)) AS BIGINT)"


def case_map(col: str, mapping: dict, default: str, quote_keys: bool) -> str:
    whens = " ".join(
        f"WHEN {col} = {repr(k) if quote_keys else k} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE '{default}' END"


def dedup_sql(src: str) -> str:
    return (f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY icao, event_timestamp "
            f"ORDER BY ingestion_ts DESC NULLS LAST, source_file NULLS LAST, row_id DESC) = 1")


FORWARD_ONLY = (K.STABLE_IDENTITY_FIELDS + ["flight"] + K.SEMI_STABLE_FIELDS + ["roll", "alt_baro"])


def backfill_expr(c: str) -> str:
    if c in K.CONTINUOUS_FIELDS:
        e = (f"coalesce({c}, last_value({c} IGNORE NULLS) OVER wp, "
             f"first_value({c} IGNORE NULLS) OVER wn)")
    elif c in FORWARD_ONLY:
        e = f"coalesce({c}, last_value({c} IGNORE NULLS) OVER wp)"
    else:
        e = c
    if c in K.CATEGORICAL_DEFAULTS:
        e = f"coalesce({e}, '{K.CATEGORICAL_DEFAULTS[c]}')"
    elif c in K.BOOLEAN_FLAGS:
        e = f"coalesce({e}, false)"
    elif c == "trace_flags":
        e = f"coalesce({e}, 0)"
    return e


def backfill_sql(src: str) -> str:
    cols = ",\n  ".join(f"{backfill_expr(c)} AS {c}" for c in TRACE_COLS)
    return f"SELECT\n  {cols}\nFROM {src}\nWINDOW wp AS ({W_PREV}), wn AS ({W_NEXT})"


def in_list(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def rng(c: str, lo, hi) -> str:
    return f"CASE WHEN {c} >= {lo} AND {c} <= {hi} THEN {c} END"


# expressions of the cleaning step, each over raw column names
CLEAN_EXPR = {
    "icao": "upper(trim(icao))",
    "registration": "upper(trim(registration))",
    "aircraft_type": "upper(trim(aircraft_type))",
    "description": "trim(description)",
    "category": "upper(trim(category))",
    "flight": ("CASE WHEN regexp_matches(upper(nullif(trim(flight), '')), '^[A-Z0-9 ]{2,12}$') "
               "THEN upper(nullif(trim(flight), '')) END"),
    "squawk": "CASE WHEN regexp_matches(nullif(trim(squawk), ''), '^[0-7]{4}$') THEN nullif(trim(squawk), '') END",
    "emergency": (f"CASE WHEN upper(coalesce(nullif(trim(emergency), ''), 'NONE')) IN "
                  f"({in_list(K.EMERGENCY_VALUES)}) THEN upper(coalesce(nullif(trim(emergency), ''), 'NONE')) "
                  f"ELSE 'OTHER' END"),
    "position_type": (f"CASE WHEN upper(replace(coalesce(nullif(trim(position_type), ''), 'other'), '-', '_')) "
                      f"IN ({in_list(K.POSITION_TYPES)}) THEN "
                      f"upper(replace(coalesce(nullif(trim(position_type), ''), 'other'), '-', '_')) "
                      f"ELSE 'OTHER' END"),
    "is_stale": "coalesce(is_stale, false)",
    **{c: rng(c, lo, hi) for c, (lo, hi) in {**K.MOTION_RANGES, **K.INTEGRITY_RANGES}.items()},
}
GROUND = "lower(CAST(alt_baro AS VARCHAR)) = 'ground'"
ALT_BARO_FT = f"CASE WHEN {GROUND} THEN 0.0 ELSE TRY_CAST(alt_baro AS DOUBLE) END"
CLEAN_ADDED = {
    "is_on_ground": f"CASE WHEN {GROUND} THEN true ELSE false END",
    "alt_baro_ft": ALT_BARO_FT,
    "resolved_altitude": f"coalesce(CASE WHEN is_geom_alt = true THEN alt_geom END, {ALT_BARO_FT}, alt_geom)",
    "resolved_vert_rate": ("coalesce(CASE WHEN is_geom_rate = true THEN geom_vert_rate END, "
                           "vert_rate, geom_vert_rate)"),
}
IDENTIFIED = ("NOT (upper(trim(registration)) IS NULL AND upper(trim(aircraft_type)) IS NULL "
              "AND trim(description) IS NULL)")


def clean_sql(src: str) -> str:
    cols = [f"{CLEAN_EXPR.get(c, c)} AS {c}" for c in TRACE_COLS]
    cols += [f"{v} AS {k}" for k, v in CLEAN_ADDED.items()]
    inner = f"SELECT {', '.join(cols)} FROM {src} WHERE {IDENTIFIED}"
    return (f"SELECT * EXCLUDE (alt_baro, alt_geom, vert_rate, geom_vert_rate, ias, roll), "
            f"{sk('icao', 'CAST(event_timestamp AS DATE)')} AS aircraft_session_id "
            f"FROM ({inner}) WHERE NOT is_stale")


GOLD_EXPR = {
    "category_label": case_map("category", K.GOLD_CATEGORY, K.GOLD_CATEGORY_DEFAULT, True),
    "callsign_class": ("CASE WHEN flight IS NULL THEN 'UNKNOWN' "
                       "WHEN regexp_matches(flight, '^[A-Z]{2,3}[0-9].*') THEN 'AIRLINE' "
                       "WHEN regexp_matches(flight, '^[A-Z0-9]{2,7}$') THEN 'GENERAL_AVIATION' "
                       "ELSE 'OTHER' END"),
    "squawk_category": ("CASE WHEN squawk = '7700' THEN 'GENERAL_EMERGENCY' "
                        "WHEN squawk = '7600' THEN 'RADIO_FAILURE' WHEN squawk = '7500' THEN 'HIJACK' "
                        "WHEN squawk IS NULL THEN 'UNKNOWN' ELSE 'NORMAL' END"),
    "has_emergency": ("CASE WHEN squawk IN ('7700', '7600', '7500') OR emergency NOT IN ('NONE', 'NO', 'OTHER') "
                      "THEN true ELSE false END"),
    "event_date": "CAST(event_timestamp AS DATE)",
    "event_hour": "CAST(hour(event_timestamp) AS INTEGER)",
    "event_minute": "CAST(minute(event_timestamp) AS INTEGER)",
    "event_dow": "CAST(dayofweek(event_timestamp) AS INTEGER)",
    "event_month": "CAST(month(event_timestamp) AS INTEGER)",
    "event_year": "CAST(year(event_timestamp) AS INTEGER)",
    "ingestion_lag_seconds": ("CASE WHEN ingestion_ts IS NOT NULL THEN "
                              "date_diff('second', event_timestamp, ingestion_ts) END"),
    "climb_state": ("CASE WHEN is_on_ground = true THEN 'ON_GROUND' WHEN resolved_vert_rate > 300 THEN 'CLIMB' "
                    "WHEN resolved_vert_rate < -300 THEN 'DESCENT' ELSE 'LEVEL' END"),
    "signal_integrity_class": ("CASE WHEN nic >= 8 AND nac_p >= 8 AND sil >= 2 THEN 'HIGH' "
                               "WHEN nic >= 5 AND nac_p >= 5 THEN 'MEDIUM' ELSE 'LOW' END"),
}


def gold_sql(src: str) -> str:
    return f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in GOLD_EXPR.items())} FROM {src}"


def chain(upto: str, source: str = "traces", flat: str | None = None) -> str:
    """WITH clause through the named stage: dedup, backfilled, silver, gold.
    ``flat`` is SQL over ``source`` that makes the rows to start from."""
    stages = [("flat", flat)] if flat else []
    stages += [("dedup", dedup_sql("flat" if flat else source)), ("backfilled", backfill_sql("dedup")),
              ("silver", clean_sql("backfilled")), ("gold", gold_sql("silver"))]
    head = oracle_ctes(source).rstrip("\n")
    parts = []
    for name, text in stages:
        parts.append(f"{name} AS ({text})")
        if name == upto:
            break
    return head + ",\n" + ",\n".join(parts) + "\n"


# --- ML features -----------------------------------------------------------
SHIFT_SRC = {"lat": ("prev_lat", "next_lat"), "lon": ("prev_lon", "next_lon"),
             "resolved_altitude": ("prev_altitude", "next_altitude"),
             "ground_speed": ("prev_ground_speed", "next_ground_speed"),
             "resolved_vert_rate": ("prev_vert_rate", "next_vert_rate"),
             "track_sin": ("prev_track_sin", "next_track_sin"),
             "track_cos": ("prev_track_cos", "next_track_cos")}


def features_sql() -> str:
    """CTEs ``usable`` and ``features`` on top of ``silver``."""
    usable = ("SELECT *, sin(radians(track)) AS track_sin, cos(radians(track)) AS track_cos, "
              "CAST(floor(epoch(event_timestamp)) AS BIGINT) AS event_unix_ts FROM silver "
              "WHERE icao IS NOT NULL AND event_timestamp IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    shifts = ", ".join([f"lag({c}) OVER w AS {p}" for c, (p, _) in SHIFT_SRC.items()]
                       + [f"lead({c}) OVER w AS {n}" for c, (_, n) in SHIFT_SRC.items()])
    feats = (f"SELECT * FROM (SELECT *, {shifts} FROM usable WINDOW w AS ({W_ORD})) "
             f"WHERE next_lat IS NOT NULL AND next_lon IS NOT NULL AND next_altitude IS NOT NULL")
    preds = ", ".join(f"{c} AS pred_{n}" for c, (_, n) in SHIFT_SRC.items())
    hav = ("2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(pred_next_lat - next_lat) / 2), 2) + "
           "cos(radians(next_lat)) * cos(radians(pred_next_lat)) * "
           "pow(sin(radians(pred_next_lon - next_lon) / 2), 2))))")
    resid = (f"SELECT *, {hav} AS position_error_km, "
             "abs(next_altitude - pred_next_altitude) AS altitude_error_ft, "
             "abs(next_ground_speed - pred_next_ground_speed) AS ground_speed_error, "
             "abs(next_vert_rate - pred_next_vert_rate) AS vert_rate_error, "
             "abs(next_track_sin - pred_next_track_sin) + abs(next_track_cos - pred_next_track_cos) AS track_error "
             "FROM (SELECT *, " + preds + " FROM features)")
    scored = ("SELECT *, position_error_km + altitude_error_ft / 1000 + ground_speed_error / 100 + "
              "vert_rate_error / 1000 + track_error AS xgb_anomaly_score FROM resid")
    return (f",\nusable AS ({usable}),\nfeatures AS ({feats}),\nresid AS ({resid}),\n"
            f"scored AS ({scored})\n")


def ml_chain() -> str:
    return chain("silver").rstrip("\n") + features_sql()
