"""Live state path: record projection (PL1-PL14) and the ML serving feed
(PF1-PF5).  Both are single projections (plus one filter for the feed),
shared verbatim by the batch and the streaming plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerotrace.functions import constants as K
from aerotrace.functions.exprs import col, hex_to_long, map_lookup, ntz_from_micros
from aerotrace.operators.panels import altitude_band as _band

SERVING_COLUMNS = ["icao24", "callsign", "origin_country", "event_time", "latitude", "longitude",
                   "baro_altitude", "geo_altitude", "altitude_ft", "altitude_band", "velocity_kmh",
                   "velocity_knots", "vertical_rate", "flight_phase", "true_track", "squawk", "spi",
                   "on_ground", "position_source", "aircraft_category"]

FEED_COLUMNS = ["icao", "segment_id", "event_unix_ts", "lat", "lon", "resolved_altitude",
                "ground_speed", "resolved_vert_rate", "track_sin", "track_cos", "nav_heading_sin",
                "nav_heading_cos", "category", "flight", "nic", "sil"]


def icao_default(c="icao24") -> Column:  # PL1
    return F.coalesce(col(c), F.lit("UNKNOWN"))


def callsign_trim(c="callsign") -> Column:  # PL2
    return F.coalesce(F.trim(col(c)), F.lit(""))


def event_time(last="last_contact", pos="time_position") -> Column:  # PL3
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock), independent of the
    session time zone."""
    return ntz_from_micros(F.coalesce(col(last), col(pos)) * F.lit(1_000_000))


def altitude_ft(baro="baro_altitude", geo="geo_altitude") -> Column:  # PL4
    return F.round(F.coalesce(col(baro), col(geo)) * F.lit(K.M_TO_FT), 2)


def velocity_units(v="velocity") -> dict[str, Column]:  # PL6
    return {"velocity_kmh": F.round(col(v) * F.lit(K.MS_TO_KMH), 2),
            "velocity_knots": F.round(col(v) * F.lit(K.MS_TO_KNOTS), 2)}


def flight_phase(ground="on_ground", rate="vertical_rate") -> Column:  # PL7
    r = col(rate)
    return (F.when(col(ground) == F.lit(True), F.lit("GROUND"))
            .when(r > F.lit(K.PHASE_RATE_MS), F.lit("CLIMB"))
            .when(r < F.lit(-K.PHASE_RATE_MS), F.lit("DESCENT"))
            .otherwise(F.lit("CRUISE")))


def bool_to_byte(c) -> Column:  # PL8
    return F.coalesce(col(c).cast("tinyint"), F.lit(0).cast("tinyint"))


def squawk_blank(c="squawk") -> Column:  # PL9
    return F.coalesce(col(c), F.lit(""))


def position_source_label(c="position_source") -> Column:  # PL10
    return map_lookup(K.POSITION_SOURCE, c, K.POSITION_SOURCE_DEFAULT)


def emitter_category_label(c="category", mapping: dict | None = None) -> Column:  # PL11
    """``mapping`` (``exprs.read_map``, codes as text) in place of the standard labels."""
    if mapping:
        return map_lookup(mapping, col(c).cast("string"), K.LIVE_CATEGORY_DEFAULT)
    return map_lookup(K.LIVE_CATEGORY, c, K.LIVE_CATEGORY_DEFAULT)


def transform_states(df: DataFrame) -> DataFrame:
    """PL1-PL14 composed: one projection.  Booleans are turned into bytes
    only after the band/phase rules have read them (PL8 after PL5/PL7)."""
    alt = altitude_ft()
    band_src = df.select("*", alt.alias("_alt_ft"))
    out = {
        "icao24": icao_default(),
        "callsign": callsign_trim(),
        "origin_country": F.col("origin_country"),
        "time_position": F.col("time_position"),
        "last_contact": F.col("last_contact"),
        "event_time": event_time(),
        "latitude": F.col("latitude").cast("double"),
        "longitude": F.col("longitude").cast("double"),
        "baro_altitude": F.col("baro_altitude").cast("double"),
        "geo_altitude": F.col("geo_altitude").cast("double"),
        "altitude_ft": F.col("_alt_ft"),
        "altitude_band": _band("on_ground", "_alt_ft"),
        "velocity": F.col("velocity"),
        **velocity_units(),
        "vertical_rate": F.col("vertical_rate").cast("double"),
        "flight_phase": flight_phase(),
        "true_track": F.col("true_track").cast("double"),
        "squawk": squawk_blank(),
        "spi": bool_to_byte("spi"),
        "on_ground": bool_to_byte("on_ground"),
        "position_source": position_source_label(),
        "category": F.col("category"),
        "aircraft_category": emitter_category_label(),
    }
    extra = [c for c in df.columns if c not in out and c not in ("sensors", "_alt_ft")]
    res = band_src.select(*[v.alias(k) for k, v in out.items()], *extra)
    # PL12: numeric ICAO address (bad hex -> NULL), for range lookups.
    return res.withColumn("icao24_int", hex_to_long("icao24"))


def to_ml_feed(df: DataFrame) -> DataFrame:
    """PF1-PF5: raw state records -> the 16-column serving feed."""
    rad = F.radians("true_track")
    s, c = F.sin(rad), F.cos(rad)
    out = {
        "icao": F.upper("icao24"),
        "segment_id": F.lit(None).cast("string"),
        "event_unix_ts": F.col("last_contact"),
        "lat": F.col("latitude"),
        "lon": F.col("longitude"),
        "resolved_altitude": F.col("baro_altitude") * F.lit(K.M_TO_FT),
        "ground_speed": F.col("velocity") * F.lit(K.MS_TO_KNOTS),
        "resolved_vert_rate": F.col("vertical_rate") * F.lit(K.MS_TO_FPM),
        "track_sin": s,
        "track_cos": c,
        "nav_heading_sin": s,
        "nav_heading_cos": c,
        "category": map_lookup(K.FEED_CATEGORY, "category", K.FEED_CATEGORY_DEFAULT),
        "flight": F.trim(F.coalesce(F.col("callsign"), F.lit(""))),
        "nic": F.lit(K.FEED_NIC),
        "sil": F.lit(K.FEED_SIL),
    }
    extra = [c for c in ("row_id",) if c in df.columns]
    return (df.select(*[v.alias(k) for k, v in out.items()], *extra)
            .dropna(subset=["lat", "lon"]))
