"""Star schema (KEY1, ST1-ST9).

Dimensions are ``select -> distinct`` (a partial aggregate, so map tasks
drop repeats before the shuffle).  The fact is a pure projection of the
enriched table.  The star join broadcasts the dimensions that
are counted to be small and joins the others by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerotrace.functions.exprs import identity_key, surrogate_key
from aerotrace.session import stage_table

KEYS = {
    "aircraft_key": ["icao", "registration", "aircraft_type"],
    "flight_key": ["flight", "callsign_class"],
    "date_key": ["event_date"],
    "time_key": ["event_hour", "event_minute"],
    "squawk_key": ["squawk", "squawk_category"],
    "emergency_key": ["emergency", "has_emergency"],
    "trace_flags_key": ["trace_flags", "is_new_leg", "is_geom_rate", "is_geom_alt"],
}

DIMENSIONS = {
    "dim_aircraft": ("aircraft_key", ["icao", "registration", "aircraft_type", "description",
                                      "category", "category_label"]),
    "dim_flight": ("flight_key", ["flight", "callsign_class"]),
    "dim_date": ("date_key", ["event_date", "event_year", "event_month", "event_dow"]),
    "dim_time": ("time_key", ["event_hour", "event_minute"]),
    "dim_squawk": ("squawk_key", ["squawk", "squawk_category"]),
    "dim_emergency": ("emergency_key", ["emergency", "has_emergency"]),
    "dim_trace_flags": ("trace_flags_key", ["trace_flags", "is_new_leg", "is_geom_rate",
                                            "is_geom_alt", "position_type",
                                            "signal_integrity_class"]),
}

BROADCAST_ROWS = 100_000  # a dimension of up to this many rows is broadcast

#: Dimensions whose domain bounds their rows: 25 hours (null too) of 61 minutes.
BOUNDED = ("dim_time",)

MEASURES = ["event_timestamp", "lat", "lon", "resolved_altitude", "ground_speed",
            "resolved_vert_rate", "track", "climb_state", "is_on_ground", "ingestion_lag_seconds"]


def key_expr(name: str):
    return surrogate_key(*KEYS[name]).alias(name)


def dimension(df: DataFrame, name: str) -> DataFrame:
    """The distinct attributes, then their key: one md5 per dimension row."""
    key, attrs = DIMENSIONS[name]
    return df.select(*attrs).distinct().select(key_expr(key), *attrs)


def unique_dimension(df: DataFrame, name: str, latest=("event_timestamp", "row_id")) -> DataFrame:
    """One row per key: the attributes of the latest observation (ST1 and
    ST7 keys do not cover all attributes, so their plain dimension can hold
    several rows per key and a join would fan out)."""
    key, attrs = DIMENSIONS[name]
    latest = [c for c in latest if c in df.columns]
    more = [a for a in attrs if a not in KEYS[key]]
    if not more:
        return dimension(df, name)
    best = F.max(F.struct(*[F.col(c) for c in latest], *[F.col(a) for a in more])).alias("_b")
    rows = df.groupBy(*KEYS[key]).agg(best)
    return rows.select(key_expr(key), *[F.col(f"_b.{a}").alias(a) if a in more else F.col(a) for a in attrs])


def fact(df: DataFrame) -> DataFrame:
    return df.select(identity_key("icao", "event_timestamp").alias("trace_key"),
                     *[key_expr(k) for k in KEYS], *MEASURES)


def build_star(df: DataFrame) -> dict[str, DataFrame]:
    """All eight tables of the star (ST1-ST8).  Persist ``df`` (or write it
    once) before calling when all eight are materialised: each reads it."""
    out = {name: dimension(df, name) for name in DIMENSIONS}
    out["fact_flight_trace"] = fact(df)
    return out


def star_join(df: DataFrame) -> DataFrame:
    """ST9: the fact joined to every dimension, as the BI model reads it.

    Dimensions whose values bound their rows (``BOUNDED``) are broadcast.  Each
    of the others is stored once and counted.  Up to ``BROADCAST_ROWS`` it is
    broadcast, so the fact is read once and not shuffled for it; a larger one
    is joined by shuffle between two stored tables, where AQE can split the
    partition of a hot key (the missing callsign, for one)."""
    f = fact(df)
    taken = set(f.columns)
    for name, (key, attrs) in DIMENSIONS.items():
        d = unique_dimension(df, name).drop(*[a for a in attrs if a in taken])
        taken |= set(d.columns)
        if name in BOUNDED:
            f = f.join(F.broadcast(d), key, "left")
            continue
        d = stage_table(d, name)
        f = f.join(F.broadcast(d) if d.count() <= BROADCAST_ROWS else d, key, "left")
    return f
