"""Validation, monitoring and reporting aggregates (AG*, GF*, PB*).

All are ``groupBy``/``agg`` plans: partial aggregation on the map side, one
shuffle of already-reduced rows.  Distinct counts use exact
``count(DISTINCT)`` (Spark plans it as a two-level aggregate, again
map-side reduced); top-k panels are ``orderBy().limit()``, which Spark runs
as a per-partition top-k merged on one side (TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerotrace.functions import constants as K
from aerotrace.functions.exprs import epoch_micros_ntz, epoch_seconds_ntz, ntz_from_micros


# --- AG: bronze validation queries -----------------------------------------
def val_daily_coverage(df: DataFrame) -> DataFrame:  # AG1
    """Each distinct count goes through its own (date, value) groups, reduced
    before the shuffle, instead of an expansion of every row; the small
    per-date results are joined."""
    def distinct(value, name):
        return (df.groupBy("data_date", value).agg(F.lit(1)).groupBy("data_date")
                .agg(F.count(value).alias(name)).withColumnRenamed("data_date", f"_{name}"))
    days = df.groupBy("data_date").agg(F.count("*").alias("total_rows"), F.min("event_timestamp").alias("first_event"),
                                       F.max("event_timestamp").alias("last_event"))
    for value, name in (("icao", "unique_aircraft"), ("flight", "unique_flights")):
        counts = distinct(value, name)
        days = days.join(counts, days["data_date"].eqNullSafe(counts[f"_{name}"])).drop(f"_{name}")
    return days.select("data_date", "total_rows", "unique_aircraft", "unique_flights", "first_event", "last_event").orderBy("data_date")


def val_missing_counts(df: DataFrame) -> DataFrame:  # AG2
    return df.agg(F.count("*").alias("total_rows"),
                  F.count_if(F.col("icao").isNull()).alias("missing_icao"),
                  F.count_if(F.col("lat").isNull() | F.col("lon").isNull()).alias("missing_position"),
                  F.count_if(F.col("event_timestamp").isNull()).alias("missing_event_timestamp"))


def val_position_types(df: DataFrame) -> DataFrame:  # AG3
    return df.groupBy("position_type").agg(F.count("*").alias("records")) \
        .orderBy(F.desc("records"))


def target_mae(df: DataFrame, pairs: dict[str, str]) -> DataFrame:  # AG4
    """Mean absolute error per target: ``pairs = {target: prediction}``."""
    row = df.agg(*[F.avg(F.abs(F.col(t) - F.col(p))).alias(t) for t, p in pairs.items()])
    return row.unpivot([], list(pairs), "target", "mae")


# --- GF: live monitoring panels (aircraft_states) ---------------------------
def active_aircraft_trend(df: DataFrame, minutes: int = 1) -> DataFrame:  # GF1
    w = F.window("event_time", f"{minutes} minutes")
    return df.groupBy(w.alias("w")).agg(F.countDistinct("icao24").alias("active_aircraft")) \
        .select(F.col("w.start").alias("window_start"), "active_aircraft")


def geo_grid_density(df: DataFrame, cell: float = 1.0) -> DataFrame:  # GF2
    located = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return (located.groupBy((F.floor(F.col("latitude") / cell) * cell).cast("double").alias("lat_cell"),
                            (F.floor(F.col("longitude") / cell) * cell).cast("double").alias("lon_cell"))
            .agg(F.count("*").alias("n_rows"), F.countDistinct("icao24").alias("n_aircraft")))


def missing_geo_pct(df: DataFrame) -> DataFrame:  # GF3
    missing = F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull())
    return df.agg(F.round(F.lit(100.0) * missing / F.count("*"), 6).alias("missing_geo_pct"))


def stream_lag(df: DataFrame, ingest="ingested_at") -> DataFrame:  # GF4
    lag = (epoch_seconds_ntz(ingest) - epoch_seconds_ntz("event_time")).cast("double")
    minute = ntz_from_micros(F.floor(epoch_micros_ntz("event_time") / F.lit(60_000_000)) * F.lit(60_000_000))
    return (df.groupBy(minute.alias("minute"))
            .agg(F.round(F.avg(lag), 6).alias("avg_lag_s"), F.max(lag).alias("max_lag_s")))


def missing_key_fields(df: DataFrame) -> DataFrame:  # GF5
    def blank(c):
        return F.col(c).isNull() | (F.trim(F.col(c)) == F.lit(""))
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(blank("icao24") | (F.col("icao24") == F.lit("UNKNOWN"))).alias("missing_icao24"),
        F.count_if(blank("callsign")).alias("missing_callsign"),
        F.count_if(blank("squawk")).alias("missing_squawk"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("missing_position"),
        F.count_if(F.col("altitude_ft").isNull()).alias("missing_altitude"),
        F.count_if(F.col("velocity_knots").isNull()).alias("missing_velocity"))


def share(count_col: str = "n_rows") -> F.Column:
    # A window over the tiny grouped result (one row per group), not the data.
    return F.round(F.lit(100.0) * F.col(count_col) / F.sum(count_col).over(Window.partitionBy()), 6)


def phase_distribution(df: DataFrame) -> DataFrame:  # GF6
    g = df.groupBy("flight_phase").agg(F.count("*").alias("n_rows"))
    return g.select("flight_phase", "n_rows", share().alias("share_pct"))


def fastest_aircraft(df: DataFrame, n: int = 10) -> DataFrame:  # GF7 (top-k is the feature)
    return (df.groupBy("icao24").agg(F.max("velocity_knots").alias("max_velocity_knots"))
            .filter(F.col("max_velocity_knots").isNotNull())
            .orderBy(F.desc("max_velocity_knots"), F.asc("icao24")).limit(n))


def high_speed_outliers(df: DataFrame, knots: float = 600.0) -> DataFrame:  # GF8
    return df.filter(F.col("velocity_knots") > F.lit(knots))


def extreme_vertical_rate(df: DataFrame, ms: float = 25.0) -> DataFrame:  # GF9
    return df.filter(F.abs(F.col("vertical_rate")) > F.lit(ms))


def top_steep_descents(df: DataFrame, n: int = 10, tiebreak: str = "row_id") -> DataFrame:  # GF10
    return (df.filter((F.col("flight_phase") == "DESCENT") & F.col("vertical_rate").isNotNull())
            .orderBy(F.asc("vertical_rate"), F.asc(tiebreak)).limit(n))


def source_quality(df: DataFrame) -> DataFrame:  # GF11
    missing = F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull())
    g = df.groupBy("position_source").agg(F.count("*").alias("n_rows"),
                                          F.round(F.lit(100.0) * missing / F.count("*"), 6)
                                          .alias("missing_geo_pct"))
    return g.select("position_source", "n_rows", share().alias("share_pct"), "missing_geo_pct")


# --- PB: historical reporting panels (gold) ---------------------------------
def aircraft_count_over_time(df: DataFrame, grain: str = "event_date") -> DataFrame:  # PB1
    return df.groupBy(grain).agg(F.countDistinct("icao").alias("n_aircraft"))


def avg_velocity_over_time(df: DataFrame, grain: str = "event_date") -> DataFrame:  # PB2
    return df.groupBy(grain).agg(F.round(F.avg("ground_speed"), 6).alias("avg_ground_speed"))


def avg_altitude_over_time(df: DataFrame, grain: str = "event_date") -> DataFrame:  # PB3
    return df.groupBy(grain).agg(F.round(F.avg("resolved_altitude"), 6).alias("avg_altitude"))


def phase_distribution_hist(df: DataFrame) -> DataFrame:  # PB4
    return df.groupBy("climb_state").agg(F.count("*").alias("n_rows"))


def vert_rate_histogram(df: DataFrame, width: int = 500) -> DataFrame:  # PB5
    bucket = (F.floor(F.col("resolved_vert_rate") / width) * width).cast("bigint")
    return df.groupBy(bucket.alias("vert_rate_bucket")).agg(F.count("*").alias("n_rows"))


def top_countries(df: DataFrame, n: int = 10) -> DataFrame:  # PB6 (top-k is the feature)
    return (df.groupBy("origin_country")
            .agg(F.count("*").alias("n_rows"), F.countDistinct("icao24").alias("n_aircraft"))
            .orderBy(F.desc("n_rows"), F.asc("origin_country")).limit(n))


def active_aircraft_kpi(df: DataFrame, start=None, end=None, ts="event_timestamp") -> DataFrame:  # PB7
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(ts) < F.lit(end))
    return df.agg(F.countDistinct("icao").alias("active_aircraft"))


def airborne_ground_split(df: DataFrame) -> DataFrame:  # PB8
    return df.groupBy("is_on_ground").agg(F.count("*").alias("n_rows"))


def altitude_band(ground: str, altitude: str) -> F.Column:  # PL5 rule, reused by PB9
    a = F.col(altitude)
    out = F.when(F.col(ground) == F.lit(True), F.lit("GROUND")).when(a.isNull(), F.lit("UNKNOWN"))
    for limit, label in K.ALTITUDE_BANDS_FT:
        out = out.when(a < F.lit(limit), F.lit(label))
    return out.otherwise(F.lit("VERY_HIGH"))


def altitude_band_hist(df: DataFrame) -> DataFrame:  # PB9
    return df.groupBy(altitude_band("is_on_ground", "resolved_altitude").alias("altitude_band")) \
        .agg(F.count("*").alias("n_rows"))
