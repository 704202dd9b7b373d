"""Registered queries of the joins over time, ranks, set operations, grouping
sets and sketches.  Imported by ``plans.catalog``."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerotrace.functions.exprs import round6
from aerotrace.operators import rowsets, sketches, temporal
from aerotrace.operators.series import Series
from aerotrace.plans.catalog import _L, live_table, register, traces
from aerotrace.session import stage_table
from aerotrace.sources import fixtures as fx

_T = fx.oracle_ctes("traces")

ASOF_SECONDS = 6 * 3600


@register("asof_join", _L.rstrip() + ",\n" + fx.oracle_ctes("traces")[5:].rstrip() + f"""
SELECT t.row_id, t.icao, t.event_timestamp,
  CASE WHEN near THEN event_time END AS state_time, CASE WHEN near THEN velocity_kmh END AS state_velocity_kmh,
  CASE WHEN near THEN flight_phase END AS state_flight_phase
FROM (SELECT t.*, s.*, date_diff('microsecond', s.event_time, t.event_timestamp) <= {ASOF_SECONDS * 1000000} AS near
      FROM traces t ASOF LEFT JOIN (SELECT icao24, event_time, velocity_kmh, flight_phase FROM live) s
        ON t.icao = s.icao24 AND t.event_timestamp >= s.event_time) t""")
def q_asof_join(spark, b):
    """Every trace row with the aircraft's latest live state within six hours."""
    rows = traces(spark, b).select("row_id", "icao", "event_timestamp")
    states = live_table(spark, b).select(F.col("icao24").alias("icao"), F.col("event_time").alias("time"), "velocity_kmh", "flight_phase")
    joined = temporal.asof_join(rows, states, "icao", "event_timestamp", "time", ASOF_SECONDS, prefix="state_")
    return joined.select("row_id", "icao", "event_timestamp", "state_time", "state_velocity_kmh", "state_flight_phase")


_SPANS = """
, days AS (SELECT icao, data_date, min(event_timestamp) AS day_start, max(event_timestamp) AS day_end FROM traces GROUP BY icao, data_date),
codes AS (SELECT icao, squawk, emergency, min(event_timestamp) AS code_start, max(event_timestamp) AS code_end
          FROM traces WHERE squawk IS NOT NULL GROUP BY icao, squawk, emergency)
"""


@register("interval_overlap_join", _T.rstrip() + _SPANS + """
SELECT d.icao, data_date, squawk, emergency, greatest(day_start, code_start) AS overlap_start, least(day_end, code_end) AS overlap_end
FROM days d JOIN codes c ON d.icao = c.icao AND day_start <= code_end AND code_start <= day_end""")
def q_interval_overlap_join(spark, b):
    """Days on which an aircraft flew against the spans of its transponder codes."""
    rows = traces(spark, b)
    days = rows.groupBy("icao", "data_date").agg(F.min("event_timestamp").alias("day_start"), F.max("event_timestamp").alias("day_end"))
    codes = rows.where("squawk IS NOT NULL").groupBy("icao", "squawk", "emergency").agg(
        F.min("event_timestamp").alias("code_start"), F.max("event_timestamp").alias("code_end"))
    both = temporal.interval_overlap_join(stage_table(days, "days"), stage_table(codes, "codes"), "icao",
                                          ("day_start", "day_end"), ("code_start", "code_end"))
    return both.select("icao", "data_date", "squawk", "emergency", F.greatest("day_start", "code_start").alias("overlap_start"),
                       F.least("day_end", "code_end").alias("overlap_end"))


TRAIL_HOURS = 36
_TRAIL = f"(PARTITION BY icao ORDER BY event_timestamp RANGE BETWEEN INTERVAL {TRAIL_HOURS} HOUR PRECEDING AND CURRENT ROW)"


@register("trailing_range", _T + f"""SELECT row_id, icao, event_timestamp, count(*) OVER w AS n_rows, count(ground_speed) OVER w AS speed_n,
  round(CAST(sum(CAST(ground_speed AS DECIMAL(28, 6))) OVER w AS DOUBLE), 6) AS speed_sum,
  round(CAST(sum(CAST(ground_speed AS DECIMAL(28, 6))) OVER w AS DOUBLE) / nullif(count(ground_speed) OVER w, 0), 6) AS speed_avg
FROM traces WINDOW w AS {_TRAIL}""")
def q_trailing_range(spark, b):
    """Rows and speed of each aircraft over the trailing hours of every row."""
    rows = traces(spark, b).select("row_id", "icao", "event_timestamp", "ground_speed")
    out = temporal.trailing_range(rows, Series.of("icao", "event_timestamp"), TRAIL_HOURS * 3600, {"speed": "ground_speed"})
    return out.select("row_id", "icao", "event_timestamp", "n_rows", "speed_n", round6("speed_sum").alias("speed_sum"),
                      round6("speed_avg").alias("speed_avg"))


@register("rank_family", _T + """SELECT row_id, ground_speed, row_number() OVER (ORDER BY ground_speed NULLS LAST, row_id) AS row_number,
  rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, round(percent_rank() OVER w, 6) AS percent_rank,
  round(cume_dist() OVER w, 6) AS cume_dist, ntile(100) OVER (ORDER BY ground_speed NULLS LAST, row_id) AS ntile
FROM traces WINDOW w AS (ORDER BY ground_speed NULLS LAST)""")
def q_rank_family(spark, b):
    """Ranks of every speed over the whole table."""
    out = rowsets.rank_family(traces(spark, b).select("row_id", "ground_speed"), "ground_speed", ["row_id"])
    return out.withColumns({c: round6(c) for c in ("percent_rank", "cume_dist")})


@register("rank_family_by_category", _T + """SELECT row_id, category, alt_geom, row_number() OVER (PARTITION BY category ORDER BY alt_geom NULLS LAST, row_id) AS row_number,
  rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, round(percent_rank() OVER w, 6) AS percent_rank,
  round(cume_dist() OVER w, 6) AS cume_dist, ntile(7) OVER (PARTITION BY category ORDER BY alt_geom NULLS LAST, row_id) AS ntile
FROM traces WINDOW w AS (PARTITION BY category ORDER BY alt_geom NULLS LAST)""")
def q_rank_family_by(spark, b):
    """Ranks of the altitude within each emitter category, null included."""
    out = rowsets.rank_family(traces(spark, b).select("row_id", "category", "alt_geom"), "alt_geom", ["row_id"], ["category"], tiles=7)
    return out.withColumns({c: round6(c) for c in ("percent_rank", "cume_dist")})


_DIFF = "icao, squawk, emergency, nic"


@register("delivery_difference", fx.oracle_ctes("traces_dup") + f"""
, late AS (SELECT {_DIFF} FROM traces_dup WHERE row_id % 40 <> 7), base AS (SELECT {_DIFF} FROM traces)
SELECT 'added' AS change, * FROM (SELECT * FROM late EXCEPT ALL SELECT * FROM base)
UNION ALL SELECT 'removed', * FROM (SELECT * FROM base EXCEPT ALL SELECT * FROM late)""")
def q_delivery_difference(spark, b):
    """A second delivery, with repeats and gaps, against the first."""
    columns = _DIFF.split(", ")
    late = fx.traces_dup(spark, b).where("row_id % 40 <> 7").select(*columns)
    return rowsets.delivery_difference(traces(spark, b).select(*columns), late)


@register("intersect_all", fx.oracle_ctes("traces_dup") + """
SELECT * FROM (SELECT squawk, emergency, nic, sil FROM traces_dup WHERE row_id % 40 <> 7
               INTERSECT ALL SELECT squawk, emergency, nic, sil FROM traces)""")
def q_intersect_all(spark, b):
    """Rows that both deliveries have, as often as both have them."""
    columns = ["squawk", "emergency", "nic", "sil"]
    late = fx.traces_dup(spark, b).where("row_id % 40 <> 7").select(*columns)
    return rowsets.intersect_all(late, traces(spark, b).select(*columns))


_DIMS = ["origin_country", "flight_phase", "day"]
_SETS = [_DIMS, _DIMS[:2], _DIMS[:1], ["day"], []]


@register("grouping_levels", _L + f"""SELECT origin_country, flight_phase, day, CAST(grouping(origin_country, flight_phase, day) AS BIGINT) AS grouping_id,
  count(*) AS n_rows, count(feet) AS altitude_n, CAST(sum(feet) AS DOUBLE) AS altitude_sum, CAST(min(feet) AS DOUBLE) AS altitude_min,
  CAST(max(feet) AS DOUBLE) AS altitude_max, CAST(sum(feet) AS DOUBLE) / nullif(count(feet), 0) AS altitude_avg
FROM (SELECT *, CAST(event_time AS DATE) AS day, CAST(altitude_ft AS DECIMAL(20, 2)) AS feet FROM live)
GROUP BY GROUPING SETS ({", ".join("(" + ", ".join(s) + ")" for s in _SETS)})""")
def q_grouping_levels(spark, b):
    """Traffic by country, phase and day with subtotals."""
    rows = live_table(spark, b).withColumns({
        "day": F.col("event_time").cast("date"), "feet": F.col("altitude_ft").cast("decimal(20,2)")})
    out = rowsets.grouping_levels(rows, _DIMS, _SETS, {"altitude": "feet"})
    return out.withColumns({f"altitude_{c}": F.col(f"altitude_{c}").cast("double") for c in ("sum", "min", "max")})


@register("sketch_periods", None)
def q_sketch_periods(spark, b):
    """Distinct aircraft and speed quantiles per day, from stored hourly sketches."""
    hourly = stage_table(sketches.hourly_sketches(traces(spark, b), "event_timestamp", [], "icao", "ground_speed"), "hourly-sketches")
    return sketches.merged(hourly, F.col("hour").cast("date"))
