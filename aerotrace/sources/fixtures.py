"""Deterministic telemetry-shaped inputs derived from the driver tables.

The driver ships generic tables (``events``, ``nation``); these views turn
them into flat trace observations, live state records and ICAO address
ranges.  Each text is portable SQL: Spark runs it over the scanned
DataFrames and the DuckDB oracle inlines the same text as a CTE, so both
engines start from identical rows.  ``row_id`` is the tie-break of every
window.  The derivations are row-wise projections of the whole table
(no shuffle), so they scale with the inputs.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from aerotrace.session import listing
from aerotrace.sources.tables import read_table

TRACES_SQL = """
SELECT
  'a' || lpad(CAST(user_id AS STRING), 5, '0') AS icao,
  CASE WHEN user_id % 10 = 9 THEN NULL WHEN event_id % 3 = 0 THEN 'n' || CAST(user_id AS STRING) END AS registration,
  CASE WHEN user_id % 10 = 9 THEN NULL WHEN event_id % 4 = 0 THEN 'b73' || CAST(user_id % 10 AS STRING) END AS aircraft_type,
  CASE WHEN user_id % 10 = 9 THEN NULL WHEN event_id % 5 = 0 THEN ' TYPE ' || CAST(user_id % 7 AS STRING) || ' ' END AS description,
  CAST(user_id % 4 AS INT) AS db_flags,
  CAST(ts AS DATE) AS data_date,
  ts AS event_timestamp,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id * 37) % 20000 AS DOUBLE) / 100 - 100 END AS lat,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id * 91) % 40000 AS DOUBLE) / 100 - 200 END AS lon,
  CASE WHEN event_id % 9 = 0 THEN 'ground' WHEN event_id % 9 = 1 THEN NULL ELSE CAST((event_id * 53) % 45000 AS STRING) END AS alt_baro,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST((event_id * 59) % 45000 AS DOUBLE) END AS alt_geom,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE value * 5 END AS ground_speed,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST((event_id * 29) % 380 AS DOUBLE) END AS track,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST((event_id * 17) % 4000 AS DOUBLE) - 2000 END AS vert_rate,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST((event_id * 19) % 4000 AS DOUBLE) - 2000 END AS geom_vert_rate,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 4 END AS ias,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 60 AS DOUBLE) - 30 END AS roll,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 16 AS INT) END AS trace_flags,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE (event_id % 16) & 1 > 0 END AS is_stale,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE (event_id % 16) & 2 > 0 END AS is_new_leg,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE (event_id % 16) & 4 > 0 END AS is_geom_rate,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE (event_id % 16) & 8 > 0 END AS is_geom_alt,
  CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'adsb_icao' WHEN 1 THEN 'mlat' WHEN 2 THEN 'tisb-icao' WHEN 3 THEN 'weird' WHEN 4 THEN ' ' END AS position_type,
  CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'ual' || CAST(user_id AS STRING) || ' ' WHEN 1 THEN 'N' || CAST(user_id AS STRING) WHEN 2 THEN '@@@' WHEN 3 THEN '  ' WHEN 4 THEN 'LONGCALL99' END AS flight,
  CASE WHEN event_id % 101 = 0 THEN '7700' WHEN event_id % 103 = 0 THEN '7600' WHEN event_id % 107 = 0 THEN '7500' WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN '9999' ELSE '1200' END AS squawk,
  CASE event_type WHEN 'error' THEN 'general' WHEN 'click' THEN 'none' WHEN 'view' THEN 'bogus' WHEN 'signup' THEN 'minfuel' END AS emergency,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'a' || CAST(user_id % 9 AS STRING) END AS category,
  CASE WHEN event_id % 3 = 1 THEN NULL ELSE CAST((event_id * 100) % 45000 AS DOUBLE) END AS nav_altitude_mcp,
  CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST((event_id * 100) % 45000 AS DOUBLE) END AS nav_altitude_fms,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 7) % 400 AS DOUBLE) END AS nav_heading,
  CASE WHEN event_id % 11 = 1 THEN NULL ELSE 700 + CAST((event_id * 3) % 500 AS DOUBLE) END AS nav_qnh,
  CAST(event_id % 13 AS INT) AS nic, CAST((event_id * 10) % 5000 AS DOUBLE) AS rc,
  CAST(event_id % 14 AS INT) AS nac_p, CAST(event_id % 6 AS INT) AS nac_v, CAST(event_id % 5 AS INT) AS sil,
  CASE WHEN event_id % 2 = 0 THEN 'perhour' END AS sil_type,
  CAST(event_id % 4 AS INT) AS gva, CAST(event_id % 5 AS INT) AS sda, CAST(event_id % 4 AS INT) AS version,
  'trace_full_' || CAST(user_id AS STRING) || '.json' AS source_file,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts + INTERVAL 90 SECOND END AS ingestion_ts,
  event_id AS row_id
FROM {events}
"""

STATES_SQL = """
SELECT
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN '~b' || lpad(CAST(user_id AS STRING), 5, '0')
       ELSE 'a' || lpad(CAST(user_id AS STRING), 5, '0') END AS icao24,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE ' CS' || CAST(user_id AS STRING) || ' ' END AS callsign,
  'country_' || CAST(user_id % 12 AS STRING) AS origin_country,
  1704067200 + event_id * 60 AS time_position,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 1704067203 + event_id * 60 END AS last_contact,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id * 91) % 36000 AS DOUBLE) / 100 - 180 END AS longitude,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id * 37) % 18000 AS DOUBLE) / 100 - 90 END AS latitude,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST((event_id * 53) % 13500 AS DOUBLE) END AS baro_altitude,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 11 = 1 END AS on_ground,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE value END AS velocity,
  CAST((event_id * 29) % 360 AS DOUBLE) AS true_track,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST((event_id * 5) % 80 AS DOUBLE) * 0.75 - 30 END AS vertical_rate,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST((event_id * 59) % 13500 AS DOUBLE) END AS geo_altitude,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE '1200' END AS squawk,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 3 = 1 END AS spi,
  CAST(event_id % 5 AS INT) AS position_source,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 23 AS INT) END AS category,
  event_id AS row_id
FROM {events}
"""

RANGES_SQL = """
SELECT CAST(10485760 + n_nationkey * 16 AS BIGINT) AS range_start,
       CAST(10485760 + n_nationkey * 16 + 15 AS BIGINT) AS range_end,
       n_name AS country
FROM {nation}
"""

# Dedup input: every 50th observation is delivered a second time, one
# second later, under a new row id (a re-run load).
TRACES_DUP_SQL = """
SELECT * FROM {traces}
UNION ALL
SELECT icao, registration, aircraft_type, description, db_flags, data_date, event_timestamp,
       lat, lon, alt_baro, alt_geom, ground_speed, track, vert_rate, geom_vert_rate, ias, roll,
       trace_flags, is_stale, is_new_leg, is_geom_rate, is_geom_alt, position_type, flight, squawk,
       emergency, category, nav_altitude_mcp, nav_altitude_fms, nav_heading, nav_qnh, nic, rc,
       nac_p, nac_v, sil, sil_type, gva, sda, version, source_file,
       ingestion_ts + INTERVAL 1 SECOND AS ingestion_ts, row_id + 1000000000 AS row_id
FROM {traces} WHERE row_id % 50 = 0
"""

# Sequence-model stand-in: a third of the rows carry a confirmation verdict.
CHRONOS_SQL = """
SELECT upper(icao) AS icao, event_timestamp,
       CAST(NULL AS DOUBLE) AS chronos_score,
       CASE WHEN row_id % 5 = 0 THEN NULL ELSE row_id % 2 = 0 END AS chronos_confirmed
FROM {traces} WHERE row_id % 3 = 0
"""


def version(spark: SparkSession, base: str) -> str:
    """A digest of the names, sizes and times of the files of the tables that
    the views read, to notice changed input: one listing per table."""
    seen = hashlib.sha256()
    for table in ("events", "nation"):
        for pattern in (f"{table}.parquet", f"{table}.parquet/*"):  # a file or a folder of files
            listed = listing(spark, f"{base.rstrip('/')}/{pattern}")
            seen.update(re.sub(r"access_time=\d+", "", listed).encode())
    return seen.hexdigest()


def traces(spark: SparkSession, base: str) -> DataFrame:
    return spark.sql(TRACES_SQL, events=read_table(spark, base, "events"))


def states(spark: SparkSession, base: str) -> DataFrame:
    return spark.sql(STATES_SQL, events=read_table(spark, base, "events"))


def ranges(spark: SparkSession, base: str) -> DataFrame:
    return spark.sql(RANGES_SQL, nation=read_table(spark, base, "nation"))


def traces_dup(spark: SparkSession, base: str) -> DataFrame:
    return spark.sql(TRACES_DUP_SQL, traces=traces(spark, base))


def chronos_standin(spark: SparkSession, base: str) -> DataFrame:
    return spark.sql(CHRONOS_SQL, traces=traces(spark, base))


def oracle_ctes(*names: str) -> str:
    """``WITH`` clause defining the named fixture views for the SQL oracle."""
    texts = {
        "traces": TRACES_SQL.format(events="events"),
        "states": STATES_SQL.format(events="events"),
        "ranges": RANGES_SQL.format(nation="nation"),
        "traces_dup": TRACES_DUP_SQL.format(traces="traces"),
        "chronos": CHRONOS_SQL.format(traces="traces"),
    }
    needed = list(names)
    if any(n in ("traces_dup", "chronos") for n in needed) and "traces" not in needed:
        needed.insert(0, "traces")
    return "WITH " + ",\n".join(f"{n} AS ({texts[n]})" for n in needed) + "\n"
