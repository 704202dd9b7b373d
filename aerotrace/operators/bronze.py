"""Bronze: raw trace documents -> flat observation rows (FL1-FL7).

A trace document (one per aircraft per day) carries aircraft identity at
the top level and a ``trace`` array of positional point arrays whose slot 8
is an object of per-point details.  Flattening is a VARIANT lateral explode
followed by typed path extraction; each document is processed by one task
and the explode is a generator inside that task (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerotrace.functions import constants as K
from aerotrace.functions.exprs import epoch_micros_ntz, epoch_ntz, json_unbracket, ntz_from_micros
from aerotrace.operators.series import CHUNK, Series

# --- fixed values: positional slots of a trace point ---
POINT_SLOTS = {
    "offset": (0, "double"),
    "lat": (1, "double"),
    "lon": (2, "double"),
    "alt_baro": (3, "string"),
    "ground_speed": (4, "double"),
    "track": (5, "double"),
    "trace_flags": (6, "int"),
    "vert_rate": (7, "double"),
    "position_type": (9, "string"),
    "alt_geom": (10, "double"),
    "geom_vert_rate": (11, "double"),
    "ias": (12, "double"),
    "roll": (13, "double"),
}
# --- fixed values: fields of the slot-8 detail object ---
DETAIL_FIELDS = {
    "flight": "string", "squawk": "string", "emergency": "string", "category": "string",
    "nav_altitude_mcp": "double", "nav_altitude_fms": "double", "nav_heading": "double",
    "nav_qnh": "double", "nic": "int", "rc": "double", "nac_p": "int", "nac_v": "int",
    "sil": "int", "sil_type": "string", "gva": "int", "sda": "int", "version": "int",
}
# --- fixed values: top-level document fields ---
DOC_FIELDS = {"icao": ("icao", "string"), "registration": ("r", "string"),
              "aircraft_type": ("t", "string"), "description": ("desc", "string"),
              "db_flags": ("dbFlags", "int")}

FLAT_ORDER = ["icao", "registration", "aircraft_type", "description", "db_flags", "data_date",
              "event_timestamp", "lat", "lon", "alt_baro", "alt_geom", "ground_speed", "track",
              "vert_rate", "geom_vert_rate", "ias", "roll", "trace_flags", "is_stale", "is_new_leg",
              "is_geom_rate", "is_geom_alt", "position_type", "flight", "squawk", "emergency",
              "category", "nav_altitude_mcp", "nav_altitude_fms", "nav_heading", "nav_qnh", "nic",
              "rc", "nac_p", "nac_v", "sil", "sil_type", "gva", "sda", "version", "source_file",
              "ingestion_ts"]


def flatten_traces(raw: DataFrame, doc: str = "raw_json") -> DataFrame:
    """FL1-FL7 composed: one row per trace point, 42 columns.

    ``raw`` has the document (VARIANT, or JSON text parsed with
    ``try_parse_json``) plus lineage columns ``source_file``, ``data_date``,
    ``ingestion_ts``.  A document with a missing, null or empty ``trace``
    (or malformed text) yields no rows.
    """
    v = F.col(doc)
    if dict(raw.dtypes)[doc] == "string":
        v = F.try_parse_json(v)
    docs = raw.select(v.alias("_v"), "source_file", "data_date", "ingestion_ts")
    # FL1: lateral flatten of the trace array (variant_explode skips null/empty)
    points = docs.select("*", F.explode(F.try_variant_get("_v", "$.trace", "array<variant>")).alias("_t"))
    cols = {}
    for name, (path, typ) in DOC_FIELDS.items():  # FL2
        cols[name] = F.try_variant_get("_v", f"$.{path}", typ)
    cols["data_date"] = F.col("data_date")
    # FL5: whole-second base (floored) + fractional per-point offset, to the microsecond
    base = F.floor(F.try_variant_get("_v", "$.timestamp", "double")).cast("long")
    offset = F.try_variant_get("_t", "$[0]", "double")
    cols["event_timestamp"] = ntz_from_micros(base * F.lit(1_000_000)
                                              + F.round(offset * F.lit(1e6)).cast("long"))
    for name, (slot, typ) in POINT_SLOTS.items():  # FL3
        if name != "offset":
            cols[name] = F.try_variant_get("_t", f"$[{slot}]", typ)
    flags = cols["trace_flags"]
    for name, bit in K.FLAG_BITS.items():  # FL6
        cols[name] = flags.bitwiseAND(F.lit(bit)) > 0
    for name, typ in DETAIL_FIELDS.items():  # FL4
        cols[name] = F.try_variant_get("_t", f"$[8].{name}", typ)
    cols["source_file"] = F.col("source_file")  # FL7 lineage
    cols["ingestion_ts"] = F.col("ingestion_ts")
    return points.select(*[cols[c].alias(c) for c in FLAT_ORDER])


def _json_value(c, numeric: bool):
    if numeric:
        return F.coalesce(F.col(c).cast("string"), F.lit("null")) if isinstance(c, str) else \
            F.coalesce(c.cast("string"), F.lit("null"))
    col = F.col(c) if isinstance(c, str) else c
    return json_unbracket(F.to_json(F.array(col)))


def trace_documents(flat: DataFrame, slice_minutes: int | None = None, max_points: int = 20_000) -> DataFrame:
    """Inverse of :func:`flatten_traces`, used to produce raw documents from
    flat observations: one document per (aircraft, day).  Document-level
    fields take the day's maximum; ``alt_baro`` is written as a number when
    numeric and as a string (``"ground"``) otherwise.

    Each document holds an aircraft-day, or the hours of one with more than
    ``max_points`` reports; with ``slice_minutes`` that many minutes of it.
    Slices of more than ``max_points`` reports are cut finer
    (``Series.with_chunk``).  Each carries the whole day's header; flattening
    the slices gives the same rows as one document a day would."""
    day_start = F.timestamp_diff("SECOND", epoch_ntz(), F.col("data_date").cast("timestamp_ntz"))
    off = (epoch_micros_ntz("event_timestamp") - day_start * F.lit(1_000_000)) / F.lit(1e6)
    alt = F.when(F.col("alt_baro").try_cast("double").isNotNull(), F.col("alt_baro")) \
        .otherwise(_json_value("alt_baro", False))
    detail = F.to_json(F.struct(*[F.col(c) for c in DETAIL_FIELDS]))
    slots = [F.coalesce(off.cast("string"), F.lit("null"))]
    by_slot = {slot: name for name, (slot, _) in POINT_SLOTS.items()}
    for i in range(1, 14):
        if i == 8:
            slots.append(detail)
        elif by_slot[i] == "alt_baro":
            slots.append(F.coalesce(alt, F.lit("null")))
        elif by_slot[i] == "position_type":
            slots.append(_json_value("position_type", False))
        else:
            slots.append(_json_value(by_slot[i], True))
    point = F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]"))
    # header fields: document key -> source column
    header = {"r": "registration", "t": "aircraft_type", "desc": "description", "dbFlags": "db_flags",
              "source_file": "source_file", "ingestion_ts": "ingestion_ts"}
    cut = Series.of(["icao", "data_date"], "event_timestamp", chunk_seconds=(slice_minutes or 60) * 60,
                    max_chunk_rows=max_points, whole_rows=None if slice_minutes else max_points)
    keyed = cut.with_chunk(flat, spread=False).select("icao", "data_date", F.col(CHUNK).alias("_part"), *header.values(), "event_timestamp",
                        point.alias("_p"), day_start.alias("_base"))
    docs = keyed.groupBy("icao", "data_date", "_part").agg(
        *[F.max(c).alias(k) for k, c in header.items()], F.first("_base").alias("timestamp"),
        F.array_sort(F.collect_list(F.struct("event_timestamp", "_p"))).alias("_pts"))
    # the day's header from its slices, a row each
    day = Window.partitionBy("icao", "data_date")
    docs = docs.withColumns({k: F.max(k).over(day) for k in header})
    docs = docs.withColumn("_h", F.to_json(F.struct("icao", "r", "t", "desc", "dbFlags", "timestamp")))
    body = F.concat_ws(",", F.transform("_pts", lambda x: x["_p"]))
    # header object without its closing brace, then the trace array
    raw = F.concat(F.expr("substr(_h, 1, length(_h) - 1)"), F.lit(',"trace":['), body, F.lit("]}"))
    return docs.select(raw.alias("raw_json"), "source_file", "data_date", "ingestion_ts")


def read_trace_files(spark, path: str, data_date: str, pattern: str = "trace_full_*.json") -> DataFrame:
    """SRC4: trace JSON files -> raw documents with lineage.

    Each file is read whole (``wholetext``); a file may hold one document or
    an outer array of documents (stripped).  Bad UTF-8 is replaced rather
    than failing the load; malformed documents become null and flatten to no
    rows.  ``_metadata.file_path`` gives the source file."""
    text = (spark.read.option("wholetext", True).option("pathGlobFilter", pattern)
            .text(path).select("value", F.col("_metadata.file_path").alias("source_file")))
    v = F.try_parse_json("value")
    docs = text.select(v.alias("_v"), "source_file")
    # an outer array gives its elements, anything else (also a malformed document) itself
    inner = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.array("_v"))
    return docs.select(F.explode(inner).alias("raw_json"), "source_file").select(
        "raw_json", "source_file", F.lit(data_date).cast("date").alias("data_date"),
        F.localtimestamp().alias("ingestion_ts"))
