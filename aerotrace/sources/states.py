"""Live state records: stream source (SRC1), JSON parsing (SRC2) and the
positional-array payload unpacking (SRC3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerotrace.functions.exprs import json_unbracket
from aerotrace.operators.prefix import row_positions

STATE_SCHEMA = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("time_position", T.LongType()),
    T.StructField("last_contact", T.LongType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("baro_altitude", T.DoubleType()),
    T.StructField("on_ground", T.BooleanType()),
    T.StructField("velocity", T.DoubleType()),
    T.StructField("true_track", T.DoubleType()),
    T.StructField("vertical_rate", T.DoubleType()),
    T.StructField("sensors", T.ArrayType(T.IntegerType())),
    T.StructField("geo_altitude", T.DoubleType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("spi", T.BooleanType()),
    T.StructField("position_source", T.IntegerType()),
    T.StructField("category", T.IntegerType()),
])
STATE_FIELDS = [f.name for f in STATE_SCHEMA.fields]


def parse_states(df: DataFrame, col: str = "value") -> DataFrame:
    """SRC2: JSON text -> the 18 typed fields (PERMISSIVE: malformed -> nulls).
    Other columns of ``df`` are kept."""
    other = [c for c in df.columns if c != col]
    parsed = df.select(F.from_json(F.col(col).cast("string"), STATE_SCHEMA,
                                   {"mode": "PERMISSIVE"}).alias("_s"), *other)
    return parsed.select(*[F.col(f"_s.{c}").alias(c) for c in STATE_FIELDS], *other)


#: What a Kafka read needs, and what it takes when nothing else is said.
KAFKA_REQUIRED = ("kafka.bootstrap.servers",)
KAFKA_TOPIC = ("subscribe", "subscribePattern", "assign")
KAFKA_DEFAULTS = {"startingOffsets": "latest"}


def kafka_options(options: dict) -> dict[str, str]:
    """The full option set of a Kafka read; raises where the broker or the
    topic is missing, or the topic is given in two ways."""
    missing = [k for k in KAFKA_REQUIRED if not options.get(k)]
    topics = [k for k in KAFKA_TOPIC if options.get(k)]
    if missing or len(topics) != 1:
        raise ValueError(f"a Kafka read needs {', '.join(KAFKA_REQUIRED)} and one of {', '.join(KAFKA_TOPIC)}; got {sorted(options)}")
    return {k: str(v) for k, v in {**KAFKA_DEFAULTS, **options}.items()}


def read_states_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                       path: str | None = None) -> DataFrame:
    """SRC1: subscribe to the state topic (``fmt="kafka"``, options such as
    ``kafka.bootstrap.servers``/``subscribe``/``startingOffsets``) or, for
    tests and replays, a directory of JSON-lines text files (``fmt="text"``).
    Either way the value is parsed by :func:`parse_states`."""
    reader = spark.readStream.format(fmt)
    opts = kafka_options(options or {}) if fmt == "kafka" else options or {}
    for k, v in opts.items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path else reader.load()
    return parse_states(raw.selectExpr("CAST(value AS STRING) AS value"))


def _json_scalar(c: str, dtype: T.DataType):
    """JSON text of one value (null -> ``null``); strings are quoted/escaped."""
    v = F.col(c)
    if isinstance(dtype, T.StringType):
        return json_unbracket(F.to_json(F.array(v)))
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.to_json(v), F.lit("null"))
    return F.coalesce(v.cast("string"), F.lit("null"))


def state_payloads(states: DataFrame, poll_seconds: int = 10, short_every: int = 89,
                   rows_per_payload: int = 2000) -> DataFrame:
    """Build poll responses ``{"time": t, "states": [[...18 slots...], ...]}``
    from flat state records, one payload per poll interval.  Every
    ``short_every``-th record (by ``row_id``) is sent as a 15-slot array, as
    older responses do.  A poll of more than ``rows_per_payload`` records is
    sent as several payloads, cut by the record's position in the poll."""
    dtypes = {f.name: f.dataType for f in STATE_SCHEMA.fields}
    slots = [_json_scalar(c, dtypes[c]) if c in states.columns else F.lit("null") for c in STATE_FIELDS]
    full = F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]"))
    short = F.concat(F.lit("["), F.concat_ws(",", *slots[:15]), F.lit("]"))
    arr = F.when(F.col("row_id") % short_every == 0, short).otherwise(full) \
        if "row_id" in states.columns else full
    poll = (F.col("time_position") / poll_seconds).cast("long") * poll_seconds
    order = ["row_id"] if "row_id" in states.columns else ["icao24", "time_position", "last_contact"]
    rows = states.select(poll.alias("time"), F.struct(*order).alias("_o"), arr.alias("s"))
    rows = row_positions(rows, [F.col("_o"), F.col("s")], ["time"])
    return (rows.select("time", F.floor(F.col("position") / rows_per_payload).alias("_part"), "s")
            .groupBy("time", "_part")
            .agg(F.concat(F.lit('{"time":'), F.col("time").cast("string"), F.lit(',"states":['),
                          F.concat_ws(",", F.collect_list("s")), F.lit("]}")).alias("payload"))
            .select("time", "payload"))


def unpack_states(df: DataFrame, col: str = "payload") -> DataFrame:
    """SRC3: each payload's ``states`` array -> one typed record per entry.
    Positional arrays shorter than 18 leave the missing slots null; a
    payload without ``states`` (or with null) yields no rows."""
    parsed = df.select(F.from_json(F.col(col), "struct<time:bigint, states:array<array<string>>>")
                       .alias("_p"))
    rows = parsed.select(F.explode("_p.states").alias("_a"))
    dtypes = {f.name: f.dataType for f in STATE_SCHEMA.fields}
    out = []
    for i, c in enumerate(STATE_FIELDS):
        raw = F.get(F.col("_a"), i)
        dt = dtypes[c]
        if isinstance(dt, T.StringType):
            out.append(raw.alias(c))
        elif isinstance(dt, T.ArrayType):
            out.append(F.from_json(raw, dt).alias(c))
        else:
            out.append(raw.try_cast(dt).alias(c))
    return rows.select(*out)
