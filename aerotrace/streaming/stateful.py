"""Stateful streaming per aircraft: forward fill and gap episodes over rows
that arrive in any order.

Rows wait in the key's list state until the watermark has passed their time;
then no earlier row can come any more, and they are taken in time order.  The
value state holds what the next row needs from all before it: the last known
values, the last time and the start of the running episode.  A key that stays
silent for ``idle`` after its last row gives its state back by a timer, so
state is bounded by the rows of the delay and the aircraft of the idle time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from aerotrace.functions.exprs import ntz_from_micros
from aerotrace.streaming.streams import EVENT_INSTANT, with_instant

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FillAndEpisodes(StatefulProcessor):
    """Rows (``at_micros``, ``tie_value``, values) of one key, in time order
    once the watermark has passed, with ``filled_*`` and the episode's start."""

    def __init__(self, values: list[str], types: list[str], gap_micros: int, idle_ms: int):
        self.values, self.types, self.gap, self.idle_ms = values, types, gap_micros, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        cells = ", ".join(f"`{c}` {t}" for c, t in zip(self.values, self.types))
        self.pending = handle.getListState("pending", f"at_micros long, tie_value long, {cells}")
        self.last = handle.getValueState("last", f"at_micros long, start_micros long, {cells}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for frame in rows:
            cells = frame[["at_micros", "tie_value", *self.values]].astype(object).where(lambda x: x.notna(), None)
            new += list(cells.itertuples(index=False, name=None))
        if new:
            self.pending.appendList(new)
            for ms in sorted({-(-int(r[0]) // 1000) for r in new}):  # timers are whole milliseconds, rounded up
                self.handle.registerTimer(ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = expiredTimerInfo.getExpiryTimeInMs() * 1000
        rows = list(self.pending.get()) if self.pending.exists() else []
        ready = sorted((r for r in rows if r[0] <= passed), key=lambda r: (r[0], r[1]))
        if not ready:
            held = self.last.get() if self.last.exists() else None
            if held is not None and not rows and held[0] // 1000 + self.idle_ms <= passed // 1000:
                self.last.clear()
            return
        late = [r for r in rows if r[0] > passed]
        if late:
            self.pending.put(late)
        else:
            self.pending.clear()
        held = self.last.get() if self.last.exists() else (None, None, *[None] * len(self.values))
        before, start, known = held[0], held[1], list(held[2:])
        out = []
        for t, tie, *cells in ready:
            if before is None or t - before > self.gap:
                start = t
            before = t
            known = [k if c is None else c for c, k in zip(cells, known)]
            out.append((*key, t, tie, *cells, *known, start))
        self.last.update((before, start, *known))
        self.handle.registerTimer(-(-before // 1000) + self.idle_ms)
        yield pd.DataFrame(out, columns=["series_key", "at_micros", "tie_value", *self.values, *[f"filled_{c}" for c in self.values], "start_micros"])

    def close(self) -> None:
        pass


def fill_and_episodes_stream(df: DataFrame, values: list[str], key: str = "icao", time_col: str = "event_timestamp",
                             tiebreak: str = "row_id", gap_seconds: float = 300.0, delay: str = "10 minutes",
                             idle_seconds: float = 86400.0) -> DataFrame:
    """Streaming form of the forward fill (``filled_<c>``: the last non-null at
    or before the row) and of ``gap_sessions`` (``episode_start``), per key.

    Rows come out once the watermark (``delay`` behind the latest time) has
    passed them; rows later than that are dropped, as by every watermark.
    After ``idle_seconds`` without a row a key starts anew: choose it longer
    than the gaps a value is to be carried over.  Needs the RocksDB state
    store (``use_rocksdb``).
    """
    taken = {"series_key", "at_micros", "tie_value", "start_micros"} & set(values)
    if taken:  # Python workers rename columns that begin with an underscore, so these have plain names
        raise ValueError(f"columns named as the operator's own: {sorted(taken)}")
    types = [df.schema[c].dataType.simpleString() for c in values]
    rows = with_instant(df, time_col).withWatermark(EVENT_INSTANT, delay).select(
        F.col(key).alias("series_key"), EVENT_INSTANT, F.unix_micros(EVENT_INSTANT).alias("at_micros"), F.col(tiebreak).cast("long").alias("tie_value"), *values)
    schema = T.StructType([T.StructField("series_key", df.schema[key].dataType), T.StructField("at_micros", T.LongType()), T.StructField("tie_value", T.LongType()),
                           *[T.StructField(c, df.schema[c].dataType) for c in values],
                           *[T.StructField(f"filled_{c}", df.schema[c].dataType) for c in values], T.StructField("start_micros", T.LongType())])
    out = rows.groupBy("series_key").transformWithStateInPandas(
        FillAndEpisodes(values, types, int(gap_seconds * 1e6), int(idle_seconds * 1000)), schema, "Append", "EventTime")
    return out.select(F.col("series_key").alias(key), ntz_from_micros("at_micros").alias(time_col), F.col("tie_value").alias(tiebreak), *values,
                      *[f"filled_{c}" for c in values], ntz_from_micros("start_micros").alias("episode_start"))


def use_rocksdb(spark: SparkSession) -> None:
    """State store that stateful processors need; set before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


