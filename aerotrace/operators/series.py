"""Keyed, time-ordered scans that stay parallel when one key is huge.

Forward/backward fill, lag/lead, trailing history and gap sessions are all
"look at the neighbours of a row within its key, in time order".  The
textbook form is a window ``PARTITION BY key ORDER BY time`` -- one task per
key, so a key holding a third of all rows becomes a single straggler.

Here every key is cut into time chunks (``floor(epoch / chunk_seconds)``;
the chunk is monotone in the order, so all rows of an earlier chunk precede
all rows of a later one).  The work then runs in two short steps:

1. *summary*: one row per (key, chunk) -- last/first non-null values, the
   chunk's boundary rows or its tail -- produced by partial (map-side)
   aggregation; a window over these few rows per key yields, for each
   chunk, what flows in from earlier (or later) chunks.
2. *local pass*: those carried values are added as one or two extra
   "carry" rows at the edge of their chunk and the real rows are scanned
   with ordinary running-frame windows ``PARTITION BY key, chunk``;
   the carry rows are filtered out afterwards.

Rows are never dropped or capped; the result equals the unchunked window.
The chunk width bounds a window partition by (report rate x width): with the
default of one day, an aircraft reporting at 1 Hz after dedup puts at most
86,400 rows into one window partition, however many days it spans.  Much
narrower chunks make the summary as large as the data on sparse series
(measured: 1-hour chunks cost 1.7x the 1-day chunks on the test tables).
With ``whole_rows`` only keys of more rows than that are cut; the others are
one chunk each, need no summary and no carry rows, and where no key is longer
the scan is one exchange of the rows, into partitions of about ``TASK_ROWS``
rows: however large the table, a task sorts no more than it can hold.  Rows
that ``spread`` has placed by key already are scanned where they lie, with a
series marked ``placed``.

A (key, day) that is hot anyway -- a burst, a replayed feed, a key holding
a third of the table -- is split further by row count: a map-side-combined
count per (key, chunk) finds the chunks above ``max_chunk_rows`` and each is
cut into finer pieces, round by round, until every chunk fits or is one
microsecond wide.  Chunk ids are chunk starts in epoch microseconds, so
chunks of different widths interleave in time order.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerotrace.functions.exprs import epoch_micros_ntz
from aerotrace.session import stage_table

CHUNK = "_chunk"
WHOLE = -(1 << 63)  # chunk id of a key that is not cut
POS = "_pos"  # -1 carry-in from the past, 0 real row, +1 carry-in from the future


TASK_ROWS = 100_000  # rows that one task sorts, about, where no key is cut
FINER = 64  # least number of pieces of a hot chunk, so a day is cut to microseconds in 6 rounds


@dataclass(frozen=True)
class Series:
    """How rows of one time series are keyed and ordered."""

    key: tuple[str, ...]
    time: str
    tiebreak: tuple[str, ...] = field(default_factory=tuple)
    chunk_seconds: int = 86400
    max_chunk_rows: int | None = 2_000_000
    broadcast_chunks: int = 100_000
    whole_rows: int | None = None
    placed: bool = False  # no key is cut and the rows lie by key

    @staticmethod
    def of(key, time, tiebreak=(), chunk_seconds=86400, max_chunk_rows=2_000_000,
           broadcast_chunks=100_000, whole_rows=None) -> "Series":
        key = (key,) if isinstance(key, str) else tuple(key)
        tiebreak = (tiebreak,) if isinstance(tiebreak, str) else tuple(tiebreak)
        return Series(key, time, tiebreak, chunk_seconds, max_chunk_rows, broadcast_chunks, whole_rows)

    def rekey(self, key) -> "Series":
        return replace(self, key=(key,) if isinstance(key, str) else tuple(key))

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tiebreak]

    @property
    def chunk_keys(self) -> list[str]:
        return [*self.key, CHUNK]

    def micros_expr(self, df: DataFrame) -> Column:
        dtype = df.schema[self.time].dataType
        if isinstance(dtype, T.TimestampNTZType):
            return epoch_micros_ntz(self.time)
        if isinstance(dtype, T.TimestampType):
            return F.unix_micros(F.col(self.time))
        return (F.col(self.time) * F.lit(1_000_000)).cast("long")  # numeric epoch seconds

    def chunk_expr(self, df: DataFrame) -> Column:
        """Start (epoch microseconds) of the row's ``chunk_seconds`` chunk."""
        width = self.chunk_seconds * 1_000_000
        return F.floor(self.micros_expr(df) / F.lit(width)).cast("long") * F.lit(width)

    def counts(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.key).agg(F.count(F.lit(1)).alias("_n"))

    def uncut_rows(self, counts: DataFrame) -> int | None:
        """The number of rows, or None where a key has more than ``whole_rows``."""
        most, rows = counts.agg(F.max("_n"), F.sum("_n")).first()
        return (rows or 0) if (most or 0) <= self.whole_rows else None

    def spread(self, df: DataFrame, rows: int) -> DataFrame:
        """``df`` partitioned by key, ``TASK_ROWS`` rows to a partition, about;
        tables too small for that many tasks are left to the session's number."""
        n = -(-rows // TASK_ROWS)
        keys = [F.col(k) for k in self.key]
        return df.repartition(n, *keys) if n > df.sparkSession.sparkContext.defaultParallelism else df.repartition(*keys)

    def with_chunk(self, df: DataFrame, spread: bool = True) -> DataFrame:
        """``df`` plus the chunk id column, hot chunks split by row count.

        Each refinement round counts rows per (key, chunk) (partial
        aggregation; one small row per chunk) and re-cuts the chunks above
        ``max_chunk_rows`` into ``ceil(2 * rows / max)`` pieces, 64 at least;
        later rounds catch bursts inside a piece, until every chunk fits or is
        one microsecond wide.  A round ends with one number, the largest count;
        only where it is too large the table of hot chunks is staged under the shared checkpoint folder; it is broadcast
        up to ``broadcast_chunks`` rows and joined by shuffle beyond.
        Keys of up to ``whole_rows`` rows, if given, stay one chunk (``WHOLE``);
        where all do, the rows are ``spread`` by key unless told otherwise.
        A frame that already has the column (chained scans) is returned as
        is, so one assignment serves every scan of the chain."""
        if CHUNK in df.columns:
            return df
        if self.placed:
            return df.withColumn(CHUNK, F.lit(WHOLE).cast("long"))
        micros = self.micros_expr(df)
        d = df.withColumns({CHUNK: self.chunk_expr(df),
                            "_cw": F.lit(self.chunk_seconds * 1_000_000).cast("long")})
        if self.whole_rows:
            counts = self.counts(df)
            rows = self.uncut_rows(counts)
            if rows is not None:
                return (self.spread(df, rows) if spread else df).withColumn(CHUNK, F.lit(WHOLE).cast("long"))
            lk = [f"_lk{i}" for i in range(len(self.key))]
            long = stage_table(counts.where(F.col("_n") > self.whole_rows)
                               .selectExpr(*[f"{q(k)} AS {h}" for k, h in zip(self.key, lk)], "true AS _long"), "long-keys")
            on = [d[k].eqNullSafe(long[h]) for k, h in zip(self.key, lk)]
            small = long.count() <= self.broadcast_chunks
            d = (d.join(F.broadcast(long) if small else long, on, "left")
                 .withColumns({CHUNK: F.when(F.col("_long"), F.col(CHUNK)).otherwise(F.lit(WHOLE).cast("long")),
                               "_cw": F.when(F.col("_long"), F.col("_cw")).otherwise(F.lit(1).cast("long"))})
                 .drop(*lk, "_long"))
        if self.max_chunk_rows:
            hk = [f"_hk{i}" for i in range(len(self.chunk_keys))]
            while True:
                sizes = (d.groupBy(*self.chunk_keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_cw").alias("_w"))
                         .where((F.col("_w") > 1) & F.col(CHUNK).isNotNull()))
                if (sizes.agg(F.max("_n")).first()[0] or 0) <= self.max_chunk_rows:
                    break
                hot = stage_table(
                    sizes.where(F.col("_n") > F.lit(self.max_chunk_rows))
                    .selectExpr(*[f"{q(k)} AS {h}" for k, h in zip(self.chunk_keys, hk)],
                                f"greatest(1L, floor(_w / greatest({FINER}L, ceil(_n * 2 / {int(self.max_chunk_rows)})))) AS _hw"),
                    "hot-chunks")
                n_hot = hot.count()
                small = n_hot <= self.broadcast_chunks
                on = [d[k].eqNullSafe(hot[h]) for k, h in zip(self.chunk_keys, hk)]
                fine = F.col(CHUNK) + F.floor((micros - F.col(CHUNK)) / F.col("_hw")).cast("long") * F.col("_hw")
                refined = F.col("_hw").isNotNull()
                d = (d.join(F.broadcast(hot) if small else hot, on, "left")
                     .withColumns({CHUNK: F.when(refined, fine).otherwise(F.col(CHUNK)),
                                   "_cw": F.when(refined, F.col("_hw")).otherwise(F.col("_cw"))})
                     .drop(*hk, "_hw"))
        return d.drop("_cw")

    def cut_rows(self, d: DataFrame) -> DataFrame:
        """The rows of keys that are cut into chunks; only these need carries."""
        return d.where(~F.col(CHUNK).eqNullSafe(F.lit(WHOLE).cast("long")))

    # window over the real rows of one chunk, carry-in rows at the edges
    def forward_window(self):
        return (Window.partitionBy(*self.chunk_keys)
                .orderBy(F.col(POS).asc(), *[F.col(c).asc() for c in self.order]))

    def backward_window(self):
        return (Window.partitionBy(*self.chunk_keys)
                .orderBy(F.col(POS).desc(), *[F.col(c).desc() for c in self.order]))

    def summary_window(self, descending: bool = False):
        o = F.col(CHUNK).desc() if descending else F.col(CHUNK).asc()
        return Window.partitionBy(*self.key).orderBy(o)


RUNNING = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)


def _ordered_struct(s: Series, cols: list[str], value: Column | None = None) -> Column:
    fields = [F.col(o).alias(f"_o{i}") for i, o in enumerate(s.order)]
    if value is not None:
        return F.struct(*fields, value.alias("v"))
    return F.struct(*fields, *[F.col(c) for c in cols])


def _finish(df: DataFrame, scanned: DataFrame, new_cols: list[str]) -> DataFrame:
    return scanned.where(f"{q(POS)} = 0").select(*df.columns, *new_cols)


def q(c: str) -> str:
    return f"`{c}`"


def _ordered_sql(s: Series, cols: list[str], value: str | None = None) -> str:
    fields = [f"'_o{i}', {q(o)}" for i, o in enumerate(s.order)]
    fields += [f"'v', {value}"] if value is not None else [f"'{c}', {q(c)}" for c in cols]
    return f"named_struct({', '.join(fields)})"


def _win(keys: list[str], order: str, frame: str = "") -> str:
    return f"(PARTITION BY {', '.join(q(k) for k in keys)} ORDER BY {order}{frame})"


RUNNING_SQL = " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE_SQL = " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

# Expressions below are SQL text (one JVM call each) rather than chains of
# Column calls: same plan, far less driver-side plan-building time for the
# wide fills used by the backfill step.


def fill(df: DataFrame, s: Series, forward: list[str] = (), backward: list[str] = (),
         prefix_forward: str = "ffill_", prefix_backward: str = "bfill_") -> DataFrame:
    """Add ``ffill_<c>`` (last non-null at or before the row) and
    ``bfill_<c>`` (first non-null at or after the row) within each key."""
    forward, backward = list(forward), list(backward)
    new_cols = ([f"{prefix_forward}{c}" for c in forward]
                + [f"{prefix_backward}{c}" for c in backward])

    def scans(rows, keys, edge):
        fw = _win(keys, ", ".join([f"{q(c)} ASC" for c in [*edge, *s.order]]), RUNNING_SQL)
        bw = _win(keys, ", ".join([f"{q(c)} DESC" for c in [*edge, *s.order]]), RUNNING_SQL)
        return rows.selectExpr(
            "*",
            *[f"last({q(c)}, true) OVER {fw} AS {q(prefix_forward + c)}" for c in forward],
            *[f"last({q(c)}, true) OVER {bw} AS {q(prefix_backward + c)}" for c in backward],
        )
    if s.placed:
        return scans(df, s.key, [])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    d = s.with_chunk(df)
    aggs = [F.expr(f"max(CASE WHEN {q(c)} IS NOT NULL THEN {_ordered_sql(s, [], q(c))} END) "
                   f"AS {q('_f_' + c)}") for c in forward]
    aggs += [F.expr(f"min(CASE WHEN {q(c)} IS NOT NULL THEN {_ordered_sql(s, [], q(c))} END) "
                    f"AS {q('_b_' + c)}") for c in backward]
    summary = s.cut_rows(d).groupBy(*s.chunk_keys).agg(*aggs)
    # carried-in values: last non-null of earlier chunks / first of later ones
    wf = _win(list(s.key), f"{q(CHUNK)} ASC", BEFORE_SQL)
    wb = _win(list(s.key), f"{q(CHUNK)} DESC", BEFORE_SQL)
    carried = summary.selectExpr(
        *[q(k) for k in s.chunk_keys],
        *[f"last({q('_f_' + c)}.v, true) OVER {wf} AS {q('_f_' + c)}" for c in forward],
        *[f"last({q('_b_' + c)}.v, true) OVER {wb} AS {q('_b_' + c)}" for c in backward],
    )
    # One carry-in row from the past (pos -1) and one from the future (pos +1)
    # per chunk, generated from the same summary row.
    names = list(dict.fromkeys(forward + backward))

    def edge(pos, prefix, cols):
        vals = [f"'{c}', " + (q(prefix + c) if c in cols else f"CAST(NULL AS {types[c]})") for c in names]
        return f"named_struct('{POS}', {pos}, {', '.join(vals)})"
    edges = ([edge(-1, "_f_", forward)] if forward else []) + ([edge(1, "_b_", backward)] if backward else [])
    # explode, not inline: the optimizer drops it where no key is cut
    carry_rows = (carried.selectExpr(*[q(k) for k in s.chunk_keys], f"explode(array({', '.join(edges)})) AS _edge")
                  .select(*s.chunk_keys, "_edge.*"))
    u = d.withColumn(POS, F.lit(0)).unionByName(carry_rows, allowMissingColumns=True)
    return _finish(df, scans(u, s.chunk_keys, [POS]), new_cols)


def forward_fill(df: DataFrame, s: Series, cols: list[str]) -> DataFrame:
    """Replace nulls in ``cols`` by the last earlier non-null of the same key."""
    out = fill(df, s, forward=cols)
    return out.select(*[F.col(f"ffill_{c}").alias(c) if c in cols else F.col(c)
                        for c in df.columns])


def neighbor_fill(df: DataFrame, s: Series, cols: list[str]) -> DataFrame:
    """value, else previous non-null, else next non-null (within the key)."""
    out = fill(df, s, forward=cols, backward=cols)
    return out.select(*[F.coalesce(F.col(c), F.col(f"ffill_{c}"), F.col(f"bfill_{c}")).alias(c)
                        if c in cols else F.col(c) for c in df.columns])


def shift(df: DataFrame, s: Series, lags: dict[str, str] | None = None,
          leads: dict[str, str] | None = None) -> DataFrame:
    """Add lag-1 / lead-1 columns: ``lags={"prev_lat": "lat"}``.

    Values of the previous/next row of the same key (null at the ends),
    even across chunk boundaries.
    """
    lags, leads = dict(lags or {}), dict(leads or {})
    src = sorted(set(lags.values()) | set(leads.values()))
    d = s.with_chunk(df)
    summary = s.cut_rows(d).groupBy(*s.chunk_keys).agg(F.expr(f"max({_ordered_sql(s, src)}) AS _last"),
                                                       F.expr(f"min({_ordered_sql(s, src)}) AS _first"))
    w = _win(list(s.key), f"{q(CHUNK)} ASC")
    carried = summary.selectExpr(*[q(k) for k in s.chunk_keys],
                                 f"lag(_last) OVER {w} AS _prev", f"lead(_first) OVER {w} AS _next")
    u = d.withColumn(POS, F.lit(0))
    keys = [q(k) for k in s.chunk_keys]
    if lags:
        u = u.unionByName(carried.where("_prev IS NOT NULL").selectExpr(
            *keys, f"-1 AS {POS}", *[f"_prev.{q(c)} AS {q(c)}" for c in src]), allowMissingColumns=True)
    if leads:
        u = u.unionByName(carried.where("_next IS NOT NULL").selectExpr(
            *keys, f"1 AS {POS}", *[f"_next.{q(c)} AS {q(c)}" for c in src]), allowMissingColumns=True)
    w_local = _win(s.chunk_keys, ", ".join([f"{q(POS)} ASC"] + [f"{q(c)} ASC" for c in s.order]))
    scanned = u.selectExpr(
        "*",
        *[f"lag({q(c)}, 1) OVER {w_local} AS {q(name)}" for name, c in lags.items()],
        *[f"lead({q(c)}, 1) OVER {w_local} AS {q(name)}" for name, c in leads.items()],
    )
    return _finish(df, scanned, [*lags, *leads])


def tail_history(df: DataFrame, s: Series, fields: list[str], size: int,
                 out: str = "history") -> DataFrame:
    """Add ``out`` = array of the previous ``size`` rows (structs of ``fields``)
    of the same key, oldest first; shorter near the start of a key."""
    d = s.with_chunk(df)
    # Pass 1: the last `size` rows of every chunk (bounded per chunk).
    rn = F.row_number().over(Window.partitionBy(*s.chunk_keys)
                             .orderBy(*[F.col(c).desc() for c in s.order]))
    tails = (s.cut_rows(d).select(*s.chunk_keys, *s.order, *fields, rn.alias("_rn"))
             .filter(F.col("_rn") <= size)
             .groupBy(*s.chunk_keys)
             .agg(F.array_sort(F.collect_list(_ordered_struct(s, fields))).alias("_tail")))
    # Each non-empty chunk adds >= 1 row, so the previous `size` chunks hold
    # at least `size` rows: enough to fill any history.
    w = s.summary_window().rowsBetween(-size, -1)
    joined = F.flatten(F.collect_list("_tail").over(w))
    carried = (tails.select(*s.chunk_keys, joined.alias("_all"))
               .filter(F.size("_all") > 0)
               .select(*s.chunk_keys, F.lit(-1).alias(POS),
                       F.transform(_last_n(F.col("_all"), size),
                                   lambda x: F.struct(*[x[c].alias(c) for c in fields]))
                       .alias("_carry")))
    u = d.withColumn(POS, F.lit(0)).unionByName(carried, allowMissingColumns=True)
    w_local = s.forward_window()
    local = F.collect_list(F.when(F.col(POS) == 0, F.struct(*[F.col(c) for c in fields]))) \
        .over(w_local.rowsBetween(-size, -1))
    carry = F.first("_carry", ignorenulls=True).over(w_local.rowsBetween(*RUNNING))
    empty = F.array().cast(_arr_type(df, fields))
    hist = _last_n(F.concat(F.coalesce(carry, empty), local), size)
    scanned = u.select("*", hist.alias(out))
    return _finish(df, scanned, [out])


def _arr_type(df: DataFrame, fields: list[str]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(c, df.schema[c].dataType) for c in fields]))


def _last_n(arr: Column, n: int) -> Column:
    return F.when(F.size(arr) > n, F.slice(arr, F.size(arr) - n + 1, n)).otherwise(arr)


def gap_sessions(df: DataFrame, s: Series, gap_seconds: float, out: str = "session_start") -> DataFrame:
    """Add ``out`` = start time of the run of rows whose consecutive time gaps
    are <= ``gap_seconds`` (per key).  A new run starts at the first row of a
    key or after a larger gap."""
    t = s.time
    shifted = shift(s.with_chunk(df), s, lags={"_prev_t": t})
    dtype = df.schema[t].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        gap = (epoch_us(shifted, t) - epoch_us(shifted, "_prev_t")) / F.lit(1e6)
    else:
        gap = F.col(t) - F.col("_prev_t")
    flagged = shifted.withColumn(
        "_start", F.when(F.col("_prev_t").isNull() | (gap > F.lit(gap_seconds)), F.col(t)))
    filled = fill(flagged, s, forward=["_start"])
    return filled.select(*df.columns, F.col("ffill__start").alias(out))


def epoch_us(df: DataFrame, c: str) -> Column:
    dtype = df.schema[c].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return epoch_micros_ntz(c)
    return F.unix_micros(F.col(c))
