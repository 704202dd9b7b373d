"""Joins and frames over time: as-of join, interval-overlap join, trailing
aggregates over a time range.

All three keep tasks bounded when one key holds a third of the rows: as-of
matches and trailing sums are running scans over time chunks
(``operators/series.py``), overlaps are equi-joins on (key, level, bin).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerotrace.functions.exprs import epoch_micros_ntz
from aerotrace.operators.series import BEFORE_SQL, CHUNK, POS, Series, _win, fill, q


def micros(df: DataFrame, c: str) -> Column:
    """Epoch microseconds of a timestamp or numeric (seconds) column."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.TimestampNTZType):
        return epoch_micros_ntz(df[c])
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(df[c])
    return (df[c] * F.lit(1_000_000)).cast("long")


def _names(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def _packed(df: DataFrame) -> Column:
    return F.struct(*[df[c] for c in df.columns])


def asof_join(left: DataFrame, right: DataFrame, key, left_time: str, right_time: str,
              tolerance_seconds: float | None = None, tiebreak=(), direction: str = "backward", prefix: str = "",
              chunk_seconds: int = 86400, max_chunk_rows: int | None = 2_000_000) -> DataFrame:
    """Every row of ``left`` with the nearest row of ``right`` of the same key
    at or before its time (``direction="forward"``: at or after), if it is at
    most ``tolerance_seconds`` away; else nulls.  Right columns other than the
    key come after the left ones, named ``prefix`` + name.

    Both sides become one series of time chunks.  The last right row of a
    chunk is handed forward to the next chunks, so no window spans a key and a
    chunk is re-cut when both sides together hold too many rows.

    Of right rows at one time the one with the greatest ``tiebreak`` (forward:
    the smallest) is taken, then by a hash of the row.  Left rows with a null
    key or time stay, unmatched; right rows with one match nothing.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is backward or forward")
    keys, ties = _names(key), _names(tiebreak)
    taken = [c for c in right.columns if c not in keys]
    clash = {prefix + c for c in taken} & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}; give a prefix")
    back = direction == "backward"
    kinds = [right.schema[c].dataType.simpleString() for c in ties]
    whole = F.col(left_time).isNotNull()

    def side(df, time, order, own, other, other_kind, tie):
        return df.select(*[F.col(q(k)).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(q(time)).alias("_t"), F.lit(order).alias("_side"),
                         *tie, _packed(df).alias(own), F.lit(None).cast(other_kind).alias(other))

    none = [F.lit(None).cast(k).alias(f"_tie{i}") for i, k in enumerate(kinds)] + [F.lit(None).cast("long").alias("_hash")]
    ranked = [F.col(q(c)).alias(f"_tie{i}") for i, c in enumerate(ties)] + [F.xxhash64(*[q(c) for c in right.columns]).alias("_hash")]
    known = right.where(" AND ".join(f"{q(c)} IS NOT NULL" for c in [*keys, right_time]))
    events = side(left.where(whole), left_time, 1 if back else 0, "_l", "_r", right.schema, none).unionByName(
        side(known, right_time, 0 if back else 1, "_r", "_l", left.schema, ranked))
    series = Series.of([f"_k{i}" for i in range(len(keys))], "_t", ["_side", *[f"_tie{i}" for i in range(len(ties))], "_hash"],
                       chunk_seconds, max_chunk_rows)
    scanned = fill(events, series, **{"forward" if back else "backward": ["_r"]})
    found = F.col("ffill__r" if back else "bfill__r")
    rows = scanned.where("_l IS NOT NULL").select("_l", "_t", found.alias("_r"))
    if tolerance_seconds is not None:
        rows = rows.withColumn("_rt", F.col(f"_r.{q(right_time)}"))
        near = F.abs(micros(rows, "_t") - micros(rows, "_rt")) <= F.lit(int(tolerance_seconds * 1_000_000))
        rows = rows.withColumn("_r", F.when(near, F.col("_r")))
    without = left.where(~whole).select(_packed(left).alias("_l"), F.lit(None).cast(right.schema).alias("_r"))
    return rows.select("_l", "_r").unionByName(without).select(
        "_l.*", *[F.col(f"_r.{q(c)}").alias(prefix + c) for c in taken])


def interval_overlap_join(left: DataFrame, right: DataFrame, key, left_span: tuple[str, str], right_span: tuple[str, str],
                          bin_seconds: float = 3600, fan: int = 4) -> DataFrame:
    """All pairs of rows of one key whose closed time spans share an instant,
    each pair once: columns of ``left``, then those of ``right`` without the key.

    Bins come in levels, each ``fan`` times as wide as the one before.  A span
    belongs to the first level whose bins are at least as long, so it touches
    two bins at most, there and on every coarser level.  Two spans meet on the
    coarser of their levels, in the first bin they have in common.  A span
    goes to its own level and to the coarser levels that the other side has,
    so its number of rows does not grow with its length, and two spans that
    share a bin are of a length with it, so most candidates are results.

    Nulls in the key or a bound, and spans that end before they start, match
    nothing.  ``key`` may be empty.
    """
    keys = _names(key)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    first = int(bin_seconds * 1_000_000)
    widths = [first]
    while widths[-1] < 1 << 62:
        widths.append(min(widths[-1] * fan, 1 << 62))

    def spans(df, span, name):
        start, end = micros(df, span[0]), micros(df, span[1])
        rows = df.select(*[df[k].alias(f"_k{i}") for i, k in enumerate(keys)], start.alias(f"{name}s"), end.alias(f"{name}e"),
                         _packed(df).alias(name))
        length = F.col(f"{name}e") - F.col(f"{name}s")
        level = F.lit(len(widths) - 1)
        for i in reversed(range(len(widths) - 1)):
            level = F.when(length <= widths[i], F.lit(i)).otherwise(level)
        usable = F.col(f"{name}s") <= F.col(f"{name}e")
        for i in range(len(keys)):
            usable = usable & F.col(f"_k{i}").isNotNull()
        return rows.where(usable).withColumn(f"{name}level", level)

    a, b = spans(left, left_span, "_a"), spans(right, right_span, "_b")
    levels = {n: sorted(r[0] for r in x.select(f"{n}level").distinct().collect()) for n, x in (("_a", a), ("_b", b))}  # 33 at most

    def binned(rows, name, others):
        own = F.col(f"{name}level")
        wanted = F.array_union(F.array(own), F.filter(F.array(*[F.lit(i) for i in others]).cast("array<int>"), lambda i: i > own))
        rows = rows.withColumn("_level", F.explode(wanted))
        width = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("_level") + 1)
        low = F.expr(f"{name}s") - F.pmod(F.col(f"{name}s"), width)
        rows = rows.withColumn("_width", width).withColumn(f"{name}first", low)
        return rows.withColumn("_bin", F.explode(F.array_distinct(F.array(
            F.col(f"{name}first"), F.col(f"{name}e") - F.pmod(F.col(f"{name}e"), F.col("_width")))))).drop("_width")

    on = [*[f"_k{i}" for i in range(len(keys))], "_level", "_bin"]
    met = binned(a, "_a", levels["_b"]).join(binned(b, "_b", levels["_a"]), on)
    met = met.where("(_alevel = _level OR _blevel = _level) AND _as <= _be AND _bs <= _ae AND _bin = greatest(_afirst, _bfirst)")
    return met.select("_a.*", *[F.col(f"_b.{q(c)}").alias(c) for c in right.columns if c not in keys])


def trailing_range(df: DataFrame, s: Series, seconds: float, values: dict[str, str], count: str = "n_rows",
                   scale: int = 6) -> DataFrame:
    """``df`` plus, for every row, aggregates over the rows of its key in
    ``[time - seconds, time]``, rows of the same time included: ``count``, and
    for each ``name: column`` of ``values`` ``name_n`` (non-null values),
    ``name_sum`` and ``name_avg``.

    Every row adds its value at its time and takes it away again just after
    ``time + seconds``; a running sum over both, carried from chunk to chunk,
    is the sum over the range.  That is linear in the rows however many lie in
    one range.  Sums are taken in decimals of ``scale`` digits, so that what
    is added and taken away cancels exactly.

    Rows without a time get null aggregates; a null key is a key of its own.
    """
    t, wide = s.time, int(seconds * 1_000_000)
    kind = df.schema[t].dataType
    money = f"decimal(38,{scale})"
    amounts = {"_c": F.lit(1).cast("long")}
    for name, c in values.items():
        amounts |= {f"_n_{name}": F.col(q(c)).isNotNull().cast("long"),
                    f"_s_{name}": F.coalesce(F.col(q(c)).cast(f"decimal(28,{scale})"), F.lit(0)).cast(money)}
    timed = df.where(F.col(q(t)).isNotNull())
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        later = F.expr(f"timestampadd(MICROSECOND, {wide}, {q(t)})")
    else:
        later = F.col(q(t)) + F.lit(seconds)
    keyed = [F.col(q(k)) for k in s.key]
    arrive = timed.select(*keyed, F.col(q(t)), F.lit(0).alias("_side"), *[x.alias(n) for n, x in amounts.items()], _packed(timed).alias("_row"))
    leave = timed.select(*keyed, later.cast(kind).alias(t), F.lit(1).alias("_side"), *[(-x).cast(money if n.startswith("_s_") else "long").alias(n) for n, x in amounts.items()],
                         F.lit(None).cast(df.schema).alias("_row"))
    scan = Series.of(s.key, t, ["_side"], s.chunk_seconds, s.max_chunk_rows, s.broadcast_chunks)
    events = scan.with_chunk(arrive.unionByName(leave))
    totals = events.groupBy(*scan.chunk_keys).agg(*[F.sum(n).cast(money if n.startswith("_s_") else "long").alias(n) for n in amounts])
    ahead = _win(list(scan.key), f"{q(CHUNK)} ASC", BEFORE_SQL)
    carry = totals.selectExpr(*[q(k) for k in scan.chunk_keys], f"-1 AS {POS}", *[f"sum({q(n)}) OVER {ahead} AS {q(n)}" for n in amounts])
    carry = carry.select(*scan.chunk_keys, POS, *[F.col(n).cast(events.schema[n].dataType).alias(n) for n in amounts]).where("_c IS NOT NULL")
    rows = events.withColumn(POS, F.lit(0)).unionByName(carry, allowMissingColumns=True)
    running = _win(scan.chunk_keys, f"{q(POS)}, {q(t)}, _side", " RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    rows = rows.selectExpr("_row", "_side", POS, *[f"sum({q(n)}) OVER {running} AS {q(n)}" for n in amounts])
    out = [F.col("_c").alias(count)]
    for name in values:
        n, total = F.col(f"_n_{name}"), F.col(f"_s_{name}").cast("double")
        out += [n.alias(f"{name}_n"), F.when(n > 0, total).alias(f"{name}_sum"), F.when(n > 0, total / n).alias(f"{name}_avg")]
    done = rows.where(f"{POS} = 0 AND _side = 0").select("_row.*", *out)
    untimed = df.where(F.col(q(t)).isNull())
    return done.unionByName(untimed.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in done.schema[len(df.columns):]]))
