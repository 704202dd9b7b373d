"""Null backfill -- silver step 1 (BF1-BF11).

All fills run per aircraft in time order through the chunked scans of
:mod:`aerotrace.operators.series`, so one pass (one shuffle) computes every
forward and backward fill and no aircraft is processed by a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerotrace.functions import constants as K
from aerotrace.operators import series
from aerotrace.operators.series import Series

FORWARD_ONLY = (K.STABLE_IDENTITY_FIELDS + ["flight"] + K.SEMI_STABLE_FIELDS
                + ["roll", "alt_baro"])


def default_series(tiebreak=("row_id",), chunk_seconds: int = 86400) -> Series:
    return Series.of("icao", "event_timestamp", tiebreak, chunk_seconds, whole_rows=K.WHOLE_SERIES_ROWS)


def backfill(df: DataFrame, s: Series | None = None) -> DataFrame:
    """BF1-BF8 composed (the code behaviour: unbounded fills per aircraft).

    * identity, callsign, semi-stable fields, ROLL, ALT_BARO: forward fill
    * continuous fields: value, else previous non-null, else next non-null
    * categorical defaults, booleans -> false, TRACE_FLAGS -> 0
    """
    s = s or default_series(tiebreak=[c for c in ("row_id",) if c in df.columns])
    forward = [c for c in dict.fromkeys(FORWARD_ONLY + K.CONTINUOUS_FIELDS)]
    filled = series.fill(df, s, forward=forward, backward=K.CONTINUOUS_FIELDS)
    q = series.q
    out = []
    for c in df.columns:
        if c in K.CONTINUOUS_FIELDS:
            v = f"coalesce({q(c)}, {q('ffill_' + c)}, {q('bfill_' + c)})"
        elif c in forward:
            v = q("ffill_" + c)
        else:
            v = q(c)
        if c in K.CATEGORICAL_DEFAULTS:
            v = f"coalesce({v}, '{K.CATEGORICAL_DEFAULTS[c]}')"
        elif c in K.BOOLEAN_FLAGS:
            v = f"coalesce({v}, false)"
        elif c == "trace_flags":
            v = f"coalesce({v}, 0)"
        out.append(f"{v} AS {q(c)}")
    return filled.selectExpr(*out)


def ffill_bounded(df: DataFrame, cols: dict[str, float], s: Series | None = None) -> DataFrame:
    """BF9 (documented variant): fill a null only from an observation at most
    ``cols[c]`` seconds older than the row (e.g. 300 s semi-stable, 5 s ROLL)."""
    s = s or default_series(tiebreak=[c for c in ("row_id",) if c in df.columns])
    t = s.time
    stamped = df.select("*", *[F.when(F.col(c).isNotNull(), F.col(t)).alias(f"_t_{c}")
                               for c in cols])
    filled = series.fill(stamped, s, forward=[*cols, *[f"_t_{c}" for c in cols]])
    out = []
    for c in df.columns:
        if c in cols:
            age = (series.epoch_us(filled, t) - series.epoch_us(filled, f"ffill__t_{c}")) / F.lit(1e6)
            out.append(F.coalesce(F.col(c), F.when(age <= F.lit(cols[c]), F.col(f"ffill_{c}")))
                       .alias(c))
        else:
            out.append(F.col(c))
    return filled.select(*out)


def interpolate_short_gap(df: DataFrame, cols: dict[str, float], s: Series | None = None) -> DataFrame:
    """BF10 (documented variant): linear interpolation in time between the
    previous and next non-null observation when they are at most
    ``cols[c]`` seconds apart."""
    s = s or default_series(tiebreak=[c for c in ("row_id",) if c in df.columns])
    t = s.time
    stamped = df.select("*", *[F.when(F.col(c).isNotNull(), F.col(t)).alias(f"_t_{c}")
                               for c in cols])
    both = [*cols, *[f"_t_{c}" for c in cols]]
    filled = series.fill(stamped, s, forward=both, backward=both)
    now = series.epoch_us(filled, t)
    out = []
    for c in df.columns:
        if c in cols:
            t0 = series.epoch_us(filled, f"ffill__t_{c}")
            t1 = series.epoch_us(filled, f"bfill__t_{c}")
            v0, v1 = F.col(f"ffill_{c}"), F.col(f"bfill_{c}")
            frac = F.when(t1 > t0, (now - t0) / (t1 - t0)).otherwise(F.lit(0.0))
            interp = F.when((t1 - t0) / F.lit(1e6) <= F.lit(cols[c]), v0 + (v1 - v0) * frac)
            out.append(F.coalesce(F.col(c), interp).alias(c))
        else:
            out.append(F.col(c))
    return filled.select(*out)


def gap_session(df: DataFrame, gap_seconds: float, s: Series | None = None) -> DataFrame:
    """``df`` plus ``session_start``: the first time of the run of reports
    without a gap of more than ``gap_seconds`` that the row belongs to."""
    s = s or default_series(tiebreak=[c for c in ("row_id",) if c in df.columns])
    return series.gap_sessions(df, s, gap_seconds)


def ffill_in_session(df: DataFrame, cols: list[str], session_col: str,
                     s: Series | None = None) -> DataFrame:
    """BF11 (documented variant): forward fill within a detected session."""
    s = s or default_series(tiebreak=[c for c in ("row_id",) if c in df.columns])
    s2 = s.rekey([*s.key, session_col])
    return series.forward_fill(df, s2, cols)
