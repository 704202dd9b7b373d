"""Column-expression helpers.

All helpers return ``Column`` objects built from built-in functions, so
they stay inside whole-stage codegen and never cross into Python.
"""

from __future__ import annotations

import json
import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerotrace.functions import constants as K

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_lookup(mapping: dict, key: str | Column, default: str | None = None) -> Column:
    """Literal map lookup; a miss or a null key gives ``default``.

    ``create_map`` of literals is constant-folded once per task; the lookup
    is a hash probe inside generated code.
    """
    m = F.create_map(*[F.lit(x) for x in chain(*mapping.items())])
    looked = m[col(key)]
    return looked if default is None else F.coalesce(looked, F.lit(default))


def read_map(path: str) -> dict[str, str]:
    """A code map kept as configuration: ``code: label`` lines (quotes and
    ``#`` comments as in simple YAML) or a JSON object, for ``map_lookup`` and
    the label functions' ``mapping``.  Read on the driver, a few rows."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if text.lstrip().startswith("{"):
        return {str(k): str(v) for k, v in json.loads(text).items()}
    out = {}
    for number, line in enumerate(text.splitlines(), 1):
        found = re.fullmatch(r"""\s*(?:(["']?)([^"'#:]+?)\1\s*:\s*(?:"([^"]*)"|'([^']*)'|([^#"']*?)))?\s*(?:#.*)?""", line)
        if found is None:
            raise ValueError(f"{path}:{number}: not a 'code: label' line")
        if found[2] is not None:
            out[found[2]] = next(x for x in found.groups()[2:] if x is not None)
    return out


def null_if_blank(c: str | Column) -> Column:
    """The trimmed text, null when nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def valid_range(c: str | Column, lo, hi) -> Column:
    """The value inside [lo, hi], else null."""
    return F.when(col(c).between(lo, hi), col(c))


def epoch_ntz() -> Column:
    return F.expr(EPOCH_NTZ)


def epoch_seconds_ntz(ts: str | Column) -> Column:
    """Whole epoch seconds (floored) of a TIMESTAMP_NTZ; time-zone independent."""
    return F.timestamp_diff("SECOND", epoch_ntz(), col(ts))


def epoch_micros_ntz(ts: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), col(ts))


def ntz_from_micros(micros: str | Column) -> Column:
    return F.timestamp_add("MICROSECOND", col(micros), epoch_ntz())


def surrogate_key(*cols: str | Column) -> Column:
    """Deterministic, null-safe, non-negative BIGINT key.

    First 15 hex digits (60 bits) of ``identity_key``, read as a number: for
    dimension keys, of which there are few.
    """
    return F.conv(F.substring(identity_key(*cols), 1, 15), 16, 10).cast("bigint")


def identity_key(*cols: str | Column) -> Column:
    """128-bit key (md5 hex) of several values, for keys of single rows.

    Each value is written with its length in front and a null as ``n``, so no
    two different lists of values have the same text, whatever characters they
    hold; md5 is portable, so keys are stable across jobs and engines.
    """
    def part(c):
        text = col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))
    return F.md5(F.concat(*[part(c) for c in cols]))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance by the haversine formula, with
    hav(x) = (1 - cos x) / 2 = sin(x / 2)^2; any null input gives null."""
    def hav(degrees_from, degrees_to):
        return F.pow(F.sin(F.radians(col(degrees_to) - col(degrees_from)) / 2), 2)
    lat_scale = F.cos(F.radians(col(lat1))) * F.cos(F.radians(col(lat2)))
    central = hav(lat1, lat2) + lat_scale * hav(lon1, lon2)
    # rounding can lift the value above 1, where asin is undefined
    return 2 * K.EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(central, F.lit(1.0))))


def hex_to_long(c: str | Column) -> Column:
    """24-bit ICAO hex address -> BIGINT; anything that is not 6 hex digits -> NULL."""
    v = col(c)
    return F.when(v.rlike("^[0-9A-Fa-f]{6}$"), F.conv(v, 16, 10).cast("bigint"))


def round6(c: str | Column) -> Column:
    return F.round(col(c), 6)


def json_unbracket(arr_json: Column) -> Column:
    """``[x]`` -> ``x``: the JSON text of one value, taken from the JSON of a
    one-element array (``to_json`` escapes strings; a null gives ``null``)."""
    return arr_json.substr(F.lit(2), F.length(arr_json) - F.lit(2))
