"""Stateful streams against their batch forms: files stand for arrivals, one
micro-batch a file, and every query is stopped and started again half way."""

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerotrace.streaming import streams

DAY = pd.Timestamp("2024-03-01")


def _tmp():
    return tempfile.mkdtemp(prefix="aerotrace-test-", dir="/tmp")


def _land(folder, frames, first=0):
    """One file per frame, picked up in this order."""
    os.makedirs(folder, exist_ok=True)
    for i, frame in enumerate(frames, first):
        kinds = {"icao": "string", "squawk": "string", "verdict": "string", "speed": "float64", "score": "float64"}
        frame = frame.astype({c: k for c, k in kinds.items() if c in frame})
        path = os.path.join(folder, f"part-{i:04d}.parquet")
        frame.to_parquet(path, coerce_timestamps="us", index=False)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def _stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _run(df, out, checkpoint):
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]


def _key(r):
    return tuple((x is None, str(x)) for x in r)


def _rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)


def _minutes(*m):
    return [DAY + pd.Timedelta(seconds=round(60 * x)) for x in m]


SCORES = "icao string, event_timestamp timestamp_ntz, score double"
VERDICTS = "icao string, verdict_timestamp timestamp_ntz, verdict string"


@pytest.mark.parametrize("how", ["left", "inner"])
def test_verdict_join_equals_the_batch_join_and_state_expires(spark, how):
    base = _tmp()
    scores = [pd.DataFrame({"icao": ["a", "b", "c", None], "event_timestamp": _minutes(0, 1, 2, 2), "score": [1.0, 2, 3, 4]})]
    verdicts = [pd.DataFrame({"icao": ["b", "x"], "verdict_timestamp": _minutes(1, 1), "verdict": ["same time", "no score"]})]
    for i in range(1, 9):  # time goes on; a's verdict comes at the end of its range, c's after it
        at = 10 * i
        scores.append(pd.DataFrame({"icao": ["a", f"n{i}"], "event_timestamp": _minutes(at, at + 1), "score": [10.0 + i, None]}))
        names = {3: ["a", "c"], 5: [f"n{5}"]}.get(i, ["z"])
        verdicts.append(pd.DataFrame({"icao": names, "verdict_timestamp": _minutes(*([30, 32.1][:len(names)] if i == 3 else [at + 2])),
                                      "verdict": [f"v{i}"] * len(names)}))
    flush = _minutes(1000)
    scores.append(pd.DataFrame({"icao": ["end"], "event_timestamp": flush, "score": [0.0]}))
    verdicts.append(pd.DataFrame({"icao": ["end"], "verdict_timestamp": flush, "verdict": ["end"]}))
    for f in ("s", "v"):
        os.makedirs(f"{base}/{f}")

    def joined(read):
        return streams.verdict_join(read(f"{base}/s", SCORES), read(f"{base}/v", VERDICTS), how)

    counts = []
    for part in (slice(0, 5), slice(5, None)):
        first = part.start
        _land(f"{base}/s", scores[part], first), _land(f"{base}/v", verdicts[part], first)
        counts += _run(joined(lambda p, s: _stream(spark, p, s)), f"{base}/out", f"{base}/ck")
    columns = ["icao", "event_timestamp", "score", "verdict_timestamp", "verdict"]
    got = _rows(spark.read.parquet(f"{base}/out"), columns)
    want = _rows(joined(lambda p, s: spark.read.schema(s).parquet(p)), columns)
    # the last score waits for a verdict still
    assert [r for r in got if r[0] != "end"] == [r for r in want if r[0] != "end"]
    assert any(r[0] == "a" and r[4] == "v3" for r in got) and not any(r[0] == "c" and r[4] for r in got)
    assert max(counts) < 2 * 10 * 2 and counts[-1] <= 4


TRACES = "icao string, event_timestamp timestamp_ntz, row_id long, squawk string, speed double"


def _observations():
    import random
    rng = random.Random(6)
    rows, t = [], 0.0
    for i in range(160):
        t += rng.choice([0.1, 0.5, 1.0, 1.0, 9.0])
        rows.append((rng.choice("aaab"), DAY + pd.Timedelta(seconds=round(60 * t)), i, rng.choice([None, "1200", "7700"]),
                     rng.choice([None, float(i)])))
    rows.append(("b", rows[-1][1], 160, None, None))  # a tie in time
    shuffled = sorted(rows, key=lambda r: r[1] + pd.Timedelta(seconds=rng.randrange(540)))  # within the delay of ten minutes
    frames = [pd.DataFrame(shuffled[i:i + 20], columns=["icao", "event_timestamp", "row_id", "squawk", "speed"]) for i in range(0, len(shuffled), 20)]
    end = pd.DataFrame([("end", DAY + pd.Timedelta(days=9), 999, None, None)], columns=frames[0].columns)
    return frames + [end, end.assign(event_timestamp=DAY + pd.Timedelta(days=10))]


def test_fill_and_episodes_equal_the_batch_scans(spark):
    from aerotrace.operators.series import Series, fill, gap_sessions
    from aerotrace.streaming.stateful import fill_and_episodes_stream, use_rocksdb
    base, frames = _tmp(), _observations()
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    try:
        for part in (slice(0, 5), slice(5, None)):
            _land(f"{base}/in", frames[part], part.start)
            counts = _run(fill_and_episodes_stream(_stream(spark, f"{base}/in", TRACES), ["squawk", "speed"]), f"{base}/out", f"{base}/ck")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    rows = spark.read.schema(TRACES).parquet(f"{base}/in").where("icao <> 'end'")
    series = Series.of("icao", "event_timestamp", "row_id")
    batch = fill(gap_sessions(rows, series, 300.0, out="episode_start"), series, forward=["squawk", "speed"], prefix_forward="filled_")
    columns = ["icao", "event_timestamp", "row_id", "squawk", "speed", "filled_squawk", "filled_speed", "episode_start"]
    got = _rows(spark.read.parquet(f"{base}/out").where("icao <> 'end'"), columns)
    assert got == _rows(batch, columns) and len(got) == 161
    assert counts[-1] < 20  # silent keys have given their state back


def test_late_rows_correct_the_panel(spark):
    from aerotrace.streaming.late import LatePanel
    base = _tmp()
    frames = []
    for i in range(6):
        late = _minutes(i - 4, 0.5) if i >= 4 else []
        times = _minutes(i, i + 0.2, i + 0.9) + late + ([None] if i == 3 else [])
        frames.append(pd.DataFrame({"icao": [f"p{j % 2}" for j in range(len(times))], "event_timestamp": pd.to_datetime(pd.Series(times)),
                                    "row_id": range(len(times)), "squawk": None, "speed": [float(i + j) for j in range(len(times))]}))
    panel = LatePanel(f"{base}/panel", "event_timestamp", "speed", ["icao"], minutes=1, delay_minutes=2)
    for part in (slice(0, 3), slice(3, None)):
        _land(f"{base}/in", frames[part], part.start)
        q = panel.start(_stream(spark, f"{base}/in", TRACES), f"{base}/ck", {"availableNow": True})
        assert q.awaitTermination(240)
    rows = spark.read.schema(TRACES).parquet(f"{base}/in")
    columns = ["window_start", "icao", "n_rows", "n_values", "total", "low", "high"]
    want = _rows(panel.merged(panel.partials(rows)), columns)
    assert _rows(panel.corrected(spark), columns) == want
    assert _rows(panel.panel(spark), columns) != want and panel.corrections(spark).where("window_start IS NOT NULL").count() >= 2
    assert spark.read.parquet(f"{base}/panel/late_rows").count() == 4 + 1
    closed = panel.panel(spark, closed_only=True)
    assert closed.agg(F.max("window_start")).first()[0] < pd.Timestamp(DAY + pd.Timedelta(minutes=4))
    # a batch that is replayed changes nothing
    panel.route(spark.createDataFrame(frames[5].astype({"squawk": "object"}).where(lambda x: x.notna(), None), TRACES), 5)
    assert _rows(panel.corrected(spark), columns) == want
