"""As-of join, interval overlaps, trailing ranges, ranks, set operations and
grouping levels against plain versions, with a hot key and ties."""

import bisect
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerotrace.operators import rowsets, sketches, temporal
from aerotrace.operators.series import Series

T0 = datetime(2024, 5, 1)


def _times(rng, n, days=6):
    return [T0 + timedelta(seconds=rng.randrange(days * 86400 // 40) * 40) for _ in range(n)]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def _sides(spark):
    """A third of the rows of both sides share one key; many times are equal."""
    rng = random.Random(1)
    key = lambda: rng.choice(["hot", "hot", *"abcd", None])
    left = [(key(), t, i) for i, t in enumerate(_times(rng, 300))] + [("hot", None, 900), (None, None, 901)]
    right = [(key(), t, i % 7, f"v{i}") for i, t in enumerate(_times(rng, 200))] + [("hot", None, 1, "no time")]
    return (left, right, spark.createDataFrame(left, "k string, t timestamp_ntz, id long").repartition(3),
            spark.createDataFrame(right, "k string, at timestamp_ntz, tie int, v string").repartition(3))


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("tolerance", [None, 7200])
def test_asof_join_equals_brute_force(spark, direction, tolerance):
    left, right, l, r = _sides(spark)
    want = []
    for k, t, i in left:
        best = None
        for rk, rt, tie, v in right:
            if k is None or t is None or rk != k or rt is None or (rt > t if direction == "backward" else rt < t):
                continue
            if tolerance is not None and abs((t - rt).total_seconds()) > tolerance:
                continue
            better = (rt, tie) if direction == "backward" else (-(rt - T0).total_seconds(), -tie)
            if best is None or better > best[0]:
                best = (better, rt, tie)
        want.append((k, t, i, *(best[1:] if best else (None, None))))
    got = temporal.asof_join(l, r, "k", "t", "at", tolerance, "tie", direction, prefix="r_", chunk_seconds=3600, max_chunk_rows=20)
    assert got.columns == ["k", "t", "id", "r_at", "r_tie", "r_v"]
    assert _rows(got.drop("r_v")) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    value = {(k, at, tie): v for k, at, tie, v in right}
    assert all(x.r_v is None or x.r_at is not None for x in got.collect()) and value


def test_asof_join_of_empty_sides_and_clashes(spark):
    _, _, l, r = _sides(spark)
    assert temporal.asof_join(l, r.limit(0), "k", "t", "at").where("v IS NOT NULL").count() == 0
    assert temporal.asof_join(l.limit(0), r, "k", "t", "at").count() == 0
    with pytest.raises(ValueError, match="prefix"):
        temporal.asof_join(l, l, "k", "t", "t")


def test_interval_overlaps_come_out_once(spark):
    rng = random.Random(2)
    length = lambda: rng.choice([0, 1, 40, 3600, 90000, 3600 * 4, 600000])
    one = lambda i: (rng.choice(["hot", "hot", "a", "b", None]), T0 + timedelta(seconds=rng.randrange(500000)), i)
    left = [(k, s, s + timedelta(seconds=length()), i) for k, s, i in map(one, range(150))]
    right = [(k, s, s + timedelta(seconds=length()), i) for k, s, i in map(one, range(150))]
    left += [("hot", T0, None, 900), ("hot", T0, T0 - timedelta(seconds=1), 901), ("hot", datetime(1960, 1, 1), datetime(2060, 1, 1), 902)]
    l = spark.createDataFrame(left, "k string, s timestamp_ntz, e timestamp_ntz, l long").repartition(3)
    r = spark.createDataFrame(right, "k string, rs timestamp_ntz, re timestamp_ntz, r long").repartition(3)
    valid = [(k, s, e, i) for k, s, e, i in left if e is not None and s <= e]
    for key, cond in (("k", lambda a, b: a[0] is not None and a[0] == b[0]), ([], lambda a, b: True)):
        rights = r if key else r.withColumnRenamed("k", "k2")
        got = temporal.interval_overlap_join(l, rights, key, ("s", "e"), ("rs", "re"))
        want = [(a[3], b[3]) for a in valid for b in right if cond(a, b) and a[1] <= b[2] and b[1] <= a[2]]
        assert _rows(got.select("l", "r")) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
        plan = got._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_trailing_range_equals_the_plain_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", None]), t, i, rng.choice([None, round(rng.uniform(-9, 9), 3), 1e9])) for i, t in enumerate(_times(rng, 400, 2))]
    df = spark.createDataFrame([*rows, ("a", None, 999, 1.0)], "k string, t timestamp_ntz, id long, v double").repartition(4)
    got = temporal.trailing_range(df, Series.of("k", "t", chunk_seconds=3600, max_chunk_rows=15), 1800, {"x": "v"})
    w = Window.partitionBy("k").orderBy(F.expr("unix_micros(cast(t AS timestamp))")).rangeBetween(-1800 * 10**6, 0)
    money = F.sum(F.col("v").cast("decimal(28,6)")).over(w).cast("double")
    plain = df.where("t IS NOT NULL").select("*", F.count("*").over(w).alias("n_rows"), F.count("v").over(w).alias("x_n"), money.alias("x_sum"),
                                             (money / F.nullif(F.count("v").over(w), F.lit(0))).alias("x_avg"))
    assert got.columns == plain.columns
    assert _rows(got.where("t IS NOT NULL")) == _rows(plain)
    assert [tuple(r)[2:] for r in got.where("t IS NULL").collect()] == [(999, 1.0, None, None, None, None)]


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("tiles", [1, 7, 1000])
def test_ranks_equal_window_functions(spark, by, tiles):
    rng = random.Random(4)
    rows = [(rng.choice(["x", "x", "y", None]), rng.choice([None, 1.5, 1.5, 2.0, float(i)]), i) for i in range(300)] + [("one", 3.0, 999)]
    df = spark.createDataFrame(rows, "g string, v double, id long").repartition(5)
    w = Window.partitionBy(*by).orderBy(F.col("v").asc_nulls_last())
    u = Window.partitionBy(*by).orderBy(F.col("v").asc_nulls_last(), "id")
    plain = df.select("*", F.row_number().over(u).alias("row_number"), F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"),
                      F.percent_rank().over(w).alias("percent_rank"), F.cume_dist().over(w).alias("cume_dist"), F.ntile(tiles).over(u).alias("ntile"))
    assert _rows(rowsets.rank_family(df, "v", ["id"], by, tiles)) == _rows(plain)


def test_set_operations_keep_multiplicity(spark):
    rng = random.Random(5)
    one = lambda n: [(rng.choice(["a", None]), rng.randrange(3)) for _ in range(n)]
    a, b = one(50) + [("hot", 1)] * 3000, one(40) + [("hot", 1)] * 500
    da, db = (spark.createDataFrame(x, "s string, n int").repartition(3) for x in (a, b))
    ca, cb = Counter(a), Counter(b)
    count = lambda df: Counter(tuple(r) for r in df.collect())
    assert count(rowsets.except_all(da, db)) == ca - cb
    assert count(rowsets.intersect_all(da, db)) == ca & cb
    got = count(rowsets.delivery_difference(da, db))
    assert got == Counter({("removed", *k): v for k, v in (ca - cb).items()} | {("added", *k): v for k, v in (cb - ca).items()})
    assert rowsets.except_all(da.limit(0), db).count() == 0
    with pytest.raises(ValueError):
        rowsets.except_all(da, db.select("s"))


def test_grouping_levels_read_and_shuffle_the_input_once(spark):
    rows = [(x, y, v) for x in ("a", None) for y in (1, 2) for v in (1.0, None, 3.0)]
    df = spark.createDataFrame(rows, "x string, y int, v double")
    got = rowsets.grouping_levels(df, ["x", "y"], [["x", "y"], ["x"], []], {"v": "v"})
    want = df.groupingSets([[F.col("x"), F.col("y")], [F.col("x")], []], "x", "y").agg(
        F.grouping_id().alias("grouping_id"), F.count("*").alias("n_rows"), F.count("v").alias("v_n"), F.sum("v").alias("v_sum"), F.min("v").alias("v_min"),
        F.max("v").alias("v_max"), F.avg("v").alias("v_avg"))
    assert _rows(got) == _rows(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and plan.index("Expand") < plan.rindex("Aggregate")


def test_sketches_stay_within_their_error(spark):
    df = spark.range(60000).select(
        F.timestamp_add("MINUTE", F.col("id") % 7000, F.lit(T0)).cast("timestamp_ntz").alias("t"), (F.col("id") * 7919 % 20011).alias("who"),
        F.when(F.col("id") % 10 > 0, F.xxhash64("id") % 1000 / 3.0).alias("v"))
    hourly = sketches.hourly_sketches(df, "t", [], "who", "v")
    got = sketches.merged(hourly, F.lit("all")).first()
    exact = df.agg(F.count("*").alias("n"), F.count("v").alias("nv"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.countDistinct("who").alias("d")).first()
    assert (got.n_rows, got.n_values, got.low, got.high) == (exact.n, exact.nv, exact.lo, exact.hi)
    assert abs(got.n_distinct - exact.d) < 0.05 * exact.d
    values = sorted(r.v for r in df.where("v IS NOT NULL").collect())
    for q, x in ((0.05, got.q5), (0.5, got.q50), (0.95, got.q95)):
        assert abs(bisect.bisect(values, x) / len(values) - q) < 0.02
    assert sketches.merged(hourly, F.col("hour").cast("date")).count() == 5
    assert sketches.merged(sketches.hourly_sketches(df.limit(0), "t", [], "who", "v"), F.lit("all")).count() == 0
