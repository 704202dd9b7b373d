"""Movement-model data operators (ML1-ML13, WN1/WN2/WN4/WN6).

Lags, leads, sequence histories and anomaly episodes use the chunked keyed
scans of :mod:`aerotrace.operators.series`; scoring maths are plain column
expressions; model training/scoring use Spark ML (distributed, JVM-side).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerotrace.functions import constants as K
from aerotrace.functions.exprs import epoch_seconds_ntz, haversine_km, surrogate_key
from aerotrace.operators import series
from aerotrace.operators.joins import hybrid_left_join
from aerotrace.operators.prefix import running_sums
from aerotrace.operators.series import Series
from aerotrace.session import stage_table

# feature -> (lag name, lead name)
SHIFTED = {
    "lat": ("prev_lat", "next_lat"),
    "lon": ("prev_lon", "next_lon"),
    "resolved_altitude": ("prev_altitude", "next_altitude"),
    "ground_speed": ("prev_ground_speed", "next_ground_speed"),
    "resolved_vert_rate": ("prev_vert_rate", "next_vert_rate"),
    "track_sin": ("prev_track_sin", "next_track_sin"),
    "track_cos": ("prev_track_cos", "next_track_cos"),
}


def default_series(df: DataFrame, chunk_seconds: int = 86400) -> Series:
    tb = ("row_id",) if "row_id" in df.columns else ()
    return Series.of("icao", "event_timestamp", tb, chunk_seconds, whole_rows=K.WHOLE_SERIES_ROWS)


def usable_rows(df: DataFrame) -> DataFrame:  # ML1
    return df.filter(F.col("icao").isNotNull() & F.col("event_timestamp").isNotNull()
                     & F.col("lat").isNotNull() & F.col("lon").isNotNull())


def angle_features(df: DataFrame) -> DataFrame:  # ML2
    rad = F.radians("track")
    return df.select("*", F.sin(rad).alias("track_sin"), F.cos(rad).alias("track_cos"),
                     epoch_seconds_ntz("event_timestamp").alias("event_unix_ts"))


def flight_features(df: DataFrame, s: Series | None = None) -> DataFrame:
    """ML1 -> ML2 -> WN1 lags -> WN2 leads -> ML3 target filter."""
    base = angle_features(usable_rows(df))
    s = s or default_series(base)
    shifted = series.shift(base, s,
                           lags={p: c for c, (p, _) in SHIFTED.items()},
                           leads={n: c for c, (_, n) in SHIFTED.items()})
    return shifted.filter(F.col("next_lat").isNotNull() & F.col("next_lon").isNotNull()
                          & F.col("next_altitude").isNotNull())


def persistence_predictions(df: DataFrame) -> DataFrame:
    """Deterministic stand-in predictor: next state = current state."""
    return df.select("*", *[F.col(c).alias(f"pred_{n}") for c, (_, n) in SHIFTED.items()])


def residuals(df: DataFrame) -> DataFrame:
    """ML6 position error (km), ML7 absolute errors, ML8 combined score."""
    err = {
        "position_error_km": haversine_km("next_lat", "next_lon", "pred_next_lat", "pred_next_lon"),
        "altitude_error_ft": F.abs(F.col("next_altitude") - F.col("pred_next_altitude")),
        "ground_speed_error": F.abs(F.col("next_ground_speed") - F.col("pred_next_ground_speed")),
        "vert_rate_error": F.abs(F.col("next_vert_rate") - F.col("pred_next_vert_rate")),
        "track_error": (F.abs(F.col("next_track_sin") - F.col("pred_next_track_sin"))
                        + F.abs(F.col("next_track_cos") - F.col("pred_next_track_cos"))),
    }
    out = df.select("*", *[v.alias(k) for k, v in err.items()])
    score = None
    for _, c, scale in K.REASON_SCALES:
        term = F.col(c) / F.lit(scale) if scale != 1.0 else F.col(c)
        score = term if score is None else score + term
    return out.withColumn("xgb_anomaly_score", score)


def is_anomaly(threshold: float = K.ANOMALY_THRESHOLD):  # ML10
    return F.coalesce(F.col("xgb_anomaly_score") >= F.lit(threshold), F.lit(False))


def primary_reason():  # ML11: arg-max of scaled errors, ties in fixed order, null -> 0
    scaled = [(name, F.coalesce(F.col(c) / F.lit(scale), F.lit(0.0))) for name, c, scale in K.REASON_SCALES]
    top = F.greatest(*[v for _, v in scaled])
    out = None
    for name, v in scaled:
        out = F.when(v == top, F.lit(name)) if out is None else out.when(v == top, F.lit(name))
    return out


def hybrid(scores: DataFrame, seq: DataFrame, threshold: float = K.ANOMALY_THRESHOLD) -> DataFrame:
    """JN1 + ML10-ML12: sequence unknown -> residual flag; else both must agree."""
    j = hybrid_left_join(scores, seq.select("icao", "event_timestamp", "chronos_score",
                                            "chronos_confirmed"))
    flag = is_anomaly(threshold)
    return j.select("*", flag.alias("xgb_is_anomaly"),
                    primary_reason().alias("primary_anomaly_reason"),
                    (flag & F.coalesce(F.col("chronos_confirmed"), F.lit(True)))
                    .alias("hybrid_anomaly_label"))


def sequence_windows(df: DataFrame, size: int = K.SEQUENCE_LENGTH, s: Series | None = None,
                     fields=K.SEQUENCE_FIELDS) -> DataFrame:
    """WN6: rows with at least ``size`` predecessors; ``history`` holds the
    previous ``size`` rows (oldest first), ``actual`` the current row."""
    s = s or default_series(df)
    fields = list(fields)
    h = series.tail_history(df, s, fields, size, out="history")
    return (h.filter(F.size("history") == size)
            .select("icao", "event_timestamp", *s.tiebreak, "history",
                    F.struct(*[F.col(c) for c in fields]).alias("actual")))


def confirm(windows: DataFrame, scorer: Callable | None = None) -> DataFrame:
    """ML9: one verdict per sequence window.  Without a scorer the verdict
    is unknown (null), as in the placeholder model.  A scorer is a function
    of one pandas frame of windows (icao, event_timestamp, history, actual)
    that returns it with ``chronos_score`` and ``chronos_confirmed``; it is
    applied in Arrow batches via ``mapInPandas``."""
    if scorer is None:
        return windows.select("icao", "event_timestamp",
                              F.lit(None).cast("double").alias("chronos_score"),
                              F.lit(None).cast("boolean").alias("chronos_confirmed"))

    def run(batches):
        for pdf in batches:
            scored = scorer(pdf)
            yield scored[["icao", "event_timestamp", "chronos_score", "chronos_confirmed"]]

    schema = ("icao string, event_timestamp timestamp_ntz, chronos_score double, "
              "chronos_confirmed boolean")
    return windows.mapInPandas(run, schema)


def anomaly_episodes(df: DataFrame, gap_seconds: float = 300.0,
                     threshold: float = K.ANOMALY_THRESHOLD, s: Series | None = None) -> DataFrame:
    """WN4: consecutive anomalous observations of an aircraft whose gaps are
    at most ``gap_seconds`` form one episode (id, start, end, n, peak)."""
    anomalies = df.filter(F.col("xgb_anomaly_score") >= F.lit(threshold))
    s = s or default_series(anomalies)
    sess = series.gap_sessions(anomalies, s, gap_seconds, out="episode_start")
    return (sess.groupBy("icao", "episode_start")
            .agg(F.max("event_timestamp").alias("episode_end"),
                 F.count("*").alias("n_points"),
                 F.max("xgb_anomaly_score").alias("peak_score"))
            .select(surrogate_key("icao", "episode_start").alias("episode_id"),
                    "icao", "episode_start", "episode_end", "n_points", "peak_score"))


def category_thresholds(df: DataFrame, q: float = 0.99) -> DataFrame:
    """ML13: per-category score threshold = exact discrete q-quantile of the
    category's scores; a category without scores gets the global one.

    Scores are counted per (category, score), range-sorted, and given their
    rank by distributed prefix sums, so a category of any size spreads over
    many tasks and the answer is the same order statistic at every size."""
    scores = stage_table(df.where(F.col("xgb_anomaly_score").isNotNull()).groupBy("category", "xgb_anomaly_score").agg(
        F.count("*").alias("n")), "scores")
    score = F.col("xgb_anomaly_score")

    def quantile(hist, by, name):
        ranked = running_sums(hist, [score], {"before": "n"}, by)
        total = hist.groupBy(*by).agg(F.sum("n").alias("total"))
        total = total.select(*[F.col(c).alias(f"_{c}") for c in by], "total")
        match = F.lit(True)
        for c in by:
            match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
        rank = F.greatest(F.lit(1), F.ceil(F.col("total") * q))
        at = (F.col("before") < rank) & (rank <= F.col("before") + F.col("n"))
        return (ranked.join(total if by else F.broadcast(total), match).where(at)
                .select(*by, score.alias(name)))

    own = quantile(scores, ["category"], "own").withColumnRenamed("category", "_c")
    every = quantile(scores.groupBy("xgb_anomaly_score").agg(F.sum("n").alias("n")), [], "every")
    names = df.select("category").distinct()
    both = names.join(own, names["category"].eqNullSafe(own["_c"]), "left").join(F.broadcast(every), F.lit(True), "left")
    return both.select("category", F.coalesce("own", "every").alias("threshold"))


# --- ML4 / ML5: next-state regressors (Spark ML) ------------------------------
def _assembled(df: DataFrame):
    from pyspark.ml.feature import VectorAssembler
    filled = df.fillna(0, subset=K.FEATURE_COLUMNS)
    return VectorAssembler(inputCols=K.FEATURE_COLUMNS, outputCol="features",
                           handleInvalid="keep").transform(filled)


def by_aircraft(seed: int, share: float = 0.8):
    """True for the ``share`` of aircraft that are trained on: a hash of the
    aircraft, the same on every run and for every row of an aircraft."""
    return F.pmod(F.xxhash64(F.lit(seed), "icao"), F.lit(1000)) < int(share * 1000)


def by_row(seed: int, share: float = 0.8):
    """True for the ``share`` of rows that are trained on: a hash of the
    observation, the same on every run and however the rows are partitioned.
    Neighbouring rows of an aircraft fall on both sides."""
    return F.pmod(F.xxhash64(F.lit(seed), "icao", "event_timestamp"), F.lit(1000)) < int(share * 1000)


def train_next_state(df: DataFrame, path: str | None = None, params: dict | None = None,
                     seed: int = 42, split: str = "rows") -> tuple[dict, dict]:
    """ML4: one gradient-boosted regressor per target, trained on 80 % of the
    rows and tested on the others (``split="rows"``, random over time within
    an aircraft too), or split by aircraft (``"aircraft"``), which leaves no
    aircraft on both sides and gives the honest error of an unseen one.
    Returns (models, hold-out MAE per target).  Rows with a null label are
    dropped per target.  Models are saved under ``path`` when given."""
    from pyspark.ml.regression import GBTRegressor
    p = dict(K.GBT_PARAMS)
    p.update(params or {})
    from pyspark import StorageLevel
    data = _assembled(df)
    # Seven fits read the same split: persist it once (spills to disk, and a
    # lost executor recomputes only its partitions) instead of re-running
    # the feature lineage per target.
    in_train = {"rows": by_row, "aircraft": by_aircraft}[split](seed)
    train, test = [data.filter(side).persist(StorageLevel.MEMORY_AND_DISK) for side in (in_train, ~in_train)]
    models, mae = {}, {}
    try:
        for target in K.TARGET_COLUMNS:
            tr = train.filter(F.col(target).isNotNull())
            gbt = GBTRegressor(featuresCol="features", labelCol=target, predictionCol=f"pred_{target}",
                               lossType="squared", **p)
            m = gbt.fit(tr)
            models[target] = m
            te = m.transform(test.filter(F.col(target).isNotNull()))
            mae[target] = te.agg(F.avg(F.abs(F.col(target) - F.col(f"pred_{target}")))).first()[0]
            if path:
                m.write().overwrite().save(f"{path.rstrip('/')}/{target}_model")
    finally:
        train.unpersist()
        test.unpersist()
    return models, mae


def score_next_state(df: DataFrame, models: dict | str) -> DataFrame:
    """ML5: add ``pred_<target>`` for every target (models or a saved path)."""
    if isinstance(models, str):
        from pyspark.ml.regression import GBTRegressionModel
        models = {t: GBTRegressionModel.load(f"{models.rstrip('/')}/{t}_model")
                  for t in K.TARGET_COLUMNS}
    out = _assembled(df)
    for t in K.TARGET_COLUMNS:
        out = models[t].setPredictionCol(f"pred_{t}").transform(out)
    return out.drop("features")
