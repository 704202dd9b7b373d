"""Next-state regressors (Spark ML GBT): train small, score, reload."""

import tempfile

from pyspark.sql import functions as F

from aerotrace.functions import constants as K
from aerotrace.operators import ml
from aerotrace.plans import medallion
from aerotrace.sources import fixtures as fx
from paths import SF001


def test_train_score_reload(spark):
    feats = ml.flight_features(medallion.silver(fx.traces(spark, SF001)))
    path = tempfile.mkdtemp(prefix="aerotrace-models-", dir="/tmp")
    models, mae = ml.train_next_state(feats, path, params={"maxIter": 2, "maxDepth": 3})
    assert set(mae) == set(K.TARGET_COLUMNS)
    assert all(v is not None and v == v and v >= 0 for v in mae.values())
    a = ml.score_next_state(feats, models)
    b = ml.score_next_state(feats, path)
    cols = [f"pred_{t}" for t in K.TARGET_COLUMNS]
    ra = sorted(tuple(r) for r in a.select("row_id", *cols).collect())
    rb = sorted(tuple(r) for r in b.select("row_id", *cols).collect())
    assert ra == rb
    scored = ml.residuals(b)
    rows = scored.select("xgb_anomaly_score", "position_error_km", *cols).collect()
    assert len(rows) == feats.count()
    assert all(getattr(r, c) is not None for r in rows for c in cols)
    assert all(r.position_error_km >= 0 for r in rows)
    # each aircraft is on one side of the split only, and both sides have some
    sides = feats.select("icao", ml.by_aircraft(42).alias("side")).distinct()
    assert sides.count() == feats.select("icao").distinct().count()
    assert sides.select("side").distinct().count() == 2
    # the default split is by row: a share of four fifths, and aircraft on both sides
    rows = feats.groupBy("icao").agg(F.avg(ml.by_row(42).cast("int")).alias("share"), F.count("*").alias("n"))
    total = rows.agg(F.sum(F.col("share") * F.col("n")) / F.sum("n")).first()[0]
    assert 0.7 < total < 0.9 and rows.where("share > 0 AND share < 1").count() > 0
    assert feats.repartition(7).where(ml.by_row(42)).count() == feats.where(ml.by_row(42)).count()
