"""Windowed panels that late rows correct instead of vanishing.

A streaming aggregation drops the rows behind its watermark.  Here a batch
function keeps them: each micro-batch is split at the watermark that the
batches before it have set.  Rows of windows that are still open go into the
panel's partial results, rows of closed windows into a side table.  Partial
results merge, so the panel at any time is one aggregate over a few rows per
window and batch, and a merge job folds the side table into closed windows.

Every batch writes folders of its own, named by its id; a batch that is
replayed writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerotrace.functions.exprs import epoch_micros_ntz, ntz_from_micros


class LatePanel:
    """Counts and value sums per tumbling window under ``path``.

    ``open`` and ``late`` hold partial results per batch, ``late_rows`` the
    late rows themselves, ``progress`` the latest time of each batch."""

    def __init__(self, path: str, time_col: str, value: str, by: list[str] | None = None, minutes: int = 1, delay_minutes: int = 2):
        self.path, self.time, self.value, self.by = path.rstrip("/"), time_col, value, list(by or [])
        self.width, self.delay = minutes * 60_000_000, delay_minutes * 60_000_000

    def window_start(self):
        t = epoch_micros_ntz(self.time)
        return t - F.pmod(t, F.lit(self.width))

    def partials(self, rows: DataFrame) -> DataFrame:
        v = F.col(self.value)
        return rows.groupBy(ntz_from_micros(self.window_start()).alias("window_start"), *self.by).agg(
            F.count("*").alias("n_rows"), F.count(v).alias("n_values"), F.sum(v.cast("decimal(28,6)")).alias("total"),
            F.min(v).alias("low"), F.max(v).alias("high"))

    def merged(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy("window_start", *self.by).agg(
            F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.sum("total").cast("decimal(38,6)").alias("total"),
            F.min("low").alias("low"), F.max("high").alias("high"))

    def _read(self, spark: SparkSession, part: str) -> DataFrame | None:
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        if not root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(root):
            return None
        return spark.read.parquet(f"{self.path}/{part}")

    def watermark(self, spark: SparkSession, before_batch: int | None = None) -> int | None:
        """Microseconds before which windows are closed for ``before_batch``
        (for the next batch without it): the latest time of the batches ahead
        less the delay.  One row per batch is read."""
        progress = self._read(spark, "progress")
        if progress is None:
            return None
        if before_batch is not None:
            progress = progress.where(F.col("batch") < before_batch)
        latest = progress.agg(F.max("latest")).first()[0]
        return None if latest is None else latest - self.delay

    def route(self, batch: DataFrame, batch_id: int) -> None:
        """The batch function: a late row is one whose window ended at or
        before the watermark.  The batch is read once and kept while both
        sides are written; rows without a time are late."""
        spark = batch.sparkSession
        mark = self.watermark(spark, batch_id)
        batch.persist()
        try:
            closed = F.lit(False) if mark is None else F.coalesce(self.window_start() + self.width <= F.lit(mark), F.lit(True))
            late, on_time = batch.where(closed | F.col(self.time).isNull()), batch.where(~closed & F.col(self.time).isNotNull())
            self.partials(on_time).write.mode("overwrite").parquet(f"{self.path}/open/batch={batch_id}")
            self.partials(late).write.mode("overwrite").parquet(f"{self.path}/late/batch={batch_id}")
            late.write.mode("overwrite").parquet(f"{self.path}/late_rows/batch={batch_id}")
            latest = batch.agg(F.max(epoch_micros_ntz(self.time)).alias("latest"))
            latest.write.mode("overwrite").parquet(f"{self.path}/progress/batch={batch_id}")
        finally:
            batch.unpersist()

    def panel(self, spark: SparkSession, closed_only: bool = False) -> DataFrame:
        """The panel without late rows; ``closed_only`` leaves windows out that may still grow."""
        out = self.merged(self._read(spark, "open"))
        if closed_only:
            mark = self.watermark(spark)
            out = out.where(epoch_micros_ntz("window_start") + self.width <= F.lit(mark)) if mark is not None else out.where(F.lit(False))
        return out

    def corrections(self, spark: SparkSession) -> DataFrame:
        """What late rows add to closed windows (a null window: rows without a time)."""
        return self.merged(self._read(spark, "late"))

    def corrected(self, spark: SparkSession) -> DataFrame:
        """Panel and corrections merged: what a batch job over all rows gives."""
        return self.merged(self._read(spark, "open").unionByName(self._read(spark, "late")))

    def start(self, df: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        w = df.writeStream.foreachBatch(self.batch_function()).option("checkpointLocation", checkpoint)
        return (w.trigger(**trigger) if trigger else w).start()

    def batch_function(self) -> Callable[[DataFrame, int], None]:
        return self.route
