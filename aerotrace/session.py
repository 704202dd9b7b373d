"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import importlib.util
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins/partition counts at
# runtime from real sizes, skew-join splits hot partitions, and the session
# time zone is pinned so TIMESTAMP (LTZ) values print identically everywhere.
# The generated code of wide projections (42 columns and more) is longer than
# the JVM compiles by default; without the flag it runs interpreted.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "aerotrace", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a folder that the driver
    and every executor share (HDFS, object store) and is used as is; without
    it this raises, because a machine-local folder would give each executor a
    table of its own.  Only a ``local`` master, where driver and executors are
    one process, gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="aerotrace-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def stage_table(df: DataFrame, name: str = "stage", files: int | None = None, row_group: int | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return a scan of it (lineage cut; reliable, unlike
    ``localCheckpoint``).  ``drop_staged`` removes it when nothing reads it
    any more.  ``files``: at most so many tasks write, one file each; of use
    where the last shuffle has more partitions than its rows need.
    ``row_group``: bytes of a Parquet row group, about, for wide rows."""
    spark = df.sparkSession
    if files is not None:
        df = df.coalesce(files)
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").options(**({"parquet.block.size": row_group} if row_group else {})).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def drop_staged(*tables: DataFrame) -> None:
    """Delete the files of staged tables whose readers have all run."""
    for table in tables:
        path = getattr(table, "_staged_path", None)
        if path is None:
            raise ValueError("not a table made by stage_table")
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def listing(spark: SparkSession, pattern: str) -> str:
    """The file system's entries under a glob pattern (path, length, time of
    change, ...) as one text: one call, however many files there are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return spark._jvm.scala.runtime.ScalaRunTime.stringOf(found) if found else ""


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the session's Python workers if they cannot import
    it: where the repository is not on their path (a notebook, a remote
    cluster), it is zipped and added to the application once."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    name = __package__.split(".")[0]
    if not all(sc.parallelize([name], 1).map(importlib.util.find_spec).map(bool).collect()):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix=f"{name}-code-")
        sc.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))
    _shipped.add(sc.applicationId)
