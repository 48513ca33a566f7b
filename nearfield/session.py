"""SparkSession defaults for the library.

The library never creates a session behind the caller's back; jobs and tests call
``build_session`` (or bring their own session and call ``apply_defaults``).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on. Timestamps are UTC (the reference stores UTC instants);
# AQE re-plans joins from real shuffle sizes and splits skewed partitions; the window-group
# limit threshold is raised so `row_number() <= k` keeps its map-side top-k for large k.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Timestamps without zone, like the stored UTC instants; streams cast to TIMESTAMP for watermarks.
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "nearfield") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("NEARFIELD_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage; only when it is unset (local runs,
    tests) a private folder is made here, for the life of the session.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            configured = tempfile.mkdtemp(prefix="nearfield-ckpt-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for materialised intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, as ``--py-files`` would, so that tasks can import it wherever
    it lies. The archive stays on the driver, which serves it, until the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = os.path.realpath(tempfile.mkdtemp(prefix="nearfield-py-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        shutil.copytree(f"{root}/nearfield", f"{folder}/in/nearfield", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/nearfield", "zip", f"{folder}/in"))
        _shipped.add(app)


def path_of(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop file system that holds ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


class Scratch:
    """Intermediate tables as Parquet in the shared folder: they cut lineage, survive lost executors and tell the planner their
    size. A step that has been read for the last time is dropped."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.steps = spark, work_dir(spark, f"{name}-{uuid.uuid4().hex}"), 0

    def written(self, df: DataFrame, *partitions: str) -> DataFrame:
        """The table, written and read back; ``df.scratch_path`` names its folder."""
        self.steps += 1
        path = f"{self.root}/{self.steps}"
        (df.write.partitionBy(*partitions) if partitions else df.write).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        fs, where = path_of(self.spark, df.scratch_path)
        fs.delete(where, True)
