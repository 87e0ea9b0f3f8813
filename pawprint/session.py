"""Spark session and shared-storage helpers.

Everything in the library works on a caller-provided ``SparkSession``;
``get_spark`` only exists for tests, the benchmark and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "pawprint",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the library is tuned for.

    On a cluster the session comes from the platform; nothing here is needed
    there except that AQE stays on (it is on by default since Spark 3.2).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Checkpoint files of unreferenced datasets are removed by the cleaner.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3,
    ...); it is read from the session and never overridden. A machine-local
    temporary folder is only used on a local master where nothing is
    configured (tests); elsewhere that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        configured = tempfile.mkdtemp(prefix="pawprint-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pawprint-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    Used where a plan is reused by many jobs (cross-validation folds) or has
    grown deep (iterative neighbour merges). Never ``localCheckpoint``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


class Scratch:
    """Tables of one job, written to the shared checkpoint folder and removed when it is done.

    A written table cuts the lineage like a checkpoint does, and its file sizes
    are what the planner goes by: estimates do not multiply over the rounds of
    an iteration.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.tables: list[tuple[str, DataFrame]] = []

    def table(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((path, found))
        return found

    def clear(self, keep: DataFrame | None = None) -> None:
        """Remove the tables, but for ``keep``, one that ``table`` returned."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path, df in self.tables:
            if df is not keep:
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(conf).delete(where, True)
        self.tables = [(p, d) for p, d in self.tables if d is keep]
