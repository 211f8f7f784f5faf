"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces partitions at
# runtime; skew-join splitting covers a hot key on a join side.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The page job receives whole html pages: keep Arrow batches small so a
    # Python worker holds a few hundred pages, not ten thousand.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.ui.enabled": "false",
    # Checkpoint files of stages no longer referenced are deleted from the
    # shared folder (long-running jobs would otherwise fill it).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "pricelake", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    On a cluster the session is created by the launcher and only the
    SQL-level settings are applied here.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
        for k, v in DEFAULT_CONF.items():
            if k.startswith("spark.sql.") and k != "spark.sql.shuffle.partitions":
                spark.conf.set(k, v)
    else:
        b = SparkSession.builder.appName(app_name)
        if master:
            b = b.master(master)
        for k, v in DEFAULT_CONF.items():
            b = b.config(k, v)
        if shuffle_partitions:
            b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        for k, v in (extra or {}).items():
            b = b.config(k, v)
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only when it
    is unset on a local master -- tests -- a scratch folder is created; on a
    cluster, where executors could not see it, that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pricelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder; what is written there
    is deleted when the driver process ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_delete_scratch)
    _SCRATCH[path] = spark
    return path


def materialize(df):
    """Cut lineage after an expensive stage (the page job) with a written
    table: later stages read only the columns they need, and a lost executor
    does not re-run the stage."""
    return save_and_reload(df, "stage")


#: Rows of a spread table in one task at most: a row of a few numbers can stand for whole pages.
ROWS_PER_TASK = 200_000


def spread(df):
    """For benchmarks and tests on one machine: give every core work when a
    scan has fewer partitions than the default parallelism (a small file is
    one split), with tasks that do not grow with the table. On a cluster the
    input is left as it is: it has many splits."""
    n = df.sparkSession.sparkContext.defaultParallelism
    if not df.sparkSession.sparkContext.master.startswith("local") or df.rdd.getNumPartitions() >= n:
        return df
    # Parquet keeps the number of rows beside the data
    return df.repartition(max(n, -(-df.count() // ROWS_PER_TASK)))


_SCRATCH: dict = {}


def save_and_reload(df, name: str = "stage"):
    """Cut lineage with a written Parquet table in the shared checkpoint
    folder (read back as a plain scan). The table is deleted when the
    driver process ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete_scratch() -> None:
    """At exit: remove the scratch folders of sessions that still run."""
    for path, spark in _SCRATCH.items():
        if spark._jsc is not None and not spark._jsc.sc().isStopped():
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _SCRATCH.clear()
