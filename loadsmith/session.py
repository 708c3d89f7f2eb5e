"""Session construction and the shared scratch folder.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3, ...);
lineage cuts and intermediate tables go there.  Only when it is unset (local
tests) do we pick a folder of our own.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "loadsmith", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only in local mode.

    On a cluster every executor would write to its own disk and rows would be
    missing when they are read back, so there the folder must be named.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="loadsmith-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder, in the application's own."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/loadsmith-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has written with ``scratch_path``; call it when its results are stored."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{root}/loadsmith-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def estimated_bytes(df) -> int:
    """Catalyst's size estimate of a DataFrame's plan (statistics only, no job)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) if isinstance(size, int) else int(size.toString())


def is_large(df, limit: int) -> bool:
    """Whether Catalyst's estimate exceeds ``limit``; no (if above 0) for a frame without statistics."""
    size = estimated_bytes(df)
    return limit == 0 or limit < size < 1 << 62


def materialize_counted(df, name: str = "stage"):
    """``materialize`` plus the exact number of rows written (observed by the write)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = scratch_path(spark, name)
    from loadsmith.sinks.publish import observed_metrics

    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    rows = int(observed_metrics(obs, ["n"])["n"] or 0)
    return spark.read.schema(df.schema).parquet(path), rows


def materialize(df, name: str = "stage"):
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage like ``checkpoint()`` but in a single job (a reliable
    ``checkpoint()`` of a DataFrame computes its plan twice: once to count,
    once to write), and the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer job
