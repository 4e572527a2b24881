"""Session settings and the shared folder used to cut long lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "stintwise", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    AQE coalesces small shuffle partitions, turns joins with a small measured
    side into broadcasts and splits skewed join partitions, so the operators
    carry no partition counts of their own.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str | None:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    On a local master without that setting a fresh temporary folder serves,
    because driver and executors are one process there. On a cluster without
    it there is no safe place to write, so the answer is None.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        return None
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="stintwise-")
    return _local_dirs[sc.applicationId]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: what reads it, reads the same rows, however often and wherever it restarts."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stintwise/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
