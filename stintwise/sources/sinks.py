"""Writing tables and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import race_slug
from ..operators.quality import measured, measured_rows, quality_document
from ..operators.selection import keep_selected

RACE = ("season", "race_name")


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str] = RACE, only_touched: bool = False) -> None:
    """Overwrite a table laid out by ``keys``.

    Rows are rebalanced on the keys: AQE joins small partitions and splits a
    partition that outgrows the advisory size, so a heavy race becomes several
    files written by several tasks. ``only_touched`` leaves partitions that
    the frame does not mention as they are.
    """
    mode = "dynamic" if only_touched else "static"
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_measured(df: DataFrame, path: str, keys: Sequence[str] = RACE, **checks) -> tuple[DataFrame, DataFrame]:
    """Overwrite a table laid out by ``keys`` and return (the written table, its quality rows): see ``measured``.

    The figures are taken in the tasks that write, behind the rebalance, so a map task that runs again does not count twice.
    """
    seen_df, seen = measured(df.hint("rebalance", *keys), **checks)
    seen_df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), measured_rows(df, seen.get)


def remove_partitions(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[Sequence]) -> None:
    """Remove the folders of the named partitions of a table laid out by ``keys``; those that are not there are passed over."""
    jvm = spark._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in values:
        folder = "/".join(f"{k}={escape(str(v))}" for k, v in zip(keys, row))
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_selected_races(df: DataFrame, chosen: DataFrame, path: str, prefix: str = "processed_") -> None:
    """One folder per selected race that has rows, named by its slug, in one write."""
    kept = keep_selected(df, chosen).withColumn("race_slug", race_slug(F.col("race_name"), F.col("season"), prefix))
    write_partitioned(kept, path, ["race_slug"], only_touched=True)


def write_quality_report(rows: DataFrame, path: str) -> None:
    quality_document(rows).coalesce(1).write.mode("overwrite").json(path)
