"""Gold tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DATABASE = "stintwise"
PARTITIONS = ("season", "race_name")


# Columns of the gold tables before the partition columns.
GOLD_SCHEMAS = {
    "driver_analytics": (
        "driver STRING, avg_lap_time_seconds DOUBLE, fastest_lap DOUBLE, lap_time_std DOUBLE, grid_position DOUBLE, "
        "final_position DOUBLE, consistency_index DOUBLE, position_change DOUBLE"
    ),
    "tire_analytics": (
        "compound STRING, driver STRING, avg_lap_time DOUBLE, tire_degradation_rate DOUBLE, max_stint_length DOUBLE, "
        "compound_usage_pct DOUBLE"
    ),
    "pitstop_analytics": (
        "driver STRING, pit_count BIGINT, avg_pit_window DOUBLE, undercut_success_rate DOUBLE, "
        "pit_stop_efficiency_score DOUBLE, strategy_type STRING"
    ),
    "race_analytics": (
        "driver STRING, driver_avg_clean_lap_time DOUBLE, race_pace_ranking INT, driver_positions_gained DOUBLE, "
        "fastest_sector1_time DOUBLE, fastest_sector2_time DOUBLE, fastest_sector3_time DOUBLE, avg_race_pace DOUBLE, "
        "estimated_positions_gained DOUBLE"
    ),
}


def gold_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(GOLD_SCHEMAS[table] + ", season INT, race_name STRING")


def as_gold(df: DataFrame, table: str) -> DataFrame:
    """Columns in the order and types of the gold table."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in gold_schema(table)])


def read_gold(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.schema(gold_schema(table)).parquet(f"{base}/{table}")


def register_gold(spark: SparkSession, base: str, database: str = DATABASE) -> None:
    """Create the external gold tables over ``base`` and discover their partitions."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}/{database}.db'")
    for table, columns in GOLD_SCHEMAS.items():
        name = f"{database}.{table}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({columns}, season INT, race_name STRING) USING parquet "
            f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{base}/{table}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {name}")


def add_partitions(spark: SparkSession, base: str, changes: DataFrame, database: str = DATABASE) -> None:
    """Tell the registered gold tables of refreshed races (season, race_name, change), without listing their folders again."""
    for table in GOLD_SCHEMAS:
        for r in changes.collect():  # races
            name = r["race_name"].replace("'", "''")
            spec = f"PARTITION (season={r['season']}, race_name='{name}')"
            verb = "DROP IF EXISTS" if r["change"] == "gone" else "ADD IF NOT EXISTS"
            spark.sql(f"ALTER TABLE {database}.{table} {verb} {spec}")
        spark.sql(f"REFRESH TABLE {database}.{table}")
