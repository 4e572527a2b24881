"""Data-quality measures over any table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
KNOWN_COMPOUNDS = ["SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "UNKNOWN"]
LAP_KEYS = ("race_name", "driver", "lap_number")
LONGEST_LAP_SECONDS = 300.0


def _missing(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_percentages(df: DataFrame) -> DataFrame:
    """(column_name, null_pct) for every column, in one pass."""
    share = [
        (F.avg(F.when(_missing(f), 1.0).otherwise(0.0)) * 100).alias(f.name)
        for f in df.schema
    ]
    return df.agg(*share).unpivot([], df.columns, "column_name", "null_pct")


def duplicate_rows(df: DataFrame, keys: Sequence[str] = LAP_KEYS) -> DataFrame:
    """How many rows share their key with another; rows with a null key are left out."""
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"))


def out_of_range(col: str, above: float = 0.0, upto: float = LONGEST_LAP_SECONDS) -> Column:
    """True at or below ``above`` and beyond ``upto``; a missing value is not out of range."""
    return (F.col(col) <= above) | (F.col(col) > upto)


def invalid_values(df: DataFrame, col: str = "lap_time_seconds", above: float = 0.0, upto: float = LONGEST_LAP_SECONDS) -> DataFrame:
    return df.agg(F.count(F.when(out_of_range(col, above, upto), 1)).alias("invalid_rows"))


def invalid_categories(df: DataFrame, col: str = "compound", known: Sequence[str] = KNOWN_COMPOUNDS) -> DataFrame:
    """Distinct labels outside the known list, compared in upper case, shown as they are."""
    label = F.col(col).cast("string")
    return df.where(label.isNotNull() & ~F.upper(label).isin(list(known))).select(label.alias(col)).distinct()


def quality_rows(
    df: DataFrame, keys: Sequence[str] = LAP_KEYS, value: str = "lap_time_seconds", category: str = "compound"
) -> DataFrame:
    """The whole report as (measure, item, value) rows.

    One pass serves row count, range check and null shares; duplicates and
    labels each add an aggregate of their own. Checks whose column is absent
    report nothing wrong.
    """
    single = df.agg(
        F.count(F.lit(1)).cast("double").alias("row_count"),
        F.lit(float(len(df.columns))).alias("column_count"),
        (F.count(F.when(out_of_range(value), 1)) if value in df.columns else F.lit(0)).cast("double").alias("invalid_lap_times"),
        *[(F.avg(F.when(_missing(f), 1.0).otherwise(0.0)) * 100).alias(f"null_percentages/{f.name}") for f in df.schema],
    )
    tall = single.unpivot([], single.columns, "name", "value")
    split = F.split("name", "/", 2)
    report = tall.select(split[0].alias("measure"), F.get(split, F.lit(1)).alias("item"), "value")
    repeats = duplicate_rows(df, keys).select(
        F.lit("duplicate_laps").alias("measure"), F.lit(None).cast("string").alias("item"),
        F.col("duplicate_rows").cast("double").alias("value"),
    )
    report = report.unionByName(repeats)
    if category in df.columns:
        report = report.unionByName(
            invalid_categories(df, category).select(
                F.lit("invalid_tire_compounds").alias("measure"), F.col(category).alias("item"),
                F.lit(None).cast("double").alias("value"),
            )
        )
    return report


def quality_document(rows: DataFrame) -> DataFrame:
    """The report as one nested record, for a JSON sink.

    Its size follows the number of columns and of distinct wrong labels.
    """
    def number(measure: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col("value"))).cast("long").alias(measure)

    is_null_share = F.col("measure") == "null_percentages"
    return rows.agg(
        number("row_count"), number("column_count"), number("duplicate_laps"), number("invalid_lap_times"),
        F.sort_array(F.collect_list(F.when(F.col("measure") == "invalid_tire_compounds", F.col("item")))).alias("invalid_tire_compounds"),
        F.map_from_entries(F.collect_list(F.when(is_null_share, F.struct("item", "value")))).alias("null_percentages"),
    )


def measured(
    df: DataFrame, value: str = "lap_time_seconds", category: str = "compound", known: Sequence[str] = KNOWN_COMPOUNDS
) -> tuple[DataFrame, Observation]:
    """(``df``, what is observed of its rows while they are used): all of ``quality_rows`` but the duplicates.

    The observation is complete when one action over the returned frame is. Wrong labels are kept as a set, which grows
    with the number of distinct ones, as in the report.
    """
    seen = Observation()
    label = F.col(category).cast("string") if category in df.columns else F.lit(None).cast("string")
    wrong = F.when(~F.upper(label).isin(list(known)), label)
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        (F.count(F.when(out_of_range(value), 1)) if value in df.columns else F.sum(F.lit(0))).alias("invalid_lap_times"),
        F.collect_set(wrong).alias("invalid_tire_compounds"),
        *[F.count(F.when(_missing(f), 1)).alias(f"missing/{f.name}") for f in df.schema],
    ), seen


def measured_rows(df: DataFrame, figures: dict) -> DataFrame:
    """The figures of ``measured`` as (measure, item, value) rows, like those of ``quality_rows``."""
    n = figures["row_count"]
    rows = [("row_count", None, float(n)), ("column_count", None, float(len(df.columns))), ("invalid_lap_times", None, float(figures["invalid_lap_times"] or 0))]
    rows += [("null_percentages", c, figures[f"missing/{c}"] * 100.0 / n if n else None) for c in df.columns]
    rows += [("invalid_tire_compounds", label, None) for label in sorted(figures["invalid_tire_compounds"])]
    return df.sparkSession.createDataFrame(rows, "measure string, item string, value double")
