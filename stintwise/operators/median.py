"""Exact medians of many columns without gathering their values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_ROWS = 1_000_000
"""Rows of a column that may be put in order by one task."""

SKETCH_K = 1024  # items of a sketch; ranks are within about a third of a percent
SALTS = 256  # groups in which sketches merge before they merge into one
STEPS = 200  # quantiles read from a sketch; the cuts lie two steps below and above the median
BRACKET = "column string, lo double, hi double, below long, n long"


def _inside(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """Values with the bracket of their column, those above it left out."""
    # One row per listed column.
    return values.join(F.broadcast(brackets), "column").where(F.col("value") <= F.col("hi"))


def _cuts(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """Two values around the median of each bracketed column, by sketches of a fixed size merged in two levels."""
    within = _inside(values, brackets).where(F.col("value") >= F.col("lo"))
    salted = within.groupBy("column", (F.spark_partition_id() % SALTS).alias("salt")).agg(
        F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"), F.count(F.lit(1)).alias("rows")
    )
    merged = salted.groupBy("column").agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"), F.sum("rows").alias("rows"))
    share = ((F.col("n") + 1) / 2 - F.col("below")) / F.col("rows")
    quantiles = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    at = F.floor(share * STEPS).cast("int") + 1
    low, high = (F.element_at("quantiles", F.least(F.lit(STEPS + 1), F.greatest(F.lit(1), at + d))) for d in (-2, 3))
    placed = merged.join(F.broadcast(brackets), "column").withColumn("quantiles", quantiles)
    return placed.select("column", low.alias("cut_lo"), high.alias("cut_hi"))


def _cells(values: DataFrame, brackets: DataFrame) -> list:
    """Rows, least and greatest value of each column below, between and above its cuts."""
    cell = F.when(F.col("value") < F.col("cut_lo"), 0).when(F.col("value") <= F.col("cut_hi"), 1).otherwise(2)
    within = _inside(values, brackets).where(F.col("value") >= F.col("lo"))
    counted = within.groupBy("column", cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    return counted.withColumn("alike", F.col("lo") == F.col("hi")).orderBy("column", "cell").collect()


def _narrowed(bracket: dict, cells: list) -> dict:
    """The cells that hold the two middle ranks. Counts decide, so a bad cut costs a round and never the answer."""
    low, high = (bracket["n"] + 1) // 2, (bracket["n"] + 2) // 2
    upto, held = bracket["below"], []
    for c in cells:
        if upto < high and upto + c["rows"] >= low:
            held.append((upto, c))
        upto += c["rows"]
    first, last = held[0], held[-1]
    alike = len(held) == 1 and first[1]["alike"]
    return bracket | {"lo": first[1]["lo"], "hi": last[1]["hi"], "below": first[0], "rows": sum(c["rows"] for _, c in held), "alike": alike}


def exact_medians(df: DataFrame, columns: Sequence[str], most_rows: int = MOST_ROWS) -> DataFrame:
    """(column, median) for each column with a known value, interpolated; NaN counts as the largest.

    Each column has a bracket of values around its median, at first all of them, and the exact count of rows
    below. While it holds more than ``most_rows`` rows (and more than one value), two cuts from a sketch split it in three, the parts
    are counted and the one with the middle rank is the next bracket, a few hundredths of the last. What is left is put in
    order as distinct values. Counts and sketches combine map-side; the driver sees a few numbers per column.
    """
    spark = df.sparkSession
    numbers = df.select([F.col(c).cast("double").alias(c) for c in columns])
    values = numbers.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    sizes = numbers.agg(*[F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), (F.min(c) == F.max(c)).alias("alike")).alias(c) for c in columns]).first()
    state = {c: sizes[c].asDict() | {"column": c, "below": 0, "rows": sizes[c]["n"]} for c in columns if sizes[c]["n"]}

    def table(columns_: list) -> DataFrame:
        rows = [(s["column"], s["lo"], s["hi"], s["below"], s["n"]) for s in columns_]
        return spark.createDataFrame(rows, BRACKET)

    while wide := [s for s in state.values() if s["rows"] > most_rows and not s["alike"]]:
        brackets = table(wide)
        cut = spark.createDataFrame(_cuts(values, brackets).collect(), "column string, cut_lo double, cut_hi double")
        cells = _cells(values, brackets.join(cut, "column"))
        before = [(s["lo"], s["hi"]) for s in wide]
        for s in wide:
            state[s["column"]] = _narrowed(s, [c for c in cells if c["column"] == s["column"]])
        if before == [(state[s["column"]]["lo"], state[s["column"]]["hi"]) for s in wide]:
            break  # cuts at both ends: the rest is ordered as it is, by few distinct values
    brackets = table(list(state.values()))
    within = _inside(values, brackets).where(F.col("value") >= F.col("lo"))
    counted = within.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    upwards = Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("sum", F.sum("rows").over(upwards)).join(F.broadcast(brackets), "column")
    ranked = summed.withColumn("upto", F.col("below") + F.col("sum"))
    low, high = F.floor((F.col("n") + 1) / 2), F.ceil((F.col("n") + 1) / 2)
    picked = ranked.groupBy("column").agg(
        F.min(F.when(F.col("upto") >= low, F.col("value"))).alias("a"), F.min(F.when(F.col("upto") >= high, F.col("value"))).alias("b")
    )
    return picked.select("column", ((F.col("a") + F.col("b")) / 2).alias("median"))


def median_sketches(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, column, sketch, n): a sketch of a fixed size for each part of the table and column with a known value.

    Kept beside the table, so that when a part changes only its own sketches are made anew (see ``sketched_medians``).
    """
    numbers = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    values = numbers.unpivot(list(keys), list(columns), "column", "value").where(F.col("value").isNotNull())
    return values.groupBy(*keys, "column").agg(F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def sketched_medians(sketches: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, median, n) from kept sketches, without the rows: the approximate form of ``exact_medians``.

    The value's rank is within about a third of a percent of the middle; sketches merge in two levels.
    """
    wanted = sketches if columns is None else sketches.where(F.col("column").isin(list(columns)))
    salted = wanted.groupBy("column", (F.spark_partition_id() % SALTS).alias("salt")).agg(
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"), F.sum("n").alias("n")
    )
    merged = salted.groupBy("column").agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"), F.sum("n").alias("n"))
    return merged.select("column", F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median"), "n")
