"""Lap-time model: features, holdout, boosted trees, evaluation, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.boosting import Forest, fit_forest, importances

# Inputs in training order, holdout share, seed and tree settings.
LABELS = ["Compound", "Circuit", "Driver"]
NUMBERS = ["TyreLife", "LapNumber", "AirTemp", "TrackTemp", "Rainfall"]
HOLDOUT_PCT = 20
SEED = 42
TREES, LEARNING_RATE, DEPTH = 120, 0.08, 5

TARGET = "LapTime"
UNSEEN = -1.0


@dataclass
class LapModel:
    """Known labels of each label column in code order, and the trees over codes and numbers."""

    labels: dict[str, list[str]]
    forest: Forest

    def save(self, spark: SparkSession, path: str) -> None:
        self.forest.table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        known = [(c, i, label) for c, names in self.labels.items() for i, label in enumerate(names)]
        spark.createDataFrame(known, "input string, code int, label string").write.mode("overwrite").parquet(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LapModel:
        labels: dict[str, list[str]] = {c: [] for c in LABELS}
        for r in sorted(spark.read.parquet(f"{path}/labels").collect(), key=lambda r: (r["input"], r["code"])):
            labels[r["input"]].append(r["label"])
        return cls(labels, Forest.of_table(spark.read.parquet(f"{path}/nodes"), [*LABELS, *NUMBERS]))


def features(laps: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Model inputs and target under their training names, after any ``keep`` columns."""
    return laps.select(
        *keep,
        F.col("tyre_life").alias("TyreLife"),
        F.col("compound").alias("Compound"),
        F.col("lap_number").alias("LapNumber"),
        F.col("race_name").alias("Circuit"),
        F.col("driver").alias("Driver"),
        F.col("air_temp").alias("AirTemp"),
        F.col("track_temp").alias("TrackTemp"),
        F.col("rainfall").cast("double").alias("Rainfall"),
        F.col("lap_time_seconds").alias(TARGET),
    )


def holdout_bucket(keys: Sequence[str], seed: int = SEED) -> Column:
    """0..99 from the row's key. Unlike ``randomSplit`` it does not depend on
    partitioning, so a retried task puts every row on the same side."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100


def split(df: DataFrame, keys: Sequence[str], holdout_pct: int = HOLDOUT_PCT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(training rows, holdout rows)."""
    bucket = holdout_bucket(keys, seed)
    return df.where(bucket >= holdout_pct), df.where(bucket < holdout_pct)


def known_labels(train: DataFrame) -> dict[str, list[str]]:
    """Labels of each label column in code order, which is alphabetical; as many as there are distinct ones."""
    found = train.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in LABELS]).first()
    return {c: list(found[c]) for c in LABELS}


def coded(rows: DataFrame, labels: dict[str, list[str]]) -> DataFrame:
    """Labels as codes: unseen ones -1, missing ones missing. Numbers as they are."""

    def code(c: str) -> Column:
        if not labels[c]:
            return F.when(F.col(c).isNotNull(), F.lit(UNSEEN))
        places = F.create_map(*[F.lit(x) for i, label in enumerate(labels[c]) for x in (label, float(i))])
        return F.when(F.col(c).isNotNull(), F.coalesce(F.try_element_at(places, F.col(c)), F.lit(UNSEEN)))

    return rows.withColumns({c: code(c) for c in LABELS} | {c: F.col(c).cast("double") for c in NUMBERS})


def fit(train: DataFrame, trees: int = TREES, rate: float = LEARNING_RATE, depth: int = DEPTH, **settings) -> LapModel:
    """Fit on rows shaped by ``features``.

    The trees split label codes as ordered numbers, and a missing number goes to the side of each cut that wins
    more: no row with a target is left out.
    """
    labels = known_labels(train)
    return LapModel(labels, fit_forest(coded(train, labels), [*LABELS, *NUMBERS], TARGET, trees, rate, depth, **settings))


def predict(model: LapModel, rows: DataFrame) -> DataFrame:
    """Input columns and ``prediction``, one row for each input row."""
    given = {c: f"__given_{c}" for c in (*LABELS, *NUMBERS)}
    beside = rows.withColumns({name: F.col(c) for c, name in given.items()})
    scored = coded(beside, model.labels).withColumn("prediction", model.forest.prediction())
    return scored.select(*[F.col(given.get(c, c)).alias(c) for c in rows.columns], "prediction")


def evaluate(model: LapModel, holdout: DataFrame) -> DataFrame:
    """RMSE, MAE and R2 on rows with a known target, in one pass."""
    scored = predict(model, holdout.where(F.col(TARGET).isNotNull()))
    error = F.col("prediction") - F.col(TARGET)
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(TARGET))).alias("r2"),
        F.count(F.lit(1)).alias("rows"),
    )


def importance(model: LapModel, spark: SparkSession) -> DataFrame:
    """(feature, cuts, total_gain, importance), largest first, named in the order the trees saw the inputs."""
    return importances(model.forest.table(spark), model.forest.features)
