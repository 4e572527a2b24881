"""Gold tables kept up to date race by race.

Every race of the lap table has a digest, kept beside the gold tables. A refresh compares digests, computes the gold
tables from the laps of the new and changed races alone, and overwrites or removes their partitions; files of all other
races stay as they are. Digests are written last, so a refresh that fails is done again by the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.median import median_sketches
from ..operators.selection import keep_selected
from ..sources.catalog import GOLD_SCHEMAS, as_gold
from ..sources.sinks import remove_partitions, write_partitioned
from . import gold

RACE = ("season", "race_name")
DIGESTS = "race_digests"
SKETCHES = "median_sketches"
DIGEST_COLUMNS = "season int, race_name string, laps long, sum decimal(38,0), mix long"


def race_digests(laps: DataFrame, race: Sequence[str] = RACE) -> DataFrame:
    """(race, laps, sum, mix): equal for equal rows in any order, by two hashes of every column; combines map-side."""
    rest = sorted(c for c in laps.columns if c not in race)
    # A null leaves a hash as it is, so which columns are null is hashed too.
    held = F.xxhash64(*[F.col(c).isNull() for c in rest], *rest)
    other = F.xxhash64(F.lit("mix"), *reversed(rest), *[F.col(c).isNull() for c in rest])
    return laps.groupBy(*race).agg(
        F.count(F.lit(1)).alias("laps"), F.sum(held.cast("decimal(38,0)")).cast("decimal(38,0)").alias("sum"), F.bit_xor(other).alias("mix")
    )


def kept_digests(spark: SparkSession, base: str) -> DataFrame:
    """Digests of the last refresh; without one none."""
    try:
        return spark.read.schema(DIGEST_COLUMNS).parquet(f"{base}/{DIGESTS}")
    except AnalysisException:
        return spark.createDataFrame([], DIGEST_COLUMNS)


def changed_races(laps: DataFrame, known: DataFrame, race: Sequence[str] = RACE) -> DataFrame:
    """(race, change, digests): races that are "new", "changed" or "gone" since ``known``; a calendar's length at most."""
    now = race_digests(laps, race)
    before = known.select(*[F.col(c).alias(f"__{c}") for c in (*race, "laps", "sum", "mix")])
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in race]
    both = now.withColumn("__now", F.lit(True)).join(before.withColumn("__was", F.lit(True)), on, "full")
    alike = (F.col("laps") == F.col("__laps")) & (F.col("sum") == F.col("__sum")) & (F.col("mix") == F.col("__mix"))
    change = F.when(F.col("__was").isNull(), "new").when(F.col("__now").isNull(), "gone").when(~alike, "changed")
    keys = [F.coalesce(c, f"__{c}").alias(c) for c in race]
    return both.select(*keys, change.alias("change"), "laps", "sum", "mix").where("change is not null")


def refresh_gold(laps: DataFrame, base: str, tables: Sequence[str] = tuple(GOLD_SCHEMAS), medians: Sequence[str] = ()) -> DataFrame:
    """Bring the gold tables under ``base`` up to date with ``laps``; returns (season, race_name, change) of what was touched.

    ``laps`` should be laid out by race: only the touched races' files are then read a second time. ``medians`` names columns whose
    sketches are kept for ``sketched_medians``. Races without a season or name are not in any gold partition.
    """
    spark = laps.sparkSession
    found = changed_races(laps.where("season is not null and race_name is not null"), kept_digests(spark, base)).collect()  # races
    touched = spark.createDataFrame([tuple(r) for r in found], "season int, race_name string, change string, laps long, sum decimal(38,0), mix long")
    alive = touched.where("change <> 'gone'").drop("change")
    if found:
        chosen = keep_selected(laps, alive)
        frames = {name: as_gold(getattr(gold, name)(chosen), name) for name in tables}
        if medians:
            frames[SKETCHES] = median_sketches(chosen, medians, RACE)
        for name, frame in frames.items():
            path = f"{base}/{name}"
            # A race may have no row in a table, or none any more: what is left of it there is removed, the rest overwritten.
            filled = {tuple(r) for r in frame.select(*RACE).distinct().collect()}
            write_partitioned(frame, path, RACE, only_touched=True)
            remove_partitions(spark, path, RACE, [tuple(r[:2]) for r in found if tuple(r[:2]) not in filled])
        write_partitioned(alive, f"{base}/{DIGESTS}", RACE, only_touched=True)
        remove_partitions(spark, f"{base}/{DIGESTS}", RACE, [r[:2] for r in found if r["change"] == "gone"])
    return touched.select(*RACE, "change")
