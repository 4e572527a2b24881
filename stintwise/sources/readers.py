"""Reading lap tables."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

# Columns every raw lap table must have.
REQUIRED_RAW_COLUMNS = ["Driver", "LapNumber", "LapTime", "Compound", "TyreLife", "Position", "race_name"]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers as null. Files written elsewhere may carry NaN, which
    ``isNull`` and ``avg`` do not treat as missing."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_raw(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw Parquet files as one scan, columns matched by name.

    Nanosecond timestamps need ``spark.sql.legacy.parquet.nanosAsLong=true``
    in the session; they arrive as integers and cleaning converts them.
    """
    return nan_to_null(spark.read.option("mergeSchema", "true").parquet(*paths))


def race_file(base: str, season: int, race_name: str, prefix: str = "") -> str:
    return f"{base}/{prefix}{race_name.lower().replace(' ', '_')}_{season}.parquet"


def read_race(spark: SparkSession, base: str, season: int, race_name: str) -> DataFrame:
    """One race; a missing file is an error."""
    path = race_file(base, season, race_name)
    if path.rpartition("/")[2] not in _listed(spark, base):
        raise FileNotFoundError(f"no race file at {path}")
    return read_raw(spark, path)


def read_races(spark: SparkSession, base: str, races: Iterable[tuple[int, str]]) -> DataFrame:
    """All listed races that exist, as one scan; absent ones are reported and skipped.

    The folder is listed once, and the paths go to a single reader, so neither calls nor plan grow with the list.
    """
    there, found = _listed(spark, base), []
    for season, race_name in races:
        path = race_file(base, season, race_name)
        if path.rpartition("/")[2] in there:
            found.append(path)
        else:
            logger.warning("skipped %s %s: no file at %s", season, race_name, path)
    if not found:
        raise ValueError("none of the listed races could be read")
    return read_raw(spark, *found)


def _listed(spark: SparkSession, base: str) -> set[str]:
    """Names of the files and folders in ``base``, on whatever store it is; none where there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(base)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in store.listStatus(at)} if store.exists(at) else set()


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_RAW_COLUMNS) -> DataFrame:
    """The frame itself, or an error naming the columns it lacks; reads no data."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
