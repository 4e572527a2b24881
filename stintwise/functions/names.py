"""Column-name and file-name conventions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A boundary before a capitalised word, then one before any other capital.
WORD_BOUNDARY = r"(.)([A-Z][a-z]+)"
CAPITAL_BOUNDARY = r"([a-z0-9])([A-Z])"


def snake_name(name: str) -> str:
    for boundary in (WORD_BOUNDARY, CAPITAL_BOUNDARY):
        name = re.sub(boundary, r"\1_\2", name)
    return name.lower()


def snake_value(text: Column) -> Column:
    """The same rule for the values of a string column."""
    for boundary in (WORD_BOUNDARY, CAPITAL_BOUNDARY):
        text = F.regexp_replace(text, boundary, "$1_$2")
    return F.lower(text)


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case; metadata only."""
    return df.withColumnsRenamed({c: snake_name(c) for c in df.columns})


def race_slug(race: Column, season: Column, prefix: str = "") -> Column:
    """``[prefix]race_name_in_lower_case_2023`` as used for per-race outputs."""
    name = F.replace(F.lower(race), F.lit(" "), F.lit("_"))
    return F.concat(F.lit(prefix), name, F.lit("_"), season.cast("string"))


def race_label(season: Column, race: Column) -> Column:
    """``2023 - Race``."""
    return F.concat(season.cast("string"), F.lit(" - "), race)


def label_season(label: Column) -> Column:
    return F.split(label, " - ", 2)[0].cast("int")


def label_race(label: Column) -> Column:
    return F.split(label, " - ", 2)[1]
