"""Pipeline over `documents`: classify, drop exact and near copies, mix the sources, pack the sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from stintwise.llm.common import documents, staged
from stintwise.llm.exact_dedup import LOWER, UPPER, exact_dedup
from stintwise.llm.mixing import mix_sources
from stintwise.llm.packing import pack_documents
from stintwise.llm.quality import score_quality, train_quality
from stintwise.llm.simhash import simhash_groups
from stintwise.llm.similar import similar_to_lower

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(docs: DataFrame, name: str) -> str:
    """``name``, with as many marks in front as it takes to differ from every column of ``docs``."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of 0.5 or more), null and empty texts by the constant term."""
    weights = train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free(docs, "score")
    return score_quality(docs, weights, score).where(F.col(score) >= 0.5).drop(score)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id; of repeated rows one. A null text is empty."""
    key, sha = _free(docs, "key"), _free(docs, "sha")
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    kept = exact_dedup(docs, is_table=True).where("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(key), F.col("text_sha256").alias(sha))
    rows = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), sha: F.sha2(text.cast("binary"), 256)})
    return rows.join(kept, [key, sha], "left_semi").dropDuplicates([key, sha]).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash the document with the smallest id; of those each but the ones alike to one with a smaller id.

    Alike: 0.8 or more of their five-word shingles are common, which SimHash at 4 bits does not always see. Documents without an id stay.
    """
    lowest = staged(simhash_groups(docs).where("doc_id = component_id").select(F.col("doc_id").alias("among_id")).distinct(), "pipeline-lowest")
    gone = similar_to_lower(docs, among=lowest)
    kept = lowest.join(gone, F.col("among_id") == F.col("similar_id"), "left_anti")
    own = docs["doc_id"].cast("long")
    # Rows without an id go by themselves, so that they need not meet in one task.
    return docs.where(own.isNotNull()).join(kept, own == kept["among_id"], "left_semi").unionByName(docs.where(own.isNull()))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice, by the nearest whole number.

    Rows that share an id, or have none, are taken as often as the one taken most of them. Texts without words go.
    """
    own, times, copy = (_free(docs, c) for c in ("own", "times", "copy"))
    taken = mix_sources(docs).where("taken > 0").select(F.col("doc_id").alias(own), F.round(F.col("taken") / F.col("size")).cast("int").alias(times))
    often = taken.where(F.col(times) > 0).groupBy(own).agg(F.max(times).alias(times))
    rows = docs.join(often, docs["doc_id"].cast("long").eqNullSafe(often[own]))
    return rows.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(copy)).drop(copy)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row a piece, with its token ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), window=2048, end=1)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("exact", exact), ("near", near), ("mixed", mixed), ("packed", packed)]

#: No SQL: the classifier, the fingerprints and the packing are beyond it; tests/llm hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each writes Parquet to the shared folder, which the next one reads."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
