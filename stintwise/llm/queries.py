"""The operators as registered queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .exact_dedup import exact_dedup
from .language_id import detect_language
from .line_dedup import line_classes
from .mixing import mix_sources
from .nearest import nearest
from .packing import pack_documents
from .quality import quality_scores
from .repair import repaired_conversations
from .rules import quality_rules
from .simhash import hex_digits, simhash_groups
from .suffix_dedup import suffix_dedup
from .token_counts import token_counts
from .whitening import whiten

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(documents(spark, sf_dir), edits=2)


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), is_table=True)


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, most=2.0)


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_language(documents(spark, sf_dir))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), window=2048, end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(documents(spark, sf_dir))
    return groups.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=20, k=20)


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), most=8)


ORACLE: dict[str, str] = {
    "op4_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY t)""",
    "op5_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source
        ), w AS (
            SELECT *, [3.0, 1.0, 2.0][nth % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM s
        ), l AS (
            SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
                       - coalesce(sum(most) OVER (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY most / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM w
        ), t AS (
            SELECT source, source_size,
                   CASE WHEN most <= level * weight THEN most
                        ELSE least(most, (SELECT arg_min(level, (most / weight, nth)) FROM l WHERE most > level * weight) * weight) END AS target
            FROM l
        ), p AS (
            SELECT d.doc_id, d.size, t.source, t.source_size, t.target,
                   (sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ), b AS (
            SELECT greatest(1, least(4096, floor(sum(target) / (count(*) * 500))::BIGINT)) AS block,
                   sum(target) AS words, count(*) AS n_sources FROM t
        ), plan AS (
            SELECT source, source_size, floor(target)::BIGINT AS goal, block, -((-source_size) // block) AS per_pass, ceil(words / block)::BIGINT + n_sources AS n_slots,
                   coalesce(sum(target) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / words AS low
            FROM t, b WHERE source_size > 0
        ), need AS (
            SELECT *, lead(low, 1, 1.0::DOUBLE) OVER (ORDER BY source NULLS LAST) AS high,
                   goal // source_size * per_pass + ceil(goal % source_size / block::DOUBLE)::BIGINT AS need FROM plan
        ), points AS (
            SELECT slot, ((slot + 0.5::DOUBLE) * ((sqrt(5::DOUBLE) - 1) / 2)) % 1.0::DOUBLE AS point
            FROM (SELECT unnest(range(n_slots)) AS slot FROM (SELECT max(n_slots) AS n_slots FROM need))
        ), ranked AS (
            SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
            FROM points JOIN need ON low <= point AND point < high
        ), used AS (
            SELECT n.source, n.block, r.rank % n.per_pass AS place, coalesce(s.slot, n.n_slots) AS slot,
                   least(least(n.block, n.source_size - r.rank % n.per_pass * n.block), n.goal - (r.rank // n.per_pass * n.source_size + r.rank % n.per_pass * n.block)) AS take
            FROM (SELECT *, unnest(range(need)) AS rank FROM need) r JOIN need n ON n.source IS NOT DISTINCT FROM r.source
            LEFT JOIN ranked s ON s.source IS NOT DISTINCT FROM r.source AND s.rank = r.rank
        ), met AS (
            SELECT p.doc_id, p.size, p.source_size, p.target, p.start, min(u.slot) AS first_slot
            FROM p LEFT JOIN used u ON p.source IS NOT DISTINCT FROM u.source AND p.size > 0
              AND u.place BETWEEN p.start // u.block AND (p.start + p.size - 1) // u.block AND greatest(p.start - u.place * u.block, 0) < u.take
            GROUP BY ALL
        )
        SELECT doc_id, size, source_size, target,
               (greatest(0, least(start + size, floor(target)::BIGINT) - start)
                + greatest(0, least(start + size, floor(target)::BIGINT - source_size) - start))::BIGINT AS taken, first_slot::BIGINT AS first_slot
        FROM met""",
}
