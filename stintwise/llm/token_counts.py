"""Token counts by a two-tier lookup of pre-token lengths, without moving a pre-token.

The model is a BPE over pieces in which a space mark only ever stands at the start of a word and
a line break is a piece of its own, so a text falls into pre-tokens (spaces with the word behind
them, runs of spaces, line breaks) whose token counts add up to that of the text. One pass keeps
the heavy hitters of each task in a summary of bounded size; summaries are merged as a tree, and
the lengths of the most frequent pre-tokens are broadcast as one table of ``frequent`` entries.
Each worker looks up there first; a miss goes to the worker's own bounded cache, which asks the
library once. Both tiers only save time: the counts are the library's for every text.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts_of

PRE_TOKEN = re.compile(r"\n+| *[^ \n]+| +")
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def pre_tokens(text: str) -> list[str]:
    """Pieces of a text whose token counts add up; the mark U+2581 is a space to the model."""
    return PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


class Misses(dict):
    """Worker cache of lengths that the broadcast table lacks; emptied when full."""

    def __init__(self, path: str, most: int):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.most = most
        self.lead = len(self.model.encode("\n"))

    def length(self, pre_token: str) -> int:
        return len(self.model.encode("\n" + pre_token)) - self.lead

    def __missing__(self, pre_token: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self[pre_token] = self.length(pre_token)
        return n


class Frequent(dict):
    """First tier: the broadcast lengths; what it lacks is asked of the second."""

    def __init__(self, lengths: dict[str, int], misses: Misses):
        super().__init__(lengths)
        self.misses = misses

    def __missing__(self, pre_token: str) -> int:
        return self.misses[pre_token]


_misses: dict[tuple, Misses] = {}


def worker_misses(path: str, most: int) -> Misses:
    if (path, most) not in _misses:
        _misses[path, most] = Misses(path, most)
    return _misses[path, most]


def heavy_hitters(most: int):
    """Partition to one pickled summary of at most ``most`` pre-tokens with counts."""

    def run(batches):
        seen: Counter = Counter()
        for batch in small_batches(batches, "text"):
            for text in texts_of(batch):
                seen.update(pre_tokens(text))
            if len(seen) > 8 * most:
                seen = Counter(dict(seen.most_common(most)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(seen.most_common(most))], pa.binary())], ["summary"])

    return run


def merged(most: int):
    def run(a: list, b: list) -> list:
        both = Counter(dict(a))
        for pre_token, n in b:
            both[pre_token] += n
        return both.most_common(most)

    return run


def frequent_pre_tokens(docs: DataFrame, most: int) -> list[tuple[str, int]]:
    """Heavy hitters over all texts; every summary on the way holds at most ``most`` entries."""
    summaries = docs.select("text").mapInArrow(heavy_hitters(most), "summary binary")
    return summaries.rdd.map(lambda r: pickle.loads(r.summary)).treeAggregate([], merged(most), merged(most), depth=3)


def token_counts(docs: DataFrame, path: str, limit: int = 4096, frequent: int = 16384, cache: int = 300_000) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; other columns of ``docs`` are ignored.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted again each. A null id
    stays null. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path_here = Misses(path, cache)
    table = {p: path_here.length(p) for p, _ in frequent_pre_tokens(docs, frequent)}
    shared = spark.sparkContext.broadcast(table)

    def run(batches):
        length = Frequent(shared.value, worker_misses(path, cache)).__getitem__
        for batch in small_batches(batches, "text"):
            texts = texts_of(batch)
            counts = [sum(map(length, pre_tokens(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes")).alias("doc_id"), "text").mapInArrow(
        run, "doc_id struct<doc_id:long,n_bytes:long>, n_tokens long"
    )
    return counted.select("doc_id.doc_id", "doc_id.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
