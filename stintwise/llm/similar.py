"""Pairs of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Each text gets 80 min-hashes in 20 bands of four; texts that agree on a band are candidates (at similarity 0.8 a pair is
missed with a chance of 0.59 ** 20, by calculation 3 in 100,000) and every candidate is checked on the sets themselves. Only
texts with a candidate have their sets written, and those, not the texts, are joined to pairs.

The members of a band are checked against its least ids, and whoever is alike leaves, being settled by that: first against
one, then against more. What is still left after two rounds mostly shares a passage without being alike. It goes on under rarer
keys: with the shingles of all that is left in order of how many have them, alike sets share one of the rarest fifth of
either, so a shingle of a common passage is no key. No alike pair is lost by that. Each round checks against twice as many
ids of a key, until no key has two members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import byte_column, small_batches, staged
from .simhash import fingerprint_hashes

WORDS = 5
LEAST = 0.8
BANDS, DEEP = 20, 4
_draw = np.random.default_rng(17).integers(0, 1 << 63, (2, BANDS * DEEP)).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    return np.unique(np.array(fingerprint_hashes(text, words), np.uint64))


def band_keys(sets: list[np.ndarray]) -> list[list[int]]:
    """The band keys of each set; an empty set has none."""
    full = [i for i, s in enumerate(sets) if len(s)]
    bands: list[list[int]] = [[] for _ in sets]
    if full:
        whole = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        least = np.stack([np.minimum.reduceat(whole * a + b, starts) for a, b in zip(*_draw)], axis=1)
        for i, row in zip(full, least.astype("<u8")):
            bands[i] = [xxhash.xxh64_intdigest(r.tobytes(), j) - (1 << 63) for j, r in enumerate(row.reshape(BANDS, DEEP))]
    return bands


def jaccard(one: np.ndarray, two: np.ndarray) -> float:
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common / max(1, len(one) + len(two) - common)


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    raw, at = byte_column(batch.column("text"))
    data = raw.tobytes()
    return [shingles(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _prints(docs: DataFrame) -> DataFrame:
    """``id, bands, size`` of every text with a word; ``size`` is that of its set."""

    def run(batches):
        for batch in small_batches(batches, "text", 2 << 20):
            sets = _sets(batch)
            arrays = [batch.column("id"), pa.array(band_keys(sets), pa.list_(pa.int64())), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "bands", "size"])

    return docs.mapInArrow(run, "id long, bands array<long>, size long").where("size > 0")


def _written_sets(docs: DataFrame) -> DataFrame:
    """``id, shingles``: the sorted hashes of each text's set."""

    def run(batches):
        for batch in small_batches(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s.tobytes() for s in _sets(batch)], pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs ``a, b`` whose sets are alike."""

    def run(batches):
        for batch in batches:
            both = zip(batch.column("one").to_pylist(), batch.column("two").to_pylist())
            keep = [jaccard(np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)) >= least for one, two in both]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = sets.select(F.col("id").alias("i"), F.col("shingles").alias("one")), sets.select(F.col("id").alias("j"), F.col("shingles").alias("two"))
    held = pairs.join(one, F.col("a").eqNullSafe(F.col("i"))).join(two, F.col("b").eqNullSafe(F.col("j")))
    return held.select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def _crowded(members: DataFrame) -> DataFrame:
    """Members of keys that more than one id has."""
    several = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select(F.col("key").alias("own"))
    return members.join(several, F.col("key").eqNullSafe(F.col("own")), "left_semi")


def _first(members: DataFrame, most: int) -> DataFrame:
    """``own, firsts``: the ``most`` least ids of each key with their sizes. Each task keeps its own least few before they meet."""
    ranked = members.withColumn("nth", F.row_number().over(W.partitionBy("key").orderBy("id"))).where(F.col("nth") <= most)
    return ranked.groupBy(F.col("key").alias("own")).agg(F.collect_list(F.struct(F.col("id").alias("a"), F.col("size").alias("a_size"))).alias("firsts"))


def similar_to_lower(docs: DataFrame, least: float = LEAST, among: DataFrame | None = None) -> DataFrame:
    """``similar_id``: ids whose text is alike to one of a smaller id. Rows without an id, or without words, link nothing.

    ``among`` (``among_id``) names the ids that take part, all without it. Rows that share an id are one document with any of their texts. What stays holds no candidate pair that is alike; whatever goes is
    tied to one that stays by a chain of such pairs.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null")
    prints = _prints(given)  # small rows, so that texts need not move to be left out
    if among is not None:
        prints = prints.join(among, F.col("id") == F.col("among_id"), "left_semi")
    prints = staged(prints, "similar-prints")
    left = staged(_crowded(prints.select("id", "size", F.explode("bands").alias("key")).distinct()), "similar-bands")
    wanted = left.select(F.col("id").alias("near")).distinct()
    sets = staged(_written_sets(given.join(wanted, F.col("id") == F.col("near"), "left_semi")).dropDuplicates(["id"]), "similar-sets")
    gone, most, turn = None, 1, 0
    while left.take(1):
        firsts = _first(left, most)
        # Alike sets differ in size by the factor ``least`` at most.
        met = left.join(firsts, F.col("key").eqNullSafe(F.col("own")))
        close = F.filter("firsts", lambda f: (f["a"] < F.col("id")) & (f["a_size"] * least <= F.col("size")) & (F.col("size") * least <= f["a_size"]))
        # A member meets the same ids under several keys: together first, pairs after.
        of_member = met.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set(F.transform(close, lambda f: f["a"])))).alias("before"))
        pairs = of_member.select(F.explode("before").alias("a"), F.col("id").alias("b"))
        found = staged(_alike(pairs, sets, least).select(F.col("b").alias("similar_id")).distinct(), "similar-found")
        gone = found if gone is None else gone.unionByName(found)
        rest = met.where(~F.exists("firsts", lambda f: f["a"] == F.col("id"))).select("id", "size", "key")
        rest = rest.join(found, F.col("id") == F.col("similar_id"), "left_anti")
        if turn == 1:
            rest, most = _by_rare_shingles(rest.select("id").distinct(), sets, least), 0
        left, most, turn = staged(_crowded(rest), "similar-left"), (4 if turn == 0 else max(1, 2 * most)), turn + 1
    nothing = prints.limit(0).select(F.col("id").alias("similar_id"))
    return (gone if gone is not None else nothing).distinct()


def _by_rare_shingles(ids: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``id, size, key`` of the sets of ``ids``: the shingles that one of the set's alike partners must have too.

    Of ``size`` shingles, put in order by how many of the sets have them, an alike set has one of the first
    size - ceil(least * size) + 1. Shingles of one set alone fill places of that order and are no keys.
    """

    def run(batches):
        for batch in batches:
            for id, packed in zip(batch.column("id").to_pylist(), batch.column("shingles").to_pylist()):
                own = np.frombuffer(packed, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), id)), pa.array(np.full(len(own), len(own))), pa.array(own)], ["id", "size", "key"])

    wanted = sets.join(ids.select(F.col("id").alias("wanted")), F.col("id") == F.col("wanted"), "left_semi")
    tall = wanted.mapInArrow(run, "id long, size long, key long")
    shared = tall.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1").select(F.col("key").alias("own"), "sets")
    common = tall.join(shared, F.col("key").eqNullSafe(F.col("own"))).select("id", "size", "key", "sets")
    of_set = W.partitionBy("id")  # one set at a time
    placed = common.withColumns({"nth": F.row_number().over(of_set.orderBy("sets", "key")), "common": F.count("*").over(of_set)})
    alone = F.col("size") - F.col("common")
    return placed.where(F.col("nth") + alone <= F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1).select("id", "size", "key")
