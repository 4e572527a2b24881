"""Exact duplicates by most-significant-byte-first radix partitioning, without a digest.

Texts are split by successive bytes. A round takes the next digit (a run of bytes) of every text
still undecided and counts the groups that agree on all digits so far. A group of one is decided,
a group whose texts end within the digit holds equal texts and is decided; the others go on with
what follows the digit. Digits widen from round to round, so the number of rounds is logarithmic in
the longest shared text. Counts combine before the shuffle; the join that hands them back to the rows
has an exchange of its own on both sides, so a group that holds a third of all rows is split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def exact_dedup(docs: DataFrame, first_digit: int = 64, widening: int = 16, is_table: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null is the empty text, so null and empty
    texts are one group. The largest ``doc_id`` of a group stays; a null id is smaller than any other.
    Of repeated rows that tie for it exactly one is kept. Extra columns are ignored. ``is_table`` says that ``docs`` is read
    straight from files, in which rows stand alike each time; anything else is written first, since rows are numbered.
    """
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"), F.monotonically_increasing_id().alias("row")).select(
        "doc_id", "row", F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"), F.lit(0).cast("long").alias("group"), F.col("t").cast("binary").alias("rest")
    )
    if not is_table:  # the numbers are read more than once below
        rows = staged(rows, "radix-texts")
    decided, width = [], first_digit
    while True:
        keys = ["group", "digit", "ended"]
        rows = rows.withColumns({"digit": F.substring("rest", 1, width), "ended": F.length("rest") <= width})
        groups = staged(
            rows.groupBy(*keys)
            .agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "row")).alias("keep"))
            .where("size > 1")
            .withColumn("next", F.monotonically_increasing_id()),
            "radix-groups",
        )
        joined = rows.join(groups.hint("merge"), keys, "left")  # the groups grow with the table: no size to broadcast by
        own = F.struct("doc_id", "row")
        undecided = (F.col("size") > 1) & ~F.col("ended")
        out = joined.select(
            "doc_id", "row", "text_sha256", undecided.alias("open"), F.coalesce("size", F.lit(1)).alias("group_size"), F.coalesce("keep", own).alias("keep"),
            F.col("next").alias("group"), F.when(undecided, F.substring("rest", width + 1, 2**31 - 1)).alias("rest"),
        )
        if groups.where("not ended").isEmpty():
            decided.append(out)
            break
        out = staged(out.withColumn("open", F.coalesce("open", F.lit(False))), "radix-rows")
        decided.append(out.where("not open"))
        rows, width = out.where("open").select("doc_id", "row", "text_sha256", "group", "rest"), width * widening
    every = reduce(DataFrame.unionByName, [d.select("doc_id", "row", "keep", "group_size", "text_sha256") for d in decided])
    return every.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("keep.row") == F.col("row")).alias("kept"), "text_sha256")
