"""Repeated substrings by blockwise suffix sorting with a difference cover.

A byte goes when a string of ``WIDTH`` bytes that covers it also starts in a document with a smaller id. Only
suffixes that can share ``WIDTH`` bytes with another document are sorted. Every such string holds a seed: the ``SEED``-byte
substring of least hash, which equal strings have in common. A first pass notes the seeds of every document and marks those met
in two documents or more in a bit table of fixed size (a full table only means that more suffixes are sorted). A second pass
cuts the text around marked seeds into runs of suffixes with one seed and deals them to blocks by that seed. Equal runs of
one part of the input meet before the shuffle: all but those of the smallest document are settled there, so a
passage found everywhere reaches its block once per part, not once per document.

A block is sorted by itself. Its suffixes agree for long stretches, so comparing them byte by byte is avoided:
the substrings at positions of a difference cover modulo 7 are ranked once, and for any two suffixes some shift below 7 puts both
on the cover. Suffixes are sorted, for each shift, by cover rank and the few bytes before and behind; in a class of
equal strings the smallest document keeps its copy. All comparisons are of bytes; hashes only deal out work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_column, small_batches

WIDTH = 50
SEED = 24
REACH = WIDTH - SEED + 1
COVER, MODULUS = (0, 1, 3), 7  # every difference modulo 7 is a difference of two of these
SAMPLE = WIDTH - MODULUS + 1
EDGE = MODULUS - 1
TABLE_BITS = 27
LONGEST_RUN = 64
NO_ID = np.iinfo(np.int64).max


def words_at(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number."""
    padded = np.r_[raw, np.zeros(8, np.uint8)]
    return np.ndarray((len(raw),), "<u8", padded, strides=(1,)).astype(np.uint64)


def least_seed(raw: np.ndarray) -> np.ndarray:
    """Hash of the seed of the string of WIDTH bytes at every position that has that many bytes behind it."""
    w = words_at(raw)[: len(raw) - SEED + 1 + 16]
    h = w[: len(raw) - SEED + 1] * np.uint64(0x9E3779B97F4A7C15)
    for i, factor in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9)):
        h ^= h >> np.uint64(32)
        h += w[i : i + len(h)]
        h *= np.uint64(factor)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    done = 1
    while done < REACH:
        step = min(done, REACH - done)
        h = np.minimum(h[:-step], h[step:])
        done += step
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)  # least hashes are small: spread them evenly again
    return h ^ (h >> np.uint64(32))


def seed_runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring suffixes with one seed: first position, number of suffixes, document, seed hash."""
    if len(raw) < WIDTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    seed = least_seed(raw)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = doc[: len(seed)] == doc[WIDTH - 1 :]
    change = np.r_[True, (seed[1:] != seed[:-1]) | (doc[1 : len(seed)] != doc[: len(seed) - 1]) | (whole[1:] != whole[:-1])]
    first = np.flatnonzero(change)
    size = np.diff(np.r_[first, len(seed)])
    keep = whole[first]
    return first[keep], size[keep], doc[first[keep]], seed[first[keep]]


def by_block(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Stretches of sorted ``hashes`` with the same leading bits."""
    lead = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]]) if len(lead) else np.zeros(0, np.int64)
    for first, last in zip(cut.tolist(), np.r_[cut[1:], len(lead)].tolist()):
        yield int(lead[first]), first, last


def marked_seeds(docs: DataFrame, bits: int) -> np.ndarray:
    """Bit table over leading hash bits: set where a seed occurs in more than one document."""

    def note(batches):
        seeds, owners, held, serial = [], [], 0, 0

        def flush():
            seed, owner = np.concatenate(seeds), np.concatenate(owners)
            order = np.lexsort((owner, seed))
            seed, owner = seed[order], owner[order]
            new = np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]])
            several = np.r_[owner[1:] != owner[:-1], False] & np.r_[seed[1:] == seed[:-1], False]
            twice = np.logical_or.reduceat(several, new) if len(new) else several
            value = np.repeat(seed[new], 1 + twice)  # a seed of several documents is sent twice
            rows = [(b, ((value[f:e] >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()) for b, f, e in by_block(value, bits)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["block", "seeds"])

        for batch in small_batches(batches, "text", 1 << 20):
            raw, at = byte_column(batch.column("text"))
            _, _, doc, seed = seed_runs(raw, at)
            seeds.append(seed)
            owners.append(doc + serial)
            serial, held = serial + batch.num_rows, held + len(seed)
            if held > 400_000:
                yield from flush()
                seeds, owners, held = [], [], 0
        if held:
            yield from flush()

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        value = np.sort(np.frombuffer(b"".join(group["seeds"]), "<u4"))
        both = value[1:][value[1:] == value[:-1]]
        fragment = np.zeros(1 << (TABLE_BITS - bits), bool)
        fragment[both >> np.uint32(32 - (TABLE_BITS - bits))] = True
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "fragment": [np.packbits(fragment).tobytes()]})

    noted = docs.select("text").mapInArrow(note, "block int, seeds binary").groupBy("block").applyInPandas(shared, "block int, fragment binary")
    table, size = np.zeros(1 << (TABLE_BITS - 3), np.uint8), 1 << (TABLE_BITS - bits - 3)
    for row in noted.toLocalIterator():  # the table as a whole has 2**TABLE_BITS bits, however much text there is
        table[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(bytes(row["fragment"]), np.uint8)
    return table


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document with those that touch made one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    base = doc.astype(np.int64) * 0
    _, base = np.unique(doc, return_inverse=True)
    reach = np.maximum.accumulate(end + base * (1 << 40)) - base * (1 << 40)
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])])
    return doc[new], start[new], np.maximum.reduceat(end, new)


RUNS = "block int, sizes binary, bytes binary, docs binary, owners binary, starts binary, known binary"


def pack(values: bytes | np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes())


def unpack(values: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(values), kind)


def cut_runs(table, bits: int):
    """Second pass: runs around marked seeds, dealt to blocks, and spans settled within this part."""

    def flush(held):
        text, size, owner, key, start, seed = (np.concatenate([h[i] for h in held]) if i else [r for h in held for r in h[0]] for i in range(6))
        code: dict[bytes, int] = {}
        own = np.fromiter((code.setdefault(r, len(code)) for r in text), np.int64, len(text))
        least = np.full(len(code), NO_ID)
        np.minimum.at(least, own, owner)
        known = owner > least[own]
        pair = np.stack([owner, key], axis=1)[known]
        docs, of = np.unique(pair, axis=0, return_inverse=True) if len(pair) else (pair, np.zeros(0, np.int64))
        d, s, e = merged(of.reshape(-1), start[known], start[known] + size[known] + WIDTH - 1)
        spans = np.stack([docs[d, 0], docs[d, 1], s, e], axis=1) if len(d) else np.zeros((0, 4), np.int64)
        send = np.flatnonzero(~known)
        send = send[np.argsort(seed[send], kind="stable")]
        stretches = list(by_block(seed[send], bits))
        parts = np.array_split(spans, max(1, len(stretches)))
        columns: list[list] = [[] for _ in range(7)]
        for (block, f, last), part in zip(stretches or [(0, 0, 0)], parts):
            at = send[f:last]
            here, of = np.unique(np.stack([owner[at], key[at]], axis=1), axis=0, return_inverse=True)
            row = (size[at].astype("u1"), b"".join([text[i] for i in at.tolist()]), here, of.astype("<u4"), start[at].astype("<i8"), part)
            columns[0].append(block)
            for column, value in zip(columns[1:], row):
                column.append(pack(value))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], RUNS.replace(" int", "").replace(" binary", "").split(", "))

    def run(batches):
        marks, held, n = table.value, [], 0
        for batch in small_batches(batches, "text", 1 << 20):
            raw, at = byte_column(batch.column("text"))
            first, size, doc, seed = seed_runs(raw, at)
            slot = seed >> np.uint64(64 - TABLE_BITS)
            near = (marks[slot >> np.uint64(3)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1
            first, size, doc, seed = (x[near.astype(bool)] for x in (first, size, doc, seed))
            parts = -(-size // LONGEST_RUN)
            of = np.repeat(np.arange(len(size)), parts)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
            first, size, doc, seed = first[of] + nth * LONGEST_RUN, np.minimum(LONGEST_RUN, size[of] - nth * LONGEST_RUN), doc[of], seed[of]
            data = raw.tobytes()
            text = [data[a:b] for a, b in zip(first.tolist(), (first + size + WIDTH - 1).tolist())]
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            held.append((text, size, ids[doc], batch.column("key").to_numpy()[doc], first - at[doc], seed))
            n += len(text)
            if n > 80_000:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return run


def class_least(raw: np.ndarray, start: np.ndarray, size: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix of the runs laid end to end in ``raw``: its run, and the smallest document with its first WIDTH bytes."""
    w = words_at(raw)
    run = np.repeat(np.arange(len(start)), size)
    at = start[run] + np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
    whole = np.zeros(len(raw), bool)
    for shift in range(MODULUS):
        whole[at + shift] = True
    cover = np.flatnonzero(whole & np.isin(np.arange(len(raw)) % MODULUS, COVER))
    keys = [w[np.minimum(cover + i, len(raw) - 1)] for i in (*range(0, SAMPLE - 7, 8), SAMPLE - 8)]
    order = np.lexsort(keys[::-1])
    differs = np.zeros(max(0, len(cover) - 1), bool)
    for k in keys:
        differs |= k[order][1:] != k[order][:-1]
    rank = np.zeros(len(raw), np.int64)
    rank[cover[order]] = np.r_[0, np.cumsum(differs)] if len(cover) else order
    least = owner[run].copy()
    for shift in range(MODULUS):
        mine = np.flatnonzero(np.isin((at + shift) % MODULUS, COVER))
        if not len(mine):
            continue
        p = at[mine]
        head, tail, middle = w[p] << np.uint64(64 - 8 * EDGE), w[p + WIDTH - 8] >> np.uint64(64 - 8 * EDGE), rank[p + shift]
        order = np.lexsort((tail, head, middle))
        same = lambda k: k[order][1:] == k[order][:-1]  # noqa: B023, E731
        new = np.flatnonzero(np.r_[True, ~(same(middle) & same(head) & same(tail))])
        low = np.minimum.reduceat(owner[run[mine[order]]], new)
        low = np.repeat(low, np.diff(np.r_[new, len(order)]))
        least[mine[order]] = np.minimum(least[mine[order]], low)
    return run, least


def run_seeds(texts: list[bytes], size: np.ndarray, part: int = 8192) -> np.ndarray:
    """Seed hash of each run, a part of the runs at a time."""
    out = [np.zeros(0, np.uint64)]
    for f in range(0, len(texts), part):
        n = size[f : f + part] + WIDTH - 1
        out.append(least_seed(np.frombuffer(b"".join(texts[f : f + part]), np.uint8))[np.cumsum(n) - n])
    return np.concatenate(out)


def sorted_runs(texts: list[bytes], size: np.ndarray, owner: np.ndarray, part: int = 16_384):
    """Suffixes that a smaller document has too, as (run, place in the run), one bucket of seeds after another.

    Equal suffixes have equal seeds, so a run alone with its seed needs no sorting and buckets end between seeds.
    """
    seed = run_seeds(texts, size)
    order = np.argsort(seed, kind="stable")
    _, alike = np.unique(seed[order], return_counts=True)
    cuts = [0]
    unlike = order[np.repeat(alike, alike) > 1]
    ends = np.cumsum(alike[alike > 1])
    while cuts[-1] < len(unlike):
        at = min(len(ends) - 1, int(np.searchsorted(ends, cuts[-1] + part)))
        cuts.append(int(ends[at]))
    for f, e in zip(cuts, cuts[1:]):
        chosen = unlike[f:e]
        n = size[chosen]
        raw = np.frombuffer(b"".join([texts[i] for i in chosen.tolist()]), np.uint8)
        run, least = class_least(raw, np.cumsum(n + WIDTH - 1) - (n + WIDTH - 1), n, owner[chosen])
        gone = np.flatnonzero(least < owner[chosen][run])
        yield chosen[run[gone]], gone - (np.cumsum(n) - n)[run[gone]]


SPANS = "doc_id long, key long, start long, end long"


def sort_block(group: pa.Table) -> pa.Table:
    """Spans to remove, from the runs of one block and from what was settled before."""
    parts = lambda name, kind: [unpack(x, kind) for x in group.column(name).to_pylist()]
    size, raw, start = (np.concatenate(parts(name, kind)) for name, kind in (("sizes", "u1"), ("bytes", "u1"), ("starts", "<i8")))
    docs = [d.reshape(-1, 2)[of] for d, of in zip(parts("docs", "<i8"), parts("owners", "<u4"))]
    size, (owner, key) = size.astype(np.int64), np.concatenate(docs).T
    out = [np.concatenate(parts("known", "<i8")).reshape(-1, 4)]
    if len(size):
        end = np.cumsum(size + WIDTH - 1)
        data, code = raw.tobytes(), {}
        first_of: list[int] = []
        own = np.zeros(len(size), np.int64)
        for i, (a, b) in enumerate(zip((end - size - WIDTH + 1).tolist(), end.tolist())):
            c = code.setdefault(data[a:b], len(code))
            if c == len(first_of):
                first_of.append(i)
            own[i] = c
        least = np.full(len(code), NO_ID)
        np.minimum.at(least, own, owner)
        later = np.flatnonzero(owner > least[own])
        out.append(np.stack([owner[later], key[later], start[later], start[later] + size[later] + WIDTH - 1], axis=1))
        texts = list(code)
        n = size[np.array(first_of)]
        found = list(sorted_runs(texts, n, least))
        if any(len(r) for r, _ in found):
            run, nth = (np.concatenate([x[i] for x in found]) for i in (0, 1))
            r, s, e = merged(run, nth, nth + WIDTH)
            keepers = np.flatnonzero(owner == least[own])  # the smallest document may hold a run more than once
            keepers = keepers[np.argsort(own[keepers], kind="stable")]
            f, t = np.searchsorted(own[keepers], r, "left"), np.searchsorted(own[keepers], r, "right")
            of = np.repeat(np.arange(len(r)), t - f)
            who = keepers[np.repeat(f, t - f) + np.arange(len(of)) - np.repeat(np.cumsum(t - f) - (t - f), t - f)]
            out.append(np.stack([owner[who], key[who], start[who] + s[of], start[who] + e[of]], axis=1))
    spans = np.concatenate(out)
    return pa.Table.from_arrays([pa.array(np.ascontiguousarray(spans[:, i])) for i in range(4)], ["doc_id", "key", "start", "end"])


def remove_spans(batches):
    """Documents with their spans to what is left of them."""
    for batch in small_batches(batches, "text"):
        raw, at = byte_column(batch.column("text"))
        n_removed, n_spans, kept = [], [], []
        for a, b, spans in zip(at[:-1].tolist(), at[1:].tolist(), batch.column("spans").to_pylist()):
            text = raw[a:b]
            if spans:
                pairs = np.array([(s["start"], s["end"]) for s in spans], np.int64)
                _, s, e = merged(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
                stay = np.cumsum(np.bincount(s, minlength=len(text) + 1) - np.bincount(e, minlength=len(text) + 1))[:-1] == 0
                text = text[stay]
            n_spans.append(len(s) if spans else 0)
            n_removed.append(b - a - len(text))
            kept.append(text.tobytes())
        arrays = [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame, block_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) for every row of ``docs``.

    Null and empty texts have nothing to remove. The smallest document that holds a string keeps it; of rows that share
    an id none is smaller. A row without an id is larger than all others, and two such rows are not compared. Texts under 50
    bytes stay whole. ``block_bytes`` of text set the number of blocks, so a block is as large at any size.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(6, math.ceil(math.log2(max(1, total) / block_bytes))))
    table = spark.sparkContext.broadcast(marked_seeds(rows, bits))
    runs = rows.mapInArrow(cut_runs(table, bits), RUNS)
    spans = runs.groupBy("block").applyInArrow(sort_block, SPANS)
    each = spans.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("k")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    same = F.coalesce(rows["doc_id"], F.lit(int(NO_ID))) == each["id"]
    joined = rows.join(each, same & (rows["key"] == each["k"]), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove_spans, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
