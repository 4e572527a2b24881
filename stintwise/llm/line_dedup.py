"""Near-duplicate lines by a segment-partition edit join.

Lines at most ``edits`` edits apart: cut the shorter into ``edits + 1`` even segments, and one of them occurs in the
longer unchanged, near where it would stand. So each distinct line is indexed under its own segments (key: its length, the
segment's number and text) and probed with the substrings that could match a segment of a line up to ``edits`` shorter,
within the places that an alignment on both sides allows. A first pass marks keys that two lines may share in a bit table
of fixed size (a full table only lets more through). The marked entries are sorted by key over range
partitions; a run of one key is compared by itself, in tiles when it is long or cut by a partition's edge. Pairs are
verified by a bit-parallel automaton over the band of diagonals within reach. Exact copies of a line are one line throughout.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged
from .components import connected_components

TABLE_BITS = 28
TILE = 512
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Substrings:
    """Hashes of any substrings of many lines, from one running sum over all their characters."""

    def __init__(self, lines: list[str]):
        chars = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(np.uint64)
        n = np.fromiter(map(len, lines), np.int64, len(lines))
        self.length, self.at = n, np.cumsum(n) - n
        grown = np.cumprod(np.r_[np.uint64(1), np.full(len(chars), BASE)])
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(len(chars), INVERSE)])
        self.sums = np.r_[np.uint64(0), np.cumsum(mixed(chars + np.uint64(1)) * grown[:-1])]

    def key(self, line: np.ndarray, start: np.ndarray, size: np.ndarray, length: np.ndarray, number: int) -> np.ndarray:
        s = self.at[line] + start
        own = (self.sums[s + size] - self.sums[s]) * self.back[s]
        return mixed(mixed(own) + length.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(number + 1) * np.uint64(0x165667B19E3779F9))


def segment(length: np.ndarray, number: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of a segment of lines of that length, the longer segments last."""
    short, long = length // (edits + 1), length % (edits + 1)
    return number * short + np.maximum(0, number - (edits + 1 - long)), short + (number >= edits + 1 - long)


def entries(lines: list[str], edits: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, line and kind (1: index, 0: probe) of every entry of the lines that have ``least`` characters."""
    table = Substrings(lines)
    line = np.flatnonzero(table.length >= least)
    length, out = table.length[line], []
    for number in range(edits + 1):
        start, size = segment(length, number, edits)
        out.append((table.key(line, start, size, length, number), line, np.ones(len(line), np.int8)))
        for fewer in range(edits + 1):
            other = length - fewer
            p, size = segment(other, number, edits)
            low = np.maximum(np.maximum(0, p - number), p + fewer - (edits - number))
            high = np.minimum(np.minimum(length - size, p + number), p + fewer + (edits - number))
            for step in range(2 * edits + 1):
                start = low + step
                ok = (start <= high) & (other >= least) & ~((fewer == 0) & (start == p))
                if ok.any():
                    out.append((table.key(line[ok], start[ok], size[ok], other[ok], number), line[ok], np.zeros(int(ok.sum()), np.int8)))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def within(a: str, b: str, edits: int) -> bool:
    """Whether two strings are at most ``edits`` edits apart.

    Bit e of ``state[d]`` says that the first j + e - edits characters of ``a`` turn into the first j of ``b`` with d edits.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    band = (1 << (2 * edits + 1)) - 1
    state = [sum(1 << (e + edits) for e in range(min(d, len(a)) + 1)) for d in range(edits + 1)]
    for j, c in enumerate(b):
        same = 0
        for e in range(-edits, edits + 1):
            if 0 <= j + e < len(a) and a[j + e] == c:
                same |= 1 << (e + edits)
        inside = band
        if j + 1 < edits:
            inside &= band << (edits - j - 1)
        if j + 1 + edits > len(a):
            inside &= (1 << max(0, len(a) - j + edits)) - 1
        before, now = 0, 0
        for d in range(edits + 1):
            held = state[d]
            reached = held & same
            if d:
                reached |= before | (before >> 1) | (now << 1)
            before, now = held, reached & inside
            state[d] = now
        if not now:
            return False
    return bool(state[edits] >> (len(a) - len(b) + edits) & 1)


def trimmed(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How many leading and how many further trailing characters two lines share."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    differ = a[:n] != b[:n]
    head = int(differ.argmax()) if differ.any() else n
    differ = a[len(a) - n :][::-1] != b[len(b) - n :][::-1]
    tail = int(differ.argmax()) if differ.any() else n
    return head, min(tail, n - head)


class Lines:
    """Lines of a tile as text and as characters."""

    def __init__(self, ids: np.ndarray, kinds: np.ndarray, texts: list[str]):
        order = np.lexsort((-kinds, ids))
        first = order[np.r_[True, ids[order][1:] != ids[order][:-1]]] if len(order) else order
        self.ids, self.kinds = ids[first], kinds[first]
        self.texts = [texts[i] for i in first.tolist()]
        self.chars = [np.frombuffer(t.encode("utf-32-le"), "<u4") for t in self.texts]
        self.lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))

    def linked(self, other: Lines, edits: int) -> list[tuple[int, int]]:
        """Pairs of different lines within reach, at least one of which stands here by its own segment."""
        found = []
        for i in range(len(self.ids)):
            near = (np.abs(other.lengths - self.lengths[i]) <= edits) & ((other.kinds == 1) | (self.kinds[i] == 1))
            near &= (other.ids > self.ids[i]) if other is self else (other.ids != self.ids[i])
            for k in np.flatnonzero(near).tolist():
                head, tail = trimmed(self.chars[i], other.chars[k])
                a, b = self.texts[i], other.texts[k]
                if within(a[head : len(a) - tail], b[head : len(b) - tail], edits):
                    found.append((int(self.ids[i]), int(other.ids[k])))
        return found


def marked_keys(distinct: DataFrame, edits: int, least: int, bits: int) -> np.ndarray:
    """Bit table over leading bits of keys: set where two lines may meet under a key."""

    def packed(key: np.ndarray) -> list[tuple[int, bytes]]:
        key = np.sort(key)
        lead = (key >> np.uint64(64 - bits)).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]]) if len(key) else np.zeros(0, np.int64)
        low = ((key >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")
        return [(int(lead[f]), low[f:e].tobytes()) for f, e in zip(cut.tolist(), np.r_[cut[1:], len(key)].tolist())]

    def note(batches):
        held: list = []

        def flush():
            key, kind = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            index, probe = dict(packed(key[kind == 1])), dict(packed(np.unique(key[kind == 0])))
            blocks = sorted(index.keys() | probe.keys())
            arrays = [pa.array(blocks, pa.int32()), pa.array([index.get(b, b"") for b in blocks], pa.binary()), pa.array([probe.get(b, b"") for b in blocks], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["block", "index", "probe"])

        n = 0
        for batch in small_batches(batches, "line", 2 << 20):
            key, _, kind = entries(batch.column("line").to_pylist(), edits, least)
            held.append((key, kind))
            n += len(key)
            if n > 4_000_000:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def meet(group: pa.Table) -> pa.Table:
        index, probe = (np.sort(np.frombuffer(b"".join(group.column(c).to_pylist()), "<u4")) for c in ("index", "probe"))
        several = index[1:][index[1:] == index[:-1]]
        both = np.r_[several, index[np.searchsorted(probe, index, "left") < np.searchsorted(probe, index, "right")]]
        fragment = np.zeros(1 << (TABLE_BITS - bits), bool)
        fragment[both >> np.uint32(32 - (TABLE_BITS - bits))] = True
        return pa.Table.from_arrays([group.column("block").slice(0, 1), pa.array([np.packbits(fragment).tobytes()], pa.binary())], ["block", "fragment"])

    noted = distinct.select("line").mapInArrow(note, "block int, index binary, probe binary").groupBy("block").applyInArrow(meet, "block int, fragment binary")
    table, size = np.zeros(1 << (TABLE_BITS - 3), np.uint8), 1 << (TABLE_BITS - bits - 3)
    for row in noted.toLocalIterator():  # 2**TABLE_BITS bits as a whole, however many lines there are
        table[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(bytes(row["fragment"]), np.uint8)
    return table


def line_links(distinct: DataFrame, edits: int, least: int, block_bytes: int = 64 << 20) -> DataFrame:
    """``a, b``: ids of all pairs of distinct lines within ``edits`` (from ``id, line``, distinct by line)."""
    spark = distinct.sparkSession
    total = distinct.agg(F.sum(F.octet_length("line"))).first()[0] or 0
    bits = min(20, max(6, math.ceil(math.log2(max(1, total) / block_bytes))))
    shared = spark.sparkContext.broadcast(marked_keys(distinct, edits, least, bits))

    def mark(batches):
        marks = shared.value
        for batch in small_batches(batches, "line", 2 << 20):
            key, line, kind = entries(batch.column("line").to_pylist(), edits, least)
            slot = key >> np.uint64(64 - TABLE_BITS)
            hit = ((marks[slot >> np.uint64(3)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1).astype(bool)
            key, line, kind = key[hit], line[hit], kind[hit]
            arrays = [pa.array(key.view(np.int64)), batch.column("id").take(pa.array(line)), pa.array(kind.astype(np.int32)), batch.column("line").take(pa.array(line))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "id", "kind", "line"])

    def compare(batches):
        partition, tiles, first = TaskContext.get().partitionId(), 0, None
        held: list = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), []]

        def solve(key, ids, kinds, texts, last):
            nonlocal tiles
            cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            out, rows = [], []
            for n, (f, e) in enumerate(zip(cut.tolist(), np.r_[cut[1:], len(key)].tolist())):
                edge = key[f] == first or (last and n == len(cut) - 1)
                if e - f < 2 and not edge:
                    continue
                for s in range(f, e, TILE):
                    t = min(s + TILE, e)
                    tile = Lines(ids[s:t], kinds[s:t], texts[s:t])
                    out += tile.linked(tile, edits)
                    if edge or e - f > TILE:
                        tiles += 1
                        rows.append((int(key[f]), (partition << 32) + tiles, tile.ids.tolist(), tile.kinds.tolist(), tile.texts))
            both = [(a, b, None, None, None, None, None) for a, b in out] + [(None, None, *r) for r in rows]
            types = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in both], t) for i, t in enumerate(types)], ["a", "b", "key", "tile", "ids", "kinds", "lines"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [*(batch.column(c).to_numpy() for c in ("key", "id", "kind")), batch.column("line").to_pylist()]
            now = [*(np.concatenate([h, x]) for h, x in zip(held[:3], now[:3])), held[3] + now[3]]
            first = now[0][0] if first is None else first
            keep = int(np.searchsorted(now[0], now[0][-1], "left"))
            if keep:
                yield solve(*[x[:keep] for x in now], False)
            held = [x[keep:] for x in now]
        if len(held[0]):
            yield solve(*held, True)

    def across(batches):
        for batch in batches:
            columns = [batch.column(c + s).to_pylist() for s in ("", "2") for c in ("ids", "kinds", "lines")]
            for i1, k1, t1, i2, k2, t2 in zip(*columns):
                one, two = (Lines(np.array(i, np.int64), np.array(k, np.int32), t) for i, k, t in ((i1, k1, t1), (i2, k2, t2)))
                found = one.linked(two, edits)
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    marked = distinct.select("id", "line").mapInArrow(mark, "key long, id long, kind int, line string")
    in_order = marked.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    found = staged(in_order.mapInArrow(compare, "a long, b long, key long, tile long, ids array<long>, kinds array<int>, lines array<string>"), "line-links")
    tiles = found.where("tile is not null").select("key", "tile", "ids", "kinds", "lines")
    other = tiles.select([F.col(c).alias(c + "2") for c in tiles.columns])
    pairs = tiles.join(other, (F.col("key") == F.col("key2")) & (F.col("tile") < F.col("tile2"))).select("ids", "kinds", "lines", "ids2", "kinds2", "lines2")
    every = found.where("tile is null").select("a", "b").unionByName(pairs.mapInArrow(across, "a long, b long"))
    return every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def line_classes(docs: DataFrame, edits: int = 2, least: int = 16) -> DataFrame:
    """One row per line of ``docs``: ``doc_id, line_no, class_id, n_links, kept``.

    Lines are what stands between line feeds; a null or empty text is one empty line. Equal lines, and lines linked through
    pairs at most ``edits`` edits (of characters) apart, are one class; ``class_id`` is the smallest SHA-256 of its lines and ``n_links`` the
    number of different lines within reach of a line's own. Lines under ``least`` characters match only when equal. The
    first line of a class by (doc_id, line_no) is kept, a null id coming last. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    distinct = staged(lines.groupBy("line").agg(F.count("*").alias("n")).select("line", F.monotonically_increasing_id().alias("id"), F.unhex(F.sha2("line", 256)).alias("sha")), "lines", "zstd")
    pairs = staged(line_links(distinct, edits, least), "line-pairs")
    both = pairs.select("a").unionAll(pairs.select("b"))
    degree = both.groupBy(F.col("a").alias("node_")).agg(F.count("*").alias("n_links"))
    names = distinct.select("id", "sha").join(degree, F.col("id") == F.col("node_"), "left").drop("node_")
    names = staged(names.join(connected_components(pairs), F.col("id") == F.col("node"), "left").select("id", "sha", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("root", "id").alias("root")), "line-names")
    classes = names.groupBy("root").agg(F.min("sha").alias("class_id"))
    labels = staged(names.join(classes, "root").select(F.col("sha").alias("own"), "class_id", "n_links"), "line-labels")
    placed = lines.select("doc_id", "line_no", F.unhex(F.sha2("line", 256)).alias("sha"))
    named = staged(placed.join(labels, F.col("sha") == F.col("own")).select("doc_id", "line_no", "class_id", "n_links"), "line-places")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc"), F.col("line_no").alias("no"))
    first = staged(named.groupBy(F.col("class_id").alias("c")).agg(F.min(place).alias("first")), "line-firsts")
    kept = F.col("first.doc").eqNullSafe(F.col("doc_id")) & (F.col("first.no") == F.col("line_no"))
    return named.join(first, F.col("class_id") == F.col("c")).select("doc_id", "line_no", F.lower(F.hex("class_id")).alias("class_id"), "n_links", kept.alias("kept"))
