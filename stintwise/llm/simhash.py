"""SimHash fingerprints and near-duplicate links by a Gray-order hierarchical index.

Fingerprints within ``BITS_APART`` = 4 bits agree on two of six bit segments, so each distinct fingerprint is keyed by
the fifteen pairs of segments and the rows are sorted, by range partitioning, by key and Gray rank. Neighbours in
Gray order share most bits. Over each run of a key a tree is laid on that order: a node keeps the bit pattern (and the
mask of bits) that all below it share. The search walks pairs of nodes from the top, adds up the bits in which the
patterns must differ, and drops the whole pair of groups beyond 4; a pair of groups whose bits can differ in 4 places at
most is linked as a whole. Runs longer than a piece, or cut by a partition's edge, are joined piece by piece after the
same test on the pieces. A run contributes a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_column, small_batches, staged
from .components import connected_components

BITS_APART = 4
SHINGLE = 4
PIECE = 2048
FAN = 16
SEGMENTS = [11, 11, 11, 11, 10, 10]


def masks() -> list[int]:
    """One mask for each pair of the six segments: two of six stay untouched by four differing bits."""
    ends = np.cumsum(SEGMENTS).tolist()
    parts = [((1 << n) - 1) << (end - n) for n, end in zip(SEGMENTS, ends)]
    return [a | b for a, b in combinations(parts, 2)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of each shingle of the lower-cased words of one text."""
    words = text.lower().split()
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    joined = b" ".join(words)
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s : e - 1], 42) for s, e in zip(starts, [*starts[shingle:], at])]


def majority(hashes: list[int], n: np.ndarray) -> np.ndarray:
    """Signed fingerprints of texts with ``n`` hashes each: bits set in over half of them."""
    out = np.zeros(len(n), np.uint64)
    if len(hashes):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = np.flatnonzero(n)
        at = (np.cumsum(n) - n)[full]
        for row, first, count in zip(full, at, n[full]):
            ones = bits[first : first + count].sum(axis=0, dtype=np.int64)
            out[row] = np.packbits(2 * ones > count, bitorder="little").view("<u8")[0]
    return out.view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (signed long) for every row; a text without words has fingerprint 0."""

    def run(batches):
        for batch in small_batches(batches, "text", 2 << 20):
            raw, at = byte_column(batch.column("text"))
            data = raw.tobytes()
            hashes, n = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                own = fingerprint_hashes(data[a:b])
                n.append(len(own))
                hashes += own
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(majority(hashes, np.array(n, np.int64)))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a bit string in the reflected Gray order: each bit is the parity of itself and all above."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def from_rank(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> np.uint64(1))


# ---- the tree over one sorted run ------------------------------------------------------------------------------


def levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the leaves up: for each node the AND and the OR of all fingerprints below."""
    out = [(fps, fps)]
    while len(out[-1][0]) > 1:
        every, some = out[-1]
        cuts = np.arange(0, len(every), FAN)
        out.append((np.bitwise_and.reduceat(every, cuts), np.bitwise_or.reduceat(some, cuts)))
    return out


def below(node: np.ndarray, level: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    return node * FAN**level, np.minimum((node + 1) * FAN**level, size)


def children(nodes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of each node, and which entry of ``nodes`` each belongs to."""
    n = np.minimum(FAN, size - nodes * FAN)
    of = np.repeat(np.arange(len(nodes)), n)
    return nodes[of] * FAN + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), of


def search(one: list, two: list, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links between the leaves of two trees (or of one with itself), enough to join whatever is linked."""
    size1, size2 = len(one[0][0]), len(two[0][0])
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    la, lb = len(one) - 1, len(two) - 1
    links: list = []
    stack = [(a, b, la, lb)]
    while stack:
        a, b, la, lb = stack.pop()
        if len(a) > 1 << 16:  # in parts, so that memory stays small
            half = len(a) // 2
            stack += [(a[:half], b[:half], la, lb), (a[half:], b[half:], la, lb)]
            continue
        (all1, any1), (all2, any2) = (x[a] for x in one[la]), (x[b] for x in two[lb])
        apart = np.bitwise_count((all1 & ~any2) | (all2 & ~any1))
        keep = apart <= BITS_APART
        free = np.bitwise_count((any1 | any2) & ~(all1 & all2)) <= BITS_APART
        if la == lb == 0:
            keep &= ~((a >= b) & same)
            links.append(np.stack([a[keep], b[keep]]))
            continue
        for x, y in zip(a[free].tolist(), b[free].tolist()):  # every leaf of both is within reach of every other
            (f1, l1), (f2, l2) = below(x, la, size1), below(y, lb, size2)
            first = np.arange(f1, l1), np.arange(f2, l2)
            links += [np.stack([first[0], np.full(len(first[0]), f2)]), np.stack([np.full(len(first[1]), f1), first[1]])]
        keep &= ~free
        if same:
            keep &= a <= b
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if la >= lb:
            a, of = children(a, len(one[la - 1][0]))
            b = b[of]
            if same:
                b, of = children(b, len(two[lb - 1][0]))
                a, lb = a[of], lb - 1
            la -= 1
        else:
            b, of = children(b, len(two[lb - 1][0]))
            a, lb = a[of], lb - 1
        stack.append((a, b, la, lb))
    return tuple(np.concatenate(links, axis=1)) if links else (a[:0], b[:0])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each one's component among ``n`` with links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (jump := root[root]).tolist() != root.tolist():
            root = jump
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


EDGE_SCHEMA = "a long, b long, slot int, key long, piece long, every long, some long, fps binary, reps binary"


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a))
    arrays = [pa.array(a), pa.array(b), none.cast(pa.int32()), *[none.cast(pa.int64())] * 4, none.cast(pa.binary()), none.cast(pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b", "slot", "key", "piece", "every", "some", "fps", "reps"])


def _piece(slot: int, key: int, piece: int, fps: np.ndarray, reps: np.ndarray) -> pa.RecordBatch:
    every, some = np.bitwise_and.reduce(fps), np.bitwise_or.reduce(fps)
    row = {"a": None, "b": None, "slot": slot, "key": key, "piece": piece, "every": int(every.view(np.int64)), "some": int(some.view(np.int64)), "fps": fps.tobytes(), "reps": reps.tobytes()}
    types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))


def link_sorted(batches):
    """Sorted rows of a partition to links inside its runs, and to pieces of the runs that may go on elsewhere."""
    partition, pieces = TaskContext.get().partitionId(), 0
    held: list = []
    first_key = None

    def solve(slot, key, rank, rep, last):
        nonlocal pieces
        fps = from_rank(rank)
        cut = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])])
        sizes = np.diff(np.r_[cut, len(fps)])
        outer = (slot[cut] == first_key[0]) & (key[cut] == first_key[1])
        outer[-1] |= last
        found: list = []
        for i in np.flatnonzero((sizes > 1) | outer).tolist():
            many = outer[i] or sizes[i] > PIECE
            for s in range(cut[i], cut[i] + sizes[i], PIECE):
                e = min(s + PIECE, cut[i] + sizes[i])
                if e - s > 1:
                    tree = levels(fps[s:e])
                    a, b = search(tree, tree, True)
                    if len(a):
                        root = forest(e - s, a, b)
                        joined = np.flatnonzero(root != np.arange(e - s))
                        found.append((rep[s:e][root[joined]], rep[s:e][joined]))
                if many:
                    pieces += 1
                    yield _piece(int(slot[s]), int(key[s]), (partition << 32) + pieces, fps[s:e], rep[s:e])
        if found:
            yield _edges(*map(np.concatenate, zip(*found)))

    def columns(batch):
        return [batch.column(n).to_numpy(zero_copy_only=False) for n in ("slot", "key", "rank", "rep")]

    rows: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = columns(batch)
        now[2] = now[2].view(np.uint64)
        if first_key is None:
            first_key = (now[0][0], now[1][0])
        rows = [np.concatenate(p) for p in zip(held, now)] if held else now
        slot, key = rows[0], rows[1]
        keep = int(np.flatnonzero((slot == slot[-1]) & (key == key[-1]))[0])
        if keep:
            yield from solve(*[r[:keep] for r in rows], False)
        held = [r[keep:] for r in rows]
    if held:
        yield from solve(*held, True)


def link_pieces(batches):
    """Links between two pieces of one run."""
    for batch in batches:
        for f1, r1, f2, r2 in zip(*[batch.column(n).to_pylist() for n in ("fps", "reps", "fps2", "reps2")]):
            one, two = np.frombuffer(f1, np.uint64), np.frombuffer(f2, np.uint64)
            n1 = len(one)
            a, b = search(levels(one), levels(two), False)
            reps = np.r_[np.frombuffer(r1, np.int64), np.frombuffer(r2, np.int64)]
            root = forest(len(reps), a, b + n1)
            joined = np.flatnonzero(root != np.arange(len(reps)))
            yield pa.RecordBatch.from_arrays([pa.array(reps[root[joined]]), pa.array(reps[joined])], ["a", "b"])


def links(nodes: DataFrame) -> DataFrame:
    """``a, b``: links of representatives that connect all fingerprints within reach of each other (``fp, rep`` distinct by fp)."""
    keyed = nodes.select("rep", gray_rank(F.col("fp")).alias("rank"), F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks()])).alias("slot", "key"))
    in_order = keyed.select("slot", "key", "rank", "rep").repartitionByRange("slot", "key", "rank").sortWithinPartitions("slot", "key", "rank")
    found = staged(in_order.mapInArrow(link_sorted, EDGE_SCHEMA), "simhash-links")
    pieces = found.where("piece is not null").select("slot", "key", "piece", "every", "some", "fps", "reps")
    other = pieces.select([F.col(c).alias(c + "2") for c in pieces.columns])
    must = F.bit_count(
        F.col("every").bitwiseAND(F.bitwise_not("some2")).bitwiseOR(F.col("every2").bitwiseAND(F.bitwise_not("some")))
    )
    pairs = pieces.join(other, (F.col("slot") == F.col("slot2")) & (F.col("key") == F.col("key2")) & (F.col("piece") < F.col("piece2")) & (must <= BITS_APART))
    across = pairs.select("fps", "reps", "fps2", "reps2").mapInArrow(link_pieces, "a long, b long")
    return found.where("piece is null").select("a", "b").unionByName(across)


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    Texts that are null, empty or blank have fingerprint 0 and are linked like any other. Rows that share an id are one
    document. A row without an id takes the component of its fingerprint, null where no row with an id has it, and links nothing.
    """
    prints = staged(fingerprints(docs), "simhash-prints")
    nodes = staged(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    roots = connected_components(links(nodes))
    labels = nodes.join(roots, nodes["rep"] == roots["node"], "left").select(F.col("fp").alias("own"), F.coalesce("root", "rep").alias("component_id"))
    return prints.join(labels, prints["fp"].eqNullSafe(labels["own"]), "left").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
