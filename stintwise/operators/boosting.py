"""Gradient-boosted regression trees in which missing numbers have a side of their own choosing.

Inputs are cut at quantiles once and the rows packed into blocks of bin numbers and gradients. A level of a tree is one job over all
blocks, sums of gradients by (node, input, bin), added up per task and then over the tasks; their size does not depend on the rows. The best cut of
every node is read off them, trying the missing rows on either side of each. Squared loss, a ridge on leaf values, and gains as sums of squares won.

Trees are rows of a table. Rows are scored by one column expression, a tree in it being nested conditions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, written

NODES = "tree int, node int, feature string, threshold double, missing_left boolean, gain double, rows long, value double"
LEAST_GAIN = 1e-6
#: Trees between two tables of margins, so that a lost block is made again from few trees.
STRETCH = 12
ROWS_A_BLOCK = 65_536
#: Tasks of a level whose sums the driver adds up by itself; more are added up in a tree.
FEW_TASKS = 64
BLOCK = "rows long, bins binary, g binary"

Tree = tuple[list[int], list[int], list[int], list[float]]
Block = tuple[np.ndarray, np.ndarray]


@dataclass
class Forest:
    """Trees as (tree, node, feature, threshold, missing_left, gain, rows, value) with the children of node n at 2n + 1 and 2n + 2.

    A row goes left where its number is at most the threshold. Leaves have no feature; inner nodes no value.
    """

    features: list[str]
    base: float
    nodes: list[tuple]

    def table(self, spark: SparkSession) -> DataFrame:
        """The nodes as a table, after one row of tree -1 with the value all rows start from."""
        return spark.createDataFrame([(-1, 0, None, None, None, None, None, self.base), *self.nodes], NODES)

    @classmethod
    def of_table(cls, table: DataFrame, features: Sequence[str]) -> Forest:
        """From the rows of ``table``: as many as the forest has nodes."""
        rows = sorted((tuple(r) for r in table.collect()), key=lambda r: r[:2])
        return cls(list(features), rows[0][-1], rows[1:])

    def prediction(self) -> Column:
        """The score of a row with the input columns; null and NaN are missing."""
        if not self.nodes:
            return F.lit(self.base)
        at = {(n[0], n[1]): n for n in self.nodes}

        def chosen(tree: int, node: int) -> str:
            _, _, name, threshold, missing_left, _, _, leaf = at[tree, node]
            if name is None:
                return _double(leaf)
            left, right = chosen(tree, 2 * node + 1), chosen(tree, 2 * node + 2)
            # A comparison with a missing input is no hit, so it takes what stands last.
            own, cut = f"x.f{self.features.index(name)}", _double(threshold)
            return f"if({own} > {cut}, {right}, {left})" if missing_left else f"if({own} <= {cut}, {left}, {right})"

        inputs = ", ".join(f"'f{i}', nullif(double(`{c}`), double('NaN'))" for i, c in enumerate(self.features))
        scores = ", ".join(chosen(tree, 0) for tree in sorted({n[0] for n in self.nodes}))
        # The inputs are read once a row, under one name.
        return F.expr(f"get(transform(array(named_struct({inputs})), x -> aggregate(array({scores}), {_double(self.base)}, (sum, t) -> sum + t)), 0)")


def _double(value: float) -> str:
    return f"double('{float(value)!r}')"


def _array(values: Sequence[float]) -> str:
    return f"array({', '.join(map(_double, values))})"


def quantile_cuts(rows: DataFrame, features: Sequence[str], target: str, bins: int, accuracy: int) -> tuple[list[list[float]], float, int]:
    """(distinct cuts of each input up to its largest value, mean of the target, rows), in one pass of sketches."""
    shares = _array([i / bins for i in range(1, bins + 1)])
    found = rows.agg(
        *[F.expr(f"percentile_approx(nullif(double(`{c}`), double('NaN')), {shares}, {accuracy}) AS c{i}") for i, c in enumerate(features)],
        F.avg(target).alias("base"), F.count(target).alias("rows"),
    ).first()
    return [sorted(set(found[f"c{i}"] or [])) for i in range(len(features))], found["base"] or 0.0, found["rows"]


def _packed(features: Sequence[str], cuts: list[list[float]], base: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (features, target) to blocks: a bin is 0 for a missing number, else one more than the cuts below it."""

    def numbers(column: pa.Array) -> np.ndarray:
        return column.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        bins = np.empty((len(features), table.num_rows), _bin_type(cuts))
        for i, own in enumerate(cuts):
            x = numbers(table.column(i).combine_chunks())
            bins[i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(own), x))
        g = base - numbers(table.column(len(features)).combine_chunks())
        return pa.RecordBatch.from_pydict({"rows": [table.num_rows], "bins": [bins.tobytes()], "g": [g.tobytes()]})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(x.num_rows for x in held) >= ROWS_A_BLOCK:
                yield block(held)
                held = []
        if held:
            yield block(held)

    return pack


def _bin_type(cuts: list[list[float]]) -> np.dtype:
    return np.min_scalar_type(1 + max(map(len, cuts)))


def _blocks(table: DataFrame, cuts: list[list[float]]) -> RDD:
    """(bins, g) of each block; the bins of an input lie together."""
    kind = _bin_type(cuts)

    def block(row) -> Block:
        return np.frombuffer(row["bins"], kind).reshape(-1, row["rows"]), np.frombuffer(row["g"], np.float64)

    return table.rdd.map(block)


def fit_forest(
    rows: DataFrame,
    features: Sequence[str],
    target: str,
    trees: int,
    rate: float,
    depth: int,
    bins: int = 256,
    ridge: float = 1.0,
    least_rows: int = 1,
    accuracy: int = 100_000,
) -> Forest:
    """Trees fitted to the rows with a known target; all inputs must be numbers.

    Ties between cuts go to the first input, then the lower cut, then missing rows to the left. One job per level; each task brings at
    most nodes x inputs x bins sums, whatever the number of rows.
    """
    known = rows.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    cuts, base, n = quantile_cuts(known, features, target, bins, accuracy)
    forest = Forest(list(features), float(base), [])
    if not n:
        return forest
    numbers = known.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate((*features, target))])
    table = _kept(numbers.mapInArrow(_packed(features, cuts, forest.base), BLOCK))
    state, before, since = _blocks(table, cuts).persist(StorageLevel.MEMORY_AND_DISK), None, []
    for tree in range(trees):
        grown, done = _grow(state, forest, tree, cuts, depth, rate, ridge, least_rows)
        if before:  # held until the blocks after it are
            before.unpersist()
        before = state
        if not grown or tree + 1 == trees:
            break
        since.append(done)
        if (tree + 1) % STRETCH:
            state = _stepped(state, done)
        else:
            moved, since = _kept(_moved(table, cuts, since)), []
            table.unpersist()
            table = moved
            state = _blocks(table, cuts)
        state.persist(StorageLevel.MEMORY_AND_DISK)
    state.unpersist()
    table.unpersist()
    return forest


def _kept(blocks: DataFrame) -> DataFrame:
    """Written and read again; without a folder to write to, held in memory and on disk."""
    return written(blocks, "boosting") if shared_dir(blocks.sparkSession) else blocks.persist()


def _leaves(bins: np.ndarray, tree: Tree, steps: int) -> np.ndarray:
    """The node that each row of a block reaches in ``steps``."""
    feature, cut, side = (np.array(x) for x in tree[:3])
    node, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    for _ in range(steps):
        own = bins[feature[node], rows].astype(np.int64)
        right = np.where(own == 0, side[node], own - 1 > cut[node])
        node = np.where(feature[node] < 0, node, 2 * node + 1 + right)
    return node


def _after(block: Block, trees: list[Tree]) -> Block:
    """A block with the leaf values of ``trees`` added to its gradients, one tree after the other."""
    bins, g = block
    for tree in trees:
        g = g + np.array(tree[3])[_leaves(bins, tree, int(math.log2(len(tree[0]) + 1)) - 1)]
    return bins, g


def _stepped(blocks: RDD, tree: Tree) -> RDD:
    return blocks.map(lambda block: _after(block, [tree]))


def _moved(table: DataFrame, cuts: list[list[float]], trees: list[Tree]) -> DataFrame:
    """The blocks of ``table`` with the gradients after ``trees``."""
    kind = _bin_type(cuts)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, g = _after((np.frombuffer(row["bins"], kind).reshape(-1, row["rows"]), np.frombuffer(row["g"], np.float64)), trees)
                yield pa.RecordBatch.from_pydict({"rows": [row["rows"]], "bins": [row["bins"]], "g": [g.tobytes()]})

    return table.mapInArrow(move, BLOCK)


def _sums(state: RDD, tree: Tree, level: int, sizes: list[int]) -> np.ndarray:
    """(sum of gradients and rows) by input, node of a level and bin; zeros where no row comes to.

    A task brings as many sums of an input as it has bins; they are laid out evenly here.
    """
    first, nodes = 2**level - 1, 2**level
    ends = np.cumsum([0] + [nodes * (n + 2) for n in sizes])

    def add(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        held = np.zeros((2, ends[-1]))
        for bins, g in blocks:
            node = _leaves(bins, tree, level) - first
            own = np.flatnonzero(node >= 0)  # the others have come to a leaf above
            node, g = node[own], g[own]
            for f, n in enumerate(sizes):
                at, whole = node * (n + 2) + bins[f][own], nodes * (n + 2)
                held[0, ends[f] : ends[f + 1]] += np.bincount(at, g, whole)
                held[1, ends[f] : ends[f + 1]] += np.bincount(at, minlength=whole)
        yield held

    found = state.mapPartitions(add)
    whole = sum(found.collect()) if found.getNumPartitions() <= FEW_TASKS else found.treeReduce(np.add)
    even = np.zeros((2, len(sizes), nodes, max(2, *sizes) + 2))
    for f, n in enumerate(sizes):
        even[:, f, :, : n + 2] = whole[:, ends[f] : ends[f + 1]].reshape(2, nodes, n + 2)
    return even


def _grow(state: RDD, forest: Forest, tree: int, cuts, depth, rate, ridge, least_rows) -> tuple[bool, Tree]:
    """Adds one tree to the forest; (whether it has a cut, the tree over bins with its leaf values)."""
    width = 2 ** (depth + 1) - 1
    feature, cut, side, value = done = [-1] * width, [0] * width, [0] * width, [0.0] * width
    sums: dict[int, tuple[float, float]] = {}
    open_nodes, sizes = [0], [len(c) for c in cuts]
    for level in range(depth):
        found = _sums(state, done, level, sizes)
        following = []
        for at in open_nodes:
            best = _best_cut(*found[:, :, at - 2**level + 1], sizes, ridge, least_rows)
            sums[at] = best[0]
            if best[1] is None:
                continue
            f, b, missing_left, gain, left, right = best[1]
            feature[at], cut[at], side[at] = f, b, int(not missing_left)
            sums[2 * at + 1], sums[2 * at + 2] = left, right
            forest.nodes.append((tree, at, forest.features[f], cuts[f][b], missing_left, gain, int(sums[at][1]), None))
            following += [2 * at + 1, 2 * at + 2]
        open_nodes = following
        if not following:
            break
    for at, (g, n) in sums.items():
        if feature[at] < 0:
            value[at] = -rate * g / (n + ridge)
            forest.nodes.append((tree, at, None, None, None, None, int(n), value[at]))
    return feature[0] >= 0, done


def _best_cut(held_g: np.ndarray, held_n: np.ndarray, sizes: list[int], ridge: float, least: int):
    """((sum, rows) of the node, (input, bin, missing left, gain, left sums, right sums) or None); sums by input and bin, missing rows first."""
    whole_g, whole_n = float(held_g[0].sum()), float(held_n[0].sum())
    left_g, left_n = np.cumsum(held_g[:, 1:], axis=1)[..., None], np.cumsum(held_n[:, 1:], axis=1)[..., None]
    one = np.array([1.0, 0.0])  # missing rows left, then right
    left_g, left_n = left_g + held_g[:, :1, None] * one, left_n + held_n[:, :1, None] * one
    right_g, right_n = whole_g - left_g, whole_n - left_n
    gain = left_g**2 / (left_n + ridge) + right_g**2 / (right_n + ridge) - whole_g**2 / (whole_n + ridge)
    valid = (left_n >= least) & (right_n >= least) & (np.arange(held_n.shape[1] - 1)[None, :, None] < np.array(sizes)[:, None, None])
    gain = np.where(valid, gain, -np.inf)
    i, j, k = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[i, j, k] > LEAST_GAIN:
        return (whole_g, whole_n), None
    sides = [(float(x[i, j, k]), float(y[i, j, k])) for x, y in ((left_g, left_n), (right_g, right_n))]
    return (whole_g, whole_n), (int(i), int(j), bool(k == 0), float(gain[i, j, k]), *sides)


def importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, cuts, total_gain, importance), largest first: mean gain of a cut on the input, as a share of all inputs'.

    Inputs that no cut uses are there with zeros; names are those the trees were fitted with.
    """
    spark = nodes.sparkSession
    all_inputs = spark.createDataFrame([(c,) for c in features], "feature string")
    used = nodes.where("feature is not null").groupBy(F.col("feature").alias("own")).agg(F.count(F.lit(1)).alias("cuts"), F.sum("gain").alias("total_gain"))
    joined = all_inputs.join(F.broadcast(used), F.col("feature") == F.col("own"), "left").na.fill(0, ["cuts", "total_gain"])
    mean = F.coalesce(F.try_divide("total_gain", "cuts"), F.lit(0.0))
    whole = joined.agg(F.sum(mean).alias("whole"))
    share = F.coalesce(F.try_divide(mean, F.col("whole")), F.lit(0.0))
    return joined.crossJoin(F.broadcast(whole)).select("feature", "cuts", "total_gain", share.alias("importance")).orderBy(F.desc("importance"), "feature")
