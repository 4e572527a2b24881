"""Nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

The largest inner product becomes the least distance by one more coordinate, sqrt(M^2 - |x|^2) for a row and 0 for a
query (M: the longest row). The tree is fitted to a sample of at most ``sample`` rows; every row is then put in the leaf
it descends to. A query opens nodes from a priority queue, nearest centre first, which lists the leaves in the order
of visits. How many leaves to visit is calibrated: for a sample of queries the true neighbours are found among all rows, and
the visits widen until the ``recall`` asked for is reached. Visits and rows meet by leaf; a leaf with many rows or many
visitors is cut into parts, so no task grows with a leaf. Scores are sums in double precision over the original vectors.
"""

from __future__ import annotations

import heapq
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small_batches, staged


def usable(vector: Column) -> Column:
    """Not null or zero, and without null, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of packed doubles."""
    rows = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 0))


def packed(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, norm2, dims``: usable rows as packed doubles."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("e")))

    def run(batches):
        for batch in batches:
            own = [np.asarray(e, np.float64) for e in batch.column("e").to_pylist()]
            arrays = [batch.column("vec_id"), pa.array([e.tobytes() for e in own], pa.binary()), pa.array([float((e * e).sum()) for e in own], pa.float64()), pa.array([len(e) for e in own], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "v", "norm2", "dims"])

    return rows.select("vec_id", "e").mapInArrow(run, "vec_id long, v binary, norm2 double, dims long")


def augmented(x: np.ndarray, longest2: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(0.0, longest2 - (x * x).sum(axis=1)))]


def dist2(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None])


class Tree:
    """Nodes as arrays of centres with their children; leaves are numbered."""

    def __init__(self, points: np.ndarray, longest2: float, fan: int, leaf: int, seed: int = 7):
        self.longest2, self.children, self.leaves = longest2, [], 0
        self.random = np.random.default_rng(seed)
        self._grow(augmented(points, longest2) if len(points) else points, fan, leaf)

    def _grow(self, points: np.ndarray, fan: int, leaf: int) -> tuple[str, int]:
        distinct = np.unique(points, axis=0) if len(points) > leaf else points
        if len(distinct) <= max(1, min(leaf, len(points))) or len(points) <= leaf:
            self.leaves += 1
            return ("leaf", self.leaves - 1)
        node = len(self.children)
        self.children.append(None)
        centres = distinct[self.random.choice(len(distinct), min(fan, len(distinct)), replace=False)]
        for _ in range(8):
            own = dist2(distinct, centres).argmin(axis=1)
            centres = np.array([distinct[own == i].mean(axis=0) for i in range(len(centres)) if (own == i).any()])
        own = dist2(points, centres).argmin(axis=1)
        held = [i for i in range(len(centres)) if (own == i).any()]
        if len(held) < 2:
            self.children.pop()
            self.leaves += 1
            return ("leaf", self.leaves - 1)
        self.children[node] = (centres[held], [self._grow(points[own == i], fan, leaf) for i in held])
        return ("node", node)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf each row descends to."""
        x, out = augmented(x, self.longest2), np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.children else []
        while todo:
            node, rows = todo.pop()
            centres, below = self.children[node]
            own = dist2(x[rows], centres).argmin(axis=1)
            for i, (kind, at) in enumerate(below):
                mine = rows[own == i]
                if kind == "leaf":
                    out[mine] = at
                elif len(mine):
                    todo.append((at, mine))
        return out

    def visits(self, q: np.ndarray, most: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``most`` leaves that a best-bin-first walk opens for one query, and as many more as it takes until the
        rows in them, ``held`` by leaf, are ``least``."""
        if not self.children:
            return [0]
        rows = 0
        x, found, queue = np.r_[q, 0.0][None], [], [(0.0, 0, ("node", 0))]
        tie = 0
        while queue and (len(found) < most or rows < least):
            _, _, (kind, at) = heapq.heappop(queue)
            if kind == "leaf":
                found.append(at)
                rows += 0 if held is None else int(held[at])
                continue
            centres, below = self.children[at]
            for d, child in zip(dist2(x, centres)[0].tolist(), below):
                tie += 1
                heapq.heappush(queue, (d, tie, child))
        return found


def first_copies(rows: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which of the rows, sorted by id, can be among the k nearest of a query: of equal vectors the k smallest ids besides any one id."""
    _, which = np.unique(rows.view(np.dtype((np.void, rows.shape[1] * 8))).reshape(-1), return_inverse=True)
    order = np.argsort(which, kind="stable")
    at, which, ids = np.arange(len(order)), which[order], ids[order]
    fresh = np.r_[True, which[1:] != which[:-1]]
    place = at - np.maximum.accumulate(np.where(fresh, at, 0))
    run = at - np.maximum.accumulate(np.where(fresh | np.r_[True, ids[1:] != ids[:-1]], at, 0)) + 1
    longest = np.maximum.accumulate(which * (len(order) + 1) + run) - which * (len(order) + 1)
    return np.sort(order[place - longest < k])


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, cells: int = 1 << 21) -> pd.DataFrame:
    """The k rows of largest inner product for each query, ties to smaller ids, never the query's own row.

    A matrix product finds all rows that can be among the k within its rounding; these are scored again, each row
    in one order of addition, so that equal rows have equal scores.
    """
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if len(rows) and len(queries):
        order = np.argsort(ids, kind="stable")
        order = order[first_copies(np.ascontiguousarray(rows[order]), ids[order], k)]
        rows, ids = rows[order], ids[order]
        longest, dims = np.sqrt((rows * rows).sum(axis=1).max()), rows.shape[1]
        step = max(1, cells // len(rows))
        for s in range(0, len(queries), step):
            asked, own = queries[s : s + step], query_ids[s : s + step]
            near = asked @ rows.T
            near[own[:, None] == ids] = -np.inf
            least = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(asked), -np.inf)
            slack = 4 * dims * np.finfo(float).eps * longest * np.sqrt((asked * asked).sum(axis=1))
            q, r = np.nonzero((near >= (least - slack)[:, None]) & (near > -np.inf))
            scores = np.zeros(len(q))
            for i in range(0, len(q), cells // dims + 1):
                some = slice(i, i + cells // dims + 1)
                scores[some] = (rows[r[some]] * asked[q[some]]).sum(axis=1)
            order = np.lexsort((ids[r], -scores, q))
            q, r, scores = q[order], r[order], scores[order]
            top = np.arange(len(q)) - np.searchsorted(q, q) < k
            parts.append((own[q[top]], ids[r[top]], scores[top]))
    found = [np.concatenate(x) for x in zip(*parts)]
    return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], found)))


def calibrated_visits(index: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float, sample: int) -> int:
    """Leaves to visit so that a sample of queries, held against all rows, finds ``recall`` of its true neighbours."""
    spark = index.sparkSession
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()  # at most ``sample`` vectors
    if not chosen:
        return 1
    ids, vectors = np.array([r["vec_id"] for r in chosen], np.int64), matrix([bytes(r["v"]) for r in chosen])
    shared = spark.sparkContext.broadcast((ids, vectors))

    def scan(batches):
        ids, vectors = shared.value
        for batch in small_batches(batches, "v", 1 << 20):
            found = best(vectors, ids, matrix(batch.column("v")), batch.column("vec_id").to_numpy(), k)
            leaves = dict(zip(batch.column("vec_id").to_pylist(), batch.column("leaf").to_pylist()))
            yield pa.RecordBatch.from_pandas(found.assign(leaf=found["vec_id"].map(leaves).astype("int64")), preserve_index=False)

    near = index.select("vec_id", "leaf", "v").mapInArrow(scan, "query_id long, vec_id long, score double, leaf long")
    top = near.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    true = top.select("query_id", "leaf").collect()  # sample * k rows
    turns = {int(i): {leaf: n for n, leaf in enumerate(tree.visits(v, tree.leaves), 1)} for i, v in zip(ids, vectors)}
    needed = np.sort([turns[r["query_id"]][r["leaf"]] for r in true])
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) if len(needed) else 1


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    sample: int = 20_000,
    fan: int = 16,
    spread: int = 64,
    leaf: int = 16,
    recall: float = 0.97,
    calibration: int = 256,
    part: int = 16_384,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, its ``k`` nearest found.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id. Rows that repeat an
    id are candidates each, but never for their own id. An inner product is of vectors of one length, so each length has an
    index of its own.

    A node is split while it holds more than a ``spread``-th of the sample, and more than ``leaf`` rows: the tree has a
    few hundred leaves at every size of the table, so the visits of a query, which are moved, do not grow with it.
    """
    rows = staged(packed(vectors), "ann-rows")
    lengths = sorted(r["dims"] for r in rows.select("dims").distinct().collect())  # as many as there are lengths
    settings = (every, k, sample, fan, spread, leaf, recall, calibration, part)
    found = [_nearest_of_length(rows.where(F.col("dims") == d).drop("dims"), *settings) for d in lengths or [0]]
    return reduce(DataFrame.unionByName, found)


def _nearest_of_length(rows: DataFrame, every: int, k: int, sample: int, fan: int, spread: int, leaf: int, recall: float, calibration: int, part: int) -> DataFrame:
    spark = rows.sparkSession
    longest2 = float(rows.agg(F.max("norm2")).first()[0] or 0.0)
    fitting = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()  # at most ``sample`` vectors
    tree = Tree(matrix([bytes(r["v"]) for r in fitting]), longest2, fan, max(leaf, len(fitting) // spread))
    shared = spark.sparkContext.broadcast(tree)

    def descend(batches):
        for batch in batches:
            leaves = shared.value.leaf_of(matrix(batch.column("v"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], ["vec_id", "v", "leaf"])

    index = staged(rows.select("vec_id", "v").mapInArrow(descend, "vec_id long, v binary, leaf long"), "ann-index")
    queries = index.where(F.col("vec_id") % every == 0)
    visits = calibrated_visits(index, queries, tree, k, recall, calibration)
    # A query's own id takes no part, so it must reach as many rows beyond k as have that id.
    copies = index.groupBy(F.col("vec_id").alias("own_id")).agg(F.count("*").alias("own")).where(F.col("own_id") % every == 0)
    asking = queries.join(copies, F.col("vec_id").eqNullSafe(F.col("own_id"))).select("vec_id", "v", "own")
    held = np.zeros(max(1, tree.leaves), np.int64)
    for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # a row a leaf
        held[r["leaf"]] = r["n"]
    in_leaves = spark.sparkContext.broadcast(held)

    def walk(batches):
        for batch in batches:
            near = zip(matrix(batch.column("v")), batch.column("own").to_pylist())
            lists = [shared.value.visits(v, visits, in_leaves.value, k + own) for v, own in near]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(lists, pa.list_(pa.int64()))], ["vec_id", "v", "leaves"])

    walked = asking.mapInArrow(walk, "vec_id long, v binary, leaves array<long>")
    visited = staged(walked, "ann-visits")
    asked = visited.select("vec_id", "v", F.explode("leaves").alias("leaf"))
    parts = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / part).alias(name))
    cuts = {r["leaf"]: (r["rows"] or 0, r["asks"] or 0) for r in parts(index, "rows").join(parts(asked.select("leaf"), "asks"), "leaf").collect()}  # a row a leaf
    table = spark.createDataFrame([(int(x), int(r), int(a)) for x, (r, a) in cuts.items()], "leaf long, row_parts long, ask_parts long")

    def dealt(df, own, other, kind):
        """Each row goes to one of its leaf's parts on its own side, and to all of them on the other."""
        placed = df.join(F.broadcast(table), "leaf")  # one row a leaf of a tree fitted to ``sample`` rows
        mine = F.pmod(F.xxhash64("vec_id", "v"), F.col(own))
        return placed.select("leaf", mine.alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other), F.lit(kind).alias("kind"), "vec_id", "v").select(
            "leaf", "row_parts", "ask_parts", "kind", "vec_id", "v"
        )

    def meet(group: pa.Table) -> pa.Table:
        kind = group.column("kind").to_numpy()
        ids, v = group.column("vec_id").to_numpy(), matrix(group.column("v").combine_chunks())
        return pa.Table.from_pandas(best(v[kind == 1], ids[kind == 1], v[kind == 0], ids[kind == 0], k), preserve_index=False)

    both = dealt(index, "row_parts", "ask_parts", 0).unionByName(dealt(asked, "ask_parts", "row_parts", 1))
    found = both.groupBy("leaf", "row_parts", "ask_parts").applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
