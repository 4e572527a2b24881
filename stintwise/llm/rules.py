"""Quality rules: fixed limits on document statistics, then gradient-boosted trees over more of them.

Statistics come from the bytes of a batch of texts at once. Trees are grown by histograms on a labelled sample of at most
``sample`` documents (logistic loss, Newton steps), with monotonic constraints on the features named in ``MONOTONE``. They
are flattened into arrays of nodes, so that a batch is scored by walking all its rows through all trees together, one
level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_column, held_out, small_batches, staged

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "word_length", "symbols_per_word", "upper_share", "digit_share", "mark_share", "shouts_per_word", "dup_line_share",
    "repeat_share", "distinct_share", "same_as_last", "words_per_line", "bare_word_share", "longest_word", "wide_share",
]
#: +1: the score may only rise with the feature, -1: only fall.
MONOTONE = {"symbols_per_word": -1, "shouts_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "same_as_last": -1, "bare_word_share": -1}


def _class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_blank, _symbol, _upper = _class(BLANK), _class(SYMBOLS), _class(bytes(range(65, 91)))
_letter, _digit = _class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)])), _class(bytes(range(48, 58)))
_mark = ~(_blank | _letter | _digit)
_later = _class(bytes(range(128, 192)))  # bytes of a code point after its first


# ---- statistics ------------------------------------------------------------------------------------------------


class Words(dict):
    """Word to number, as words come; emptied when it holds ``most`` words or ``room`` bytes."""

    def __init__(self, most: int = 400_000, room: int = 16 << 20):
        self.most, self.room, self.held = most, room, 0

    def __missing__(self, word: bytes) -> int:
        self.held += len(word)
        code = self[word] = len(self)
        return code

    def of(self, docs: list[list[bytes]]) -> np.ndarray:
        if len(self) > self.most or self.held > self.room:
            self.clear()
            self.held = 0
        return np.fromiter((c for doc in docs for c in map(self.__getitem__, doc)), np.int64, sum(map(len, docs)))


def repeated_words(codes: np.ndarray, n: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a run of ``window`` words found twice or more in it, the first time included.

    Runs with a hash of their own cannot repeat; the others are told apart by their words.
    """
    doc, last = np.repeat(np.arange(len(n)), n), np.repeat(np.cumsum(n), n)
    at = np.flatnonzero(np.arange(len(codes)) + window <= last)
    if not len(at):
        return np.zeros(len(n), np.int64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    value = doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(window):
        value = value * np.uint64(0xBF58476D1CE4E5B9) + mixed[at + i]
    order = np.argsort(value, kind="stable")
    same = value[order][1:] == value[order][:-1]
    maybe = at[order[np.r_[False, same] | np.r_[same, False]]]
    if not len(maybe):
        return np.zeros(len(n), np.int64)
    runs = np.c_[doc[maybe], codes[maybe[:, None] + np.arange(window)]]
    _, which, times = np.unique(runs, axis=0, return_inverse=True, return_counts=True)
    twice = maybe[times[which.reshape(-1)] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return np.bincount(doc[np.cumsum(edge)[:-1] > 0], minlength=len(n))


def statistics(raw: np.ndarray, at: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """``COUNTS`` (longs) and ``FEATURES`` (doubles) of texts given as bytes end to end with their offsets."""
    data, rows = raw.tobytes(), len(at) - 1

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][at])

    docs, lines, dup_lines = [], np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        text = data[a:b]
        docs.append(text.split())
        own = [line for line in text.split(b"\n") if line.strip()]
        lines[i], dup_lines[i] = len(own), len(own) - len(set(own))
    n = np.fromiter(map(len, docs), np.int64, rows)
    codes = words.of(docs)
    full = ~_blank[raw]
    chars = per_text(full & ~_later[raw])
    letters = per_text(_letter[raw])
    repeats = repeated_words(codes, n)
    counts = np.stack([n, chars, per_text(_symbol[raw]), dup_lines, repeats], axis=1)

    doc = np.repeat(np.arange(rows), n)
    again = np.r_[False, (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])] if len(codes) else np.zeros(0, bool)
    distinct = np.bincount(np.unique(doc * np.int64(max(1, len(words))) + codes) // max(1, len(words)), minlength=rows)
    lengths = np.fromiter((len(w) for d in docs for w in d), np.int64, len(codes))
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, doc, lengths)
    starts = np.flatnonzero(full & np.r_[True, ~full[:-1]] | _starts(full, at))
    bare = np.zeros(rows, np.int64)
    if len(starts):
        has = np.add.reduceat((_letter | _digit)[raw].astype(np.int64), starts) == 0
        bare = np.bincount(np.searchsorted(at, starts[has], "right") - 1, minlength=rows)
    per_word, per_char, per_letter, per_line = (1 / np.maximum(1, x) for x in (n, chars, letters, lines))
    features = np.stack(
        [
            np.log1p(n), chars * per_word, counts[:, 2] * per_word, per_text(_upper[raw]) * per_letter, per_text(_digit[raw]) * per_char,
            per_text(_mark[raw]) * per_char, per_text(raw == 33) * per_word, dup_lines * per_line, repeats * per_word, distinct * per_word,
            np.bincount(doc[again], minlength=rows) * per_word, np.log1p(n * per_line), bare * per_word, np.log1p(longest), per_text(raw >= 192) * per_char,
        ],
        axis=1,
    )
    return counts, features


def _starts(full: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where a text begins with a word, whatever the text before ended with."""
    out = np.zeros(len(full), bool)
    first = at[:-1][at[:-1] < at[1:]]
    out[first] = full[first]
    return out


# ---- trees -----------------------------------------------------------------------------------------------------


@dataclass
class Forest:
    """All trees as arrays of nodes; a node with a child of -1 is a leaf. A row goes right where its feature is above the threshold."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each row; every row walks all trees at once."""
        total = np.full(len(x), self.start)
        if len(self.roots) and len(x):
            node = np.tile(self.roots, (len(x), 1))
            rows = np.arange(len(x))[:, None]
            while (inner := self.child[node] >= 0).any():
                node = np.where(inner, self.child[node] + (x[rows, self.feature[node]] > self.threshold[node]), node)
            total = total + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def grow(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 1.0, ridge: float = 1.0
) -> Forest:
    """Boosted trees on the rows ``x`` with labels ``y`` (0 or 1).

    A split on a constrained feature is taken only where the two sides' values stand in its order, and everything below
    stays on its side of their mean, so the whole tree keeps the constraint.
    """
    empty = np.zeros(0, np.int64)
    if not len(y):
        return Forest(0.0, empty, empty, np.zeros(0), empty, np.zeros(0))
    cuts = [np.unique(np.quantile(col, np.arange(1, bins) / bins, method="lower")) for col in x.T]
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], axis=1)  # bin b: at most cuts[b]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    roots, feature, threshold, child, value = [], [], [], [], []

    def add() -> int:
        for column, blank in ((feature, 0), (threshold, 0.0), (child, -1), (value, 0.0)):
            column.append(blank)
        return len(value) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        root = add()
        roots.append(root)
        level = [(root, np.arange(len(y)), -np.inf, np.inf)]
        for d in range(depth + 1):
            below = []
            for node, rows, low, high in level:
                g_all, h_all = g[rows].sum(), h[rows].sum()
                own = float(np.clip(-g_all / (h_all + ridge), low, high))
                value[node] = rate * own
                best = _best_split(binned[rows], g[rows], h[rows], g_all, h_all, monotone, bins, low, high, least, ridge) if d < depth else None
                if best is None:
                    total[rows] += value[node]
                    continue
                f, b, left, right = best
                feature[node], threshold[node], child[node] = f, float(cuts[f][b]), add()
                add()
                goes = binned[rows, f] > b
                middle = (left + right) / 2
                bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(monotone[f])]
                below += [(child[node], rows[~goes], *bounds[0]), (child[node] + 1, rows[goes], *bounds[1])]
            level = below
    return Forest(start, np.array(roots), np.array(feature), np.array(threshold), np.array(child), np.array(value))


def _best_split(binned, g, h, g_all, h_all, monotone, bins, low, high, least, ridge) -> tuple[int, int, float, float] | None:
    """(feature, last bin on the left, left value, right value) of the largest gain; ties to the first."""

    def loss(gs, hs, w):
        return -(gs * w + (hs + ridge) * w * w / 2)

    whole = np.clip(-g_all / (h_all + ridge), low, high)
    best, found = 1e-6 + loss(g_all, h_all, whole), None
    for f in range(binned.shape[1]):
        gl = np.cumsum(np.bincount(binned[:, f], g, bins))[:-1]
        hl = np.cumsum(np.bincount(binned[:, f], h, bins))[:-1]
        gr, hr = g_all - gl, h_all - hl
        left, right = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
        gain = np.where((hl >= least) & (hr >= least) & ((right - left) * monotone[f] >= 0), loss(gl, hl, left) + loss(gr, hr, right), -np.inf)
        b = int(gain.argmax())
        if gain[b] > best:
            best, found = gain[b], (f, b, float(left[b]), float(right[b]))
    return found


# ---- on Spark --------------------------------------------------------------------------------------------------


def train_rules(docs: DataFrame, labels: DataFrame, sample: int = 16_384, **growing) -> Forest:
    """Trees fitted to at most ``sample`` labelled rows outside the held-out fold (those of least hash of the id).

    Several labels of a document count as their mean; null labels do not count. Statistics are taken where the texts
    are; only the sample's numbers, ``sample`` rows of fifteen doubles, meet in one task. Without labels there is no tree.
    """
    one = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = one.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    chosen = staged(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "rules-sample")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of 16 bytes
    monotone = np.array([MONOTONE.get(f, 0) for f in FEATURES])

    def measure(batches):
        words = Words()
        for batch in small_batches(batches, "text"):
            _, x = statistics(*byte_column(batch.column("text")), words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["x"].to_numpy())
        order = np.lexsort((*x.T, part["y"].to_numpy()))  # the same model however rows arrive
        forest = grow(x[order], part["y"].to_numpy()[order], monotone, **growing)
        return pd.DataFrame({k: [np.atleast_1d(v).astype(np.float64).tolist()] for k, v in vars(forest).items()})

    arrays = ", ".join(f"{name} array<double>" for name in Forest.__dataclass_fields__)
    measured = rows.mapInArrow(measure, "doc_id long, y double, x array<double>").withColumn("model", F.lit(0))
    fitted = measured.groupBy("model").applyInPandas(learn, arrays).first()
    if fitted is None:
        return grow(np.zeros((0, len(FEATURES))), np.zeros(0), monotone)
    kinds = {"roots": np.int64, "feature": np.int64, "child": np.int64}
    return Forest(**{k: np.array(v, kinds.get(k, np.float64)) if k != "start" else v[0] for k, v in fitted.asDict().items()})


def apply_rules(docs: DataFrame, forest: Forest, least_words: int = 20, most_repeat_pct: int = 30, least_score: float = 0.5, prefix: str = "") -> DataFrame:
    """The columns of ``docs`` with ``COUNTS``, ``base_failed``, ``score`` and ``kept`` added, each after ``prefix``.

    A null text has no words. A text fails the base rules below ``least_words`` words, or where more than
    ``most_repeat_pct`` percent of them are in repeated runs; it is kept if it passes and the trees' score is ``least_score``
    or more. A column of ``docs`` with an added name is an error; choose a prefix then.
    """
    added = [*[T.StructField(prefix + c, T.LongType()) for c in COUNTS], T.StructField(prefix + "base_failed", T.BooleanType())]
    added += [T.StructField(prefix + "score", T.DoubleType()), T.StructField(prefix + "kept", T.BooleanType())]
    clash = {f.name.lower() for f in added} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        words = Words()
        for batch in small_batches(batches, "text"):
            counts, x = statistics(*byte_column(batch.column("text")), words)
            score = shared.value.score(x)
            failed = (counts[:, 0] < least_words) | (100 * counts[:, 4] > most_repeat_pct * counts[:, 0])
            arrays = [*batch.columns, *[pa.array(c) for c in counts.T], pa.array(failed), pa.array(score), pa.array(~failed & (score >= least_score))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *[f.name for f in added]])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def quality_rules(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``score`` and ``kept`` for every row of ``docs``; see ``train_rules`` and ``apply_rules``.

    Repeated rows and rows without an id are judged each by their own text. An empty table gives an empty result.
    """
    forest = train_rules(docs, labels, **training)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return apply_rules(rows, forest).drop("text")
