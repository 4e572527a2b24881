"""Language identification by prediction by partial matching under frozen statistics.

Each language has a byte context tree up to ``order`` bytes deep, grown from the words (runs of letters) of a bounded
sample of its documents, each word between two marks. The code length of a byte is exact: in the deepest known
context either its share, or the escape share times the code in the next shorter context (escape method C), down to
a flat code over 257 symbols. The trees do not change while scoring, so the cost of a run of ``order + 1`` bytes,
and with it that of a word, is a constant which a worker computes once and keeps in a bounded cache.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, small_batches, texts_of



def _other_numerals() -> str:
    """Ranges of what counts as part of a word to ``re`` without being a letter or a digit: fractions, Roman and circled numerals."""
    odd = [c for c in range(0x80, 0x110000) if (t := chr(c)).isalnum() and not t.isalpha() and not t.isdecimal()]
    first = [c for i, c in enumerate(odd) if not i or odd[i - 1] != c - 1]
    last = [c for i, c in enumerate(odd) if i + 1 == len(odd) or odd[i + 1] != c + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(first, last))


#: Runs of letters (category L).
WORD = re.compile(rf"[^\W\d_{_other_numerals()}]+")
START, END = b"\x01", b"\x02"


def contexts(words: Counter, order: int) -> Counter:
    """Counts of (context, next byte) for every context length up to ``order``."""
    seen: Counter = Counter()
    for word, n in words.items():
        coded = START + word.encode() + END
        for i in range(1, len(coded)):
            for k in range(min(order, i) + 1):
                seen[coded[i - k : i], coded[i]] += n
    return seen


class Trees:
    """Context trees of all languages: (context) to counts of next bytes, their sum and how many kinds."""

    def __init__(self, rows: Iterable, order: int):
        grown: dict = defaultdict(lambda: defaultdict(dict))
        for lang, context, byte, n in rows:
            grown[lang][bytes(context)][byte] = n
        self.order, self.languages = order, sorted(grown)
        self.nodes = [dict(grown[lang]) for lang in self.languages]
        self.sums = [{c: sum(d.values()) for c, d in tree.items()} for tree in self.nodes]

    def costs(self, gram: bytes) -> list[float]:
        """Bits for the last byte of ``gram`` after the bytes before it, in every language."""
        context, byte, out = gram[:-1], gram[-1], []
        for tree, sums in zip(self.nodes, self.sums):
            p = 1.0
            for k in range(len(context) + 1):
                node = tree.get(context[k:])
                if node:
                    whole = sums[context[k:]] + len(node)
                    if byte in node:
                        p *= node[byte] / whole
                        break
                    p *= len(node) / whole
            else:
                p /= 257
            out.append(-float(np.log2(p)))
        return out


class Scores:
    """Rows of code lengths for words, by way of rows for runs of bytes; each table is emptied when full."""

    def __init__(self, trees: Trees, most: int = 300_000):
        self.trees, self.most = trees, most
        self.grams, self.gram_rows = {}, []
        self._empty()

    def _empty(self) -> None:
        self.words, self.rows = {}, np.zeros((0, len(self.trees.languages)))

    def _gram(self, gram: bytes) -> int:
        row = self.grams.get(gram)
        if row is None:
            row = self.grams[gram] = len(self.gram_rows)
            self.gram_rows.append(self.trees.costs(gram))
        return row

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words, and total bits by language, of each text."""
        if len(self.words) > self.most:
            self._empty()
        if len(self.grams) > self.most:
            self.grams, self.gram_rows = {}, []
        docs = [WORD.findall(t.lower()) for t in texts]
        n = np.fromiter(map(len, docs), np.int64, len(docs))
        new = list({w for doc in docs for w in doc}.difference(self.words))
        if new:
            order, grams, lengths = self.trees.order, [], []
            for word in new:
                coded = START + word.encode() + END
                lengths.append(len(coded) - 1)
                grams += [self._gram(coded[max(0, i - order) : i + 1]) for i in range(1, len(coded))]
            at = np.cumsum(lengths) - lengths
            fresh = np.add.reduceat(np.array(self.gram_rows)[np.array(grams)], at, axis=0)
            self.words.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.rows = np.vstack([self.rows, fresh])
        codes = np.fromiter((c for doc in docs for c in map(self.words.__getitem__, doc)), np.int64, int(n.sum()))
        bits = np.zeros((len(docs), len(self.trees.languages)))
        full = n > 0
        if full.any():
            bits[full] = np.add.reduceat(self.rows[codes], (np.cumsum(n) - n)[full], axis=0)
        return n, bits


def train_languages(docs: DataFrame, sample: int = 1000, order: int = 4) -> Trees:
    """Context trees of every language from about ``sample`` of its documents outside the held-out fold.

    The sample is a hash threshold per language set from the counts of all rows, so it does not need a language's rows
    together. The trees are as large as a sample makes them, whatever the table's size.
    """
    own = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("h"))
    counts = own.groupBy("lang").agg(F.count("*").alias("n"))
    at_random = F.pmod(F.col("h"), F.lit(1 << 30)) < F.ceil(F.lit(float(sample)) / F.col("n") * (1 << 30))
    rows = own.join(F.broadcast(counts), "lang").where(at_random).select("lang", "text")  # one row a language, as the trees have

    def read(batches):
        words: dict = defaultdict(Counter)
        for batch in small_batches(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
                words[lang].update(WORD.findall(text.lower()))
        for lang, counter in words.items():
            seen = contexts(counter, order)
            arrays = [pa.array([lang] * len(seen), pa.string()), pa.array([c for c, _ in seen], pa.binary()), pa.array([b for _, b in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "context", "byte", "n"])

    grown = rows.mapInArrow(read, "lang string, context binary, byte int, n long").groupBy("lang", "context", "byte").agg(F.sum("n").alias("n"))
    return Trees([tuple(r) for r in grown.toLocalIterator()], order)  # as many as a sample makes them


def detect_language(docs: DataFrame, sample: int = 1000, order: int = 4) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    The language with the least bits; equal bits go to the first by code point. ``score`` is its posterior when all
    languages are alike beforehand. A text that is null or has no letter is ``und`` with score 0, and so is every text
    where no language was learned.
    """
    trees = train_languages(docs, sample, order)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        trees = shared.value
        table = Scores(trees)
        for batch in small_batches(batches, "text", 2 << 20):
            n, bits = table.of(texts_of(batch)) if trees.languages else (np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, 1)))
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(bits)), best]
            score = np.where(n > 0, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1), 0.0)
            names = [trees.languages[b] if k else "und" for b, k in zip(best, n)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    found = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
