"""Packing by lexical retrieval: a sharded BM25 index names the neighbours that fill a seed document's window.

Documents become token ids, closed by an end id. Term statistics (document frequencies, mean length) come from all
documents. Documents are dealt over shards of about ``shard_docs`` by content: a tree of splits, learnt on a sample, over
projected term weights gives the coarse place, a weighted min-hash of the terms the fine one, and documents next to each
other in that order share a shard. Each shard holds an inverted index of its own over what is left of its documents after
their full windows. In turn the next unused document seeds a window and its terms are looked up; unused neighbours follow
by BM25 score until the window is full, the last one cut, its rest still unused. So every window is full but the last of a
shard, which is cut into powers of two and needs no padding either.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_column, small_batches, staged, texts_of

# A chunk is a run of letters up to white space or a punctuation mark, or else all up to white space: no token spans two.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
CHUNK = re.compile(LETTERS + r"(?![^ \t-\r!-/:-@\[-`{-~])|[^ \t-\r]+")
WORD = re.compile(LETTERS)
TERMS = 1 << 16  # rows of the projection; a term id beyond takes the row of its rest
LEVELS, FINE = 8, 12  # bits of a bucket: leaf of the tree, hash of the leading term
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def byte_letters() -> dict[int, str]:
    """Letters to the characters that stand for their UTF-8 bytes in a byte-level vocabulary: a printable byte is its own."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    sign = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(192, 256)}


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start`` to ``start + size - 1`` of every pair, end to end."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Chunks(dict):
    """Chunk to code; the token ids of all codes lie end to end. Emptied when full.

    A run of letters is lower-cased and goes straight to the library's merges, which is what the whole tokenizer
    does with it; any other chunk goes through the whole tokenizer.
    """

    def __init__(self, path: str, most: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.merges, self.letters = self.tokenizer.model, byte_letters()
        self.plain = Tokenizer(self.merges)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary, suffix = self.tokenizer.get_vocab(), self.merges.end_of_word_suffix
        self.closes = np.zeros(1 + max(vocabulary.values()), bool)  # ids that end a word
        self.closes[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.new, self.ids, self.lengths = [], np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def __missing__(self, chunk: str) -> int:
        if not (chunk.islower() or not WORD.fullmatch(chunk)):
            code = self[chunk.lower()]
        else:
            code = len(self.lengths) + len(self.new)
            self.new.append(chunk)
        self[chunk] = code
        return code

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of letters end to end, and how many each has: some words to a call, told apart by the ids that end one."""
        shown = [w if w.isascii() else w.translate(self.letters) for w in words]
        lines = [" ".join(shown[i : i + 64]) for i in range(0, len(shown), 64)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.plain.encode_batch_fast(lines, add_special_tokens=False)), np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(words) and ends[-1:].sum() == len(ids):
            return ids, np.diff(np.r_[0, ends])
        single = [[t.id for t in self.merges.tokenize(w)] for w in shown]  # a vocabulary without such ids
        return np.fromiter(chain.from_iterable(single), np.uint32), np.fromiter(map(len, single), np.int64, len(single))

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks end to end, and how many each has."""
        word = np.fromiter((WORD.fullmatch(c) is not None for c in chunks), bool, len(chunks))
        ids, n = self._words([c for c, w in zip(chunks, word) if w])
        rest = [e.ids for e in self.tokenizer.encode_batch_fast([c for c, w in zip(chunks, word) if not w], add_special_tokens=False)]
        lengths = np.zeros(len(chunks), np.int64)
        lengths[word], lengths[~word] = n, [len(r) for r in rest]
        out, starts = np.zeros(int(lengths.sum()), np.uint32), np.cumsum(lengths) - lengths
        out[ranges(starts[word], lengths[word])] = ids
        out[ranges(starts[~word], lengths[~word])] = np.fromiter(chain.from_iterable(rest), np.uint32)
        return out, lengths

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts end to end, and how many each has."""
        if len(self) > self.most:
            self._empty()
        docs = [CHUNK.findall(t) for t in texts]
        n = np.fromiter(map(len, docs), np.int64, len(docs))
        codes = np.fromiter(map(self.__getitem__, chain.from_iterable(docs)), np.int64, int(n.sum()))
        if self.new:
            fresh, sizes = self._encode(self.new)
            self.ids, self.lengths, self.new = np.r_[self.ids, fresh], np.r_[self.lengths, sizes], []
        starts, sizes = (np.cumsum(self.lengths) - self.lengths)[codes], self.lengths[codes]
        lengths = np.add.reduceat(np.r_[sizes, 0], np.cumsum(n) - n) * (n > 0) if len(n) else n
        return self.ids[ranges(starts, sizes)], lengths


_chunks: dict[tuple, Chunks] = {}


def _encoder(path: str, cache: int) -> Chunks:
    if (path, cache) not in _chunks:
        _chunks[path, cache] = Chunks(path, cache)
    return _chunks[path, cache]


def term_counts(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, id and count of every distinct id of each document, in order of documents."""
    pair, count = np.unique((np.repeat(np.arange(len(n)), n) << 32) + ids, return_counts=True)
    return pair >> 32, pair & 0xFFFFFFFF, count


class Places:
    """Bucket of a document by its content: leaf of a tree of splits over projected term weights, then its leading term.

    A node splits the sample's documents at the median along the direction in which they differ most. The leading term
    is drawn by a min-hash weighted with the square of the BM25 weight, alike for documents with like terms.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, dims: int = 32):
        seen = np.bincount(term, minlength=TERMS)
        self.idf, self.dims = np.log1p((n - seen + 0.5) / (seen + 0.5)), dims
        self.mean = max(1.0, count.sum() / max(1, n))
        self.direction, self.middle = np.zeros((1 << LEVELS, dims), np.float32), np.zeros(1 << LEVELS, np.float32)
        vectors, node = self.vectors(doc, self.weights(doc, term, count, n), term, n), np.ones(n, np.int64)
        start = np.random.default_rng(7).standard_normal(dims).astype(np.float32)
        for at in range(1, 1 << LEVELS):
            own = np.flatnonzero(node == at)
            if len(own):
                away, line = vectors[own] - vectors[own].mean(axis=0), start
                for _ in range(8):
                    line = away.T @ (away @ line)
                    line /= max(float(np.linalg.norm(line)), 1e-9)
                self.direction[at], self.middle[at] = line, np.median(vectors[own] @ line)
                node[own] = 2 * at + (vectors[own] @ line > self.middle[at])

    def weights(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """BM25 weight of each term in its document."""
        length = np.bincount(doc, count, n)
        return self.idf[term] * count * 2.2 / (count + 1.2 * (0.25 + 0.75 * length[doc] / self.mean))

    def vectors(self, doc: np.ndarray, weight: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        if not hasattr(self, "table"):
            self.table = np.random.default_rng(11).standard_normal((TERMS, self.dims)).astype(np.float32)
        own, first = np.unique(doc, return_index=True)
        out = np.zeros((n, self.dims), np.float32)
        if len(own):
            out[own] = np.add.reduceat(self.table[term] * weight[:, None].astype(np.float32), first)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "draw")}  # made again from their seeds

    def buckets(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """Bucket of each of ``n`` documents, given their terms and counts."""
        term = term % TERMS
        weight = self.weights(doc, term, count, n)
        vectors, node = self.vectors(doc, weight, term, n), np.ones(n, np.int64)
        for _ in range(LEVELS):
            node = 2 * node + (np.einsum("ij,ij->i", vectors, self.direction[node]) > self.middle[node])
        if not hasattr(self, "draw"):
            self.draw = np.random.default_rng(13).exponential(size=TERMS)
        drawn = self.draw[term] / np.maximum(weight, 1e-9) ** 2
        own, first = np.unique(doc, return_index=True)
        leading = np.zeros(n, np.int64)
        if len(own):
            least = np.flatnonzero(drawn == np.repeat(np.minimum.reduceat(drawn, first), np.diff(np.r_[first, len(doc)])))
            leading[doc[least[::-1]]] = term[least[::-1]]
        return (node - (1 << LEVELS) << FINE) + (leading * 40503 % TERMS >> 16 - FINE)


def places(docs: DataFrame, path: str, sample: int, cache: int = 300_000) -> Places:
    """``Places`` learnt on about ``sample`` of the rows, by a hash of where they stand."""
    every = max(1, docs.count() // sample)

    def run(batches):
        for batch in small_batches(batches, "text", 2 << 20):
            ids, n = _encoder(path, cache).encoded(texts_of(batch))
            doc, term, count = term_counts(ids, n)
            term %= TERMS
            cuts = np.searchsorted(doc, np.arange(1, len(n)))
            own = [pa.array([c.astype("<i4").tobytes() for c in np.split(x, cuts)], pa.binary()) for x in (term, count)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *own], ["row", "terms", "counts"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(every)) == 0).mapInArrow(run, "row long, terms binary, counts binary").toArrow().sort_by("row")
    terms, counts = ([np.frombuffer(b, "<i4") for b in some.column(c).to_pylist()] for c in ("terms", "counts"))
    n = np.fromiter(map(len, terms), np.int64, len(terms))
    flat = [np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (terms, counts)]
    return Places(np.repeat(np.arange(len(n)), n), *flat, len(n))


def token_ids(docs: DataFrame, path: str, end: int, learnt: Places, cache: int = 300_000) -> DataFrame:
    """``doc_id, row, bucket, n, ids`` for every row: ``n`` ids, packed unsigned 32-bit, the end id last; null is the empty text.

    Each task adds a row without these that holds ``seen``: in how many of its documents each id of the vocabulary occurs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learnt)
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "row", "bucket", "n")] + [(c, pa.binary()) for c in ("ids", "seen")])

    def run(batches):
        seen = np.zeros(end + 1, np.int64)
        for batch in small_batches(batches, "text", 2 << 20):
            ids, n = _encoder(path, cache).encoded(texts_of(batch))
            found = term_counts(ids, n)
            here = np.bincount(found[1], minlength=len(seen))
            here[end] = len(n)
            here[: len(seen)] += seen
            seen = here
            own = pa.array([np.append(c, end).astype("<u4").tobytes() for c in np.split(ids, np.cumsum(n)[:-1])], pa.binary())
            bucket = pa.array(shared.value.buckets(*found, len(n)), pa.int64())
            columns = [batch.column("doc_id"), batch.column("row"), bucket, pa.array(n + 1, pa.int64()), own, pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if seen.any():
            yield pa.RecordBatch.from_pylist([{"seen": seen.astype("<i8").tobytes()}], schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, row long, bucket long, n long, ids binary, seen binary")


def deal(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of each bucket, given the buckets' sizes in order.

    Neighbouring buckets are gathered, whole, into shards of about ``most`` (less than twice as many at worst); a larger
    bucket is divided over as many shards of its own as it needs.
    """
    parts = np.where(sizes > most, -(-sizes // most), 1)
    small = np.where(sizes > most, 0, sizes)
    middle = (2 * np.cumsum(small) - small) // (2 * most)
    base = int(middle.max(initial=0)) + 1
    first = np.where(sizes > most, base + np.cumsum(np.where(sizes > most, parts, 0)) - parts, middle)
    return first, parts


def term_statistics(encoded: DataFrame) -> tuple[int, float, np.ndarray]:
    """Documents, mean length, and the number of documents each id of the vocabulary occurs in."""

    def run(batches):
        for batch in batches:
            for own in batch.column("seen"):
                seen = np.frombuffer(own.as_buffer(), "<i8")
                term = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(seen[term])], ["term", "n"])

    seen = encoded.where("seen is not null").select("seen").mapInArrow(run, "term long, n long")
    counts = seen.groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row an id of the vocabulary
    total = encoded.agg(F.count("row").alias("n"), F.sum("n").alias("tokens")).first()
    found = np.zeros(1 + max((r["term"] for r in counts), default=0), np.int64)
    for r in counts:
        found[r["term"]] = r["n"]
    return total["n"], (total["tokens"] or 0) / max(1, total["n"]), found


class Index:
    """Inverted index of a shard with the BM25 weight of every posting."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float, k1: float = 1.2, b: float = 0.75):
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        of = np.repeat(np.arange(len(docs)), lengths)
        terms = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
        pair, tf = np.unique(terms * len(docs) + of, return_counts=True)
        self.n, term = len(docs), pair // max(1, len(docs))
        self.doc = pair % max(1, len(docs))
        self.weight = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[self.doc] / max(mean, 1.0)))
        self.vocabulary, self.first = np.unique(term, return_index=True)
        self.last = np.r_[self.first[1:], len(term)]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for the distinct terms of ``query``."""
        at = np.searchsorted(self.vocabulary, np.unique(query).astype(np.int64))
        first, size = self.first[at], (self.last - self.first)[at]
        take = ranges(first, size)
        return np.bincount(self.doc[take], self.weight[take], self.n)

    def narrow(self, stay: np.ndarray) -> None:
        """Drop the postings of documents that are used up; the others keep order and weights and are numbered anew."""
        take = stay[self.doc]
        before = np.r_[0, np.cumsum(take)]
        self.first, self.last = before[self.first], before[self.last]
        self.doc, self.weight, self.n = (np.cumsum(stay) - 1)[self.doc[take]], self.weight[take], int(stay.sum())


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of one shard."""
    pieces, sequence = [], 0
    left = np.array([len(d) % window for d in docs], np.int64)
    begin = np.array([len(d) for d in docs], np.int64) - left
    for i, d in enumerate(docs):
        for start in range(0, len(d) - len(d) % window, window):
            pieces.append((i, start, window, sequence, 0))
            sequence += 1
    index = Index([d[b:] for d, b in zip(docs, begin)], idf, mean)
    filled, seed, live = 0, 0, np.arange(len(docs))

    def take(i: int) -> None:
        nonlocal filled
        n = int(min(left[i], window - filled))
        pieces.append((i, int(begin[i]), n, sequence, filled))
        begin[i] += n
        left[i] -= n
        filled += n

    while seed < len(docs):
        if not left[seed]:
            seed += 1
            continue
        rest = docs[seed][begin[seed] :]
        take(seed)
        stay = left[live] > 0
        if 4 * np.count_nonzero(stay) < 3 * len(live):
            index.narrow(stay)
            live = live[stay]
        for i in live[np.argsort(-index.scores(rest), kind="stable")].tolist():
            if filled == window:
                break
            if left[i]:
                take(i)
        if filled < window:
            break  # nothing is left in the shard
        filled, sequence = 0, sequence + 1
    if filled:
        tail = [p for p in pieces if p[3] == sequence]
        pieces = [p for p in pieces if p[3] != sequence] + powers_of_two(tail, filled, sequence)
    return pieces


def powers_of_two(tail: list, filled: int, sequence: int) -> list:
    """The pieces of a window that is not full, as sequences whose lengths are powers of two."""
    out, room, size, offset = [], 0, 0, 0
    for i, start, length, _, _ in tail:
        while length:
            if not room:
                sequence += bool(size)
                size = room = 1 << (filled.bit_length() - 1)
                filled, offset = filled - size, 0
            n = min(room, length)
            out.append((i, start, n, sequence, offset))
            start, length, room, offset = start + n, length - n, room - n, offset + n
    return out


def pack_documents(docs: DataFrame, path: str, window: int = 2048, end: int = 1, shard_docs: int = 1000, shard_tokens: int = 2 << 20, sample: int = 4000) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``, ids packed as 32-bit.

    Null and empty texts are the end id alone. Each row is packed by itself, also where rows repeat or have no id. An
    empty table gives no piece. A shard holds about ``shard_docs`` documents or ``shard_tokens`` ids, whichever is less;
    a document counts for as many as its ids take the place of.
    """
    spark = docs.sparkSession
    encoded = staged(token_ids(docs, path, end, places(docs, path, sample)), "pack-ids")
    n, mean, seen = term_statistics(encoded)
    idf = np.log1p((n - seen + 0.5) / (seen + 0.5))
    shared = spark.sparkContext.broadcast((idf, mean))
    share = F.greatest(F.lit(1), F.ceil(F.col("n") * shard_docs / shard_tokens)).cast("long")
    rows = encoded.where("row is not null")
    sizes = rows.groupBy("bucket").agg(F.sum(share).alias("count")).toArrow().sort_by("bucket")  # at most 2 ** (LEVELS + FINE) rows
    first, parts = deal(sizes.column("count").to_numpy(), shard_docs)
    plan = pa.table({"place": sizes.column("bucket"), "first": pa.array(first, pa.int64()), "parts": pa.array(parts, pa.int64())})
    shards = F.broadcast(spark.createDataFrame(plan, "place long, first long, parts long"))

    def pack(group: pa.Table) -> pa.Table:
        frame = group.select(["shard", "doc_id", "row"]).to_pandas().reset_index()
        frame = frame.sort_values("row")
        own, ids = group.column("doc_id").to_pylist(), group.column("ids").to_pylist()
        order = frame["index"].tolist()
        tokens = [np.frombuffer(ids[i], np.uint32) for i in order]
        base = int(frame["shard"].iloc[0]) << 32
        cut = pack_shard(tokens, *shared.value, window)
        columns = [
            pa.array([own[order[p[0]]] for p in cut], pa.int64()), pa.array([p[1] for p in cut], pa.int64()), pa.array([p[2] for p in cut], pa.int64()),
            pa.array([len(tokens[p[0]]) for p in cut], pa.int64()), pa.array([base + p[3] for p in cut], pa.int64()), pa.array([p[4] for p in cut], pa.int64()),
            pa.array([tokens[p[0]][p[1] : p[1] + p[2]].tobytes() for p in cut], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    dealt = rows.join(shards, F.col("bucket") == F.col("place")).select("doc_id", "row", "ids", (F.col("first") + F.pmod(F.xxhash64("row"), "parts")).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(pack, PIECES)
