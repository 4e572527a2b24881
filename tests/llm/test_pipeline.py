"""Each pipeline stage against brute force, and on rows with nulls, repeats, no rows and clashing column names."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SMALL_DIR
from pyspark.sql import functions as F
from stintwise.llm.mixing import mix_sources
from stintwise.llm.quality import quality_scores
from stintwise.llm.similar import similar_to_lower

STAGES = dict(corpus_pipeline.STAGES)
CLASHES = ["score", "key", "sha", "own", "times", "copy", "lowest", "row", "size", "rank", "fp", "node", "group", "spans"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL_DIR}/documents.parquet").cache()


def lowered(text):
    return (text or "").encode().lower()


def fingerprint(text):
    words = lowered(text).split()
    parts = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_quality_keeps_what_the_operator_accepts(spark, docs):
    scores = quality_scores(docs, spark.read.parquet(f"{SMALL_DIR}/labels.parquet")).collect()
    assert ids(STAGES["quality"](spark, docs, SMALL_DIR)) == Counter(r.doc_id for r in scores if r.predicted)


def test_exact_keeps_the_largest_id(spark, docs):
    last: dict = {}
    for r in docs.collect():
        last[lowered(r.text)] = max(r.doc_id, last.get(lowered(r.text), r.doc_id))
    assert ids(STAGES["exact"](spark, docs, SMALL_DIR)) == Counter(last.values())


def lowest_of_components(rows):
    """The smallest ids of the components that fingerprints of at most 4 differing bits make."""
    values, low = np.array([fingerprint(t) for _, t in rows], np.uint64), np.array([i for i, _ in rows])
    linked = np.bitwise_count(values[:, None] ^ values[None]) <= 4
    while True:
        new = np.where(linked, low[None], np.iinfo(np.int64).max).min(axis=1)
        if (new == low).all():
            return set(low.tolist())
        low = new


def shingles(text):
    words = lowered(text).split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(one, two):
    return len(one & two) >= 0.8 * len(one | two) > 0


def test_near_leaves_one_of_each_group(spark, docs):
    """By brute force: of SimHash components the smallest ids; of these no two alike stay, and who goes is alike to a smaller one."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    lowest = lowest_of_components(rows)
    whole = [(i, shingles(t)) for i, t in rows if i in lowest]
    stay = set(ids(STAGES["near"](spark, docs, SMALL_DIR)))
    tied = {i: {j for j, t in whole if j < i and alike(s, t)} for i, s in whole}
    assert stay <= lowest and len(stay) < len(rows)
    assert all(not tied[i] & stay for i in stay) and all(tied[i] for i in lowest - stay)


def test_similar_finds_what_is_over_four_bits_apart(spark, docs):
    """Two scattered words of 200 differ, similarity 0.9: mostly more than 4 bits apart."""
    random.seed(4)
    rows = []
    for i in range(40):
        words = [f"w{random.randrange(10**6)}" for _ in range(200)]
        rows.append((i, " ".join(words)))
        words[50 + i], words[150] = "other", "words"
        rows.append((100 + i, " ".join(words)))
    edited = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(lowest_of_components(rows)) > 45
    assert {r.similar_id for r in similar_to_lower(edited).collect()} == set(range(100, 140))
    assert ids(STAGES["near"](spark, edited, SMALL_DIR)) == Counter(range(40))
    whole = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    gone = {r.similar_id for r in similar_to_lower(docs).collect()}
    tied = {i: {j for j, t in whole if j < i and alike(s, t)} for i, s in whole}
    assert all(tied[i] <= gone for i in tied if i not in gone) and all(tied[i] for i in gone) and gone


def test_similar_in_a_large_group_of_near_copies(spark):
    """300 edits of one text, many of them just below 0.8 to each other, go through all rounds and longer keys."""
    random.seed(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in random.sample(range(60), random.randint(0, 2)):
            words[at] = f"x{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    sets = dict((i, shingles(t)) for i, t in rows)
    gone = {r.similar_id for r in similar_to_lower(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    stay = sorted(set(sets) - gone)
    pairs = [(i, j) for n, i in enumerate(stay) for j in stay[:n] if alike(sets[i], sets[j])]
    assert not pairs and all(any(alike(sets[i], sets[j]) for j in range(i)) for i in gone)


def test_mixed_takes_whole_documents(spark, docs):
    times = Counter()
    for r in mix_sources(docs).collect():
        share = r.taken / r["size"] if r["size"] else 0.0
        times[r.doc_id] += int(share + 0.5)
    assert ids(STAGES["mixed"](spark, docs, SMALL_DIR)) == +times


def test_packed_is_a_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces: dict = {}
    for r in STAGES["packed"](spark, docs, SMALL_DIR).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    want = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for r in docs.collect()}
    assert {i: b"".join(b for _, b in sorted(p)) for i, p in pieces.items()} == want


@pytest.mark.parametrize("stage", list(STAGES))
def test_edge_cases(spark, stage):
    """Nulls in any column, empty and long texts, repeated rows and columns named like those a stage works with."""
    extra = ("x",) * len(CLASHES)
    texts = [None, "", " ", "plain words in a row of a text", "PLAIN words in a row of a text", "long " * 30_000]
    rows = [(i, t, None, None if i % 2 else "a", None, *extra) for i, t in enumerate(texts)]
    rows += [rows[3], (None, texts[3] + " more of it", "en", "a", 1, *extra), (None, None, None, None, None, *[None] * len(extra))]
    given = spark.createDataFrame(rows, SCHEMA)
    out = STAGES[stage](spark, given, SMALL_DIR)
    found = out.collect()
    if stage == "packed":
        assert out.select(F.sum("length")).first()[0] > len(rows)
    else:
        assert out.columns == given.columns and {tuple(r) for r in found} <= set(rows)
    if stage == "exact":
        assert sorted(str(r.doc_id) for r in found) == ["1", "2", "4", "5", "None"]
    if stage == "near":
        assert {0, 3, 5, None} <= {r.doc_id for r in found} and not {1, 2} & {r.doc_id for r in found}
    assert STAGES[stage](spark, given.limit(0), SMALL_DIR).count() == 0


def test_run_chains_the_stages(spark):
    out = corpus_pipeline.run(spark, SMALL_DIR)
    assert out.where("length < 1 or length > 2048").count() == 0 and out.count() > 0
