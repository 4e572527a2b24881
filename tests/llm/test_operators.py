"""The operators against brute force on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from compare import differences, duck
from conftest import SF_DIR
from pyspark.sql import functions as F
from stintwise.llm import line_dedup, packing, simhash, suffix_dedup
from stintwise.llm.exact_dedup import exact_dedup
from stintwise.llm.language_id import detect_language
from stintwise.llm.mixing import mix_sources
from stintwise.llm.nearest import nearest
from stintwise.llm.quality import quality_scores
from stintwise.llm.queries import ORACLE, REGISTRY
from stintwise.llm.token_counts import token_counts

SCHEMA = "doc_id long, text string, lang string, source string, row string, size long, rank int, key string, n string"
BPE, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def table(spark, rows):
    extra = ("x", 7, 1, "k", "n")
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    random.seed(3)
    words = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta,", "eta.", "THETA!", "iota", "ж"]
    passage = " ".join(random.choice(words) for _ in range(30))
    out = [None, "", " ", "\n\n", "a", "A", passage, passage.upper(), passage + " tail", "head " + passage, "z" * 5000, "z" * 5000, "<s> ▁x </s>\x00"]
    out += [" ".join(random.choice(words) for _ in range(random.randint(1, 300))) for _ in range(40)]
    out += [out[20] + " one more", out[21][:-9] + passage, passage + "\n" + out[22] + "\n" + passage]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    langs, sources = ["en", None, "de"], ["b", "a", None, "b"]
    rows = [(i, t, langs[i % 3], sources[i % 4]) for i, t in enumerate(texts)]
    return table(spark, [*rows, rows[20], (None, "no id " * 20, None, None)]).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def given(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_token_counts(docs, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=BPE)
    want = Counter((i, len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 100) for i, t in given(docs))
    assert Counter(map(tuple, token_counts(docs, BPE, limit=100, frequent=50, cache=20).collect())) == want
    assert token_counts(empty, BPE).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_links_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "TILE", 8)
    random.seed(1)
    lines = ["".join(random.choice("ab") for _ in range(random.randint(16, 20))) for _ in range(60)]
    lines = list(dict.fromkeys(lines + [x[:5] + x[6:] for x in lines] + [x[:7] + "c" + x[7:12] + x[13:] for x in lines]))
    lines = [x for x in lines if len(x) >= 16]
    got = {(r.a, r.b) for r in line_dedup.line_links(spark.createDataFrame(list(enumerate(lines)), "id long, line string"), 2, 16).collect()}
    assert got == {(i, j) for i, a in enumerate(lines) for j, b in enumerate(lines) if i < j and edits(a, b) <= 2}


def test_line_classes(docs, empty):
    rows = line_dedup.line_classes(docs).collect()
    every = [(i, n, x) for i, t in given(docs) for n, x in enumerate(t.split("\n"))]
    assert Counter((r.doc_id, r.line_no) for r in rows) == Counter((i, n) for i, n, _ in every)
    distinct = sorted({x for _, _, x in every})
    near = {x: {y for y in distinct if x != y and min(len(x), len(y)) >= 16 and abs(len(x) - len(y)) <= 2 and edits(x, y) <= 2} for x in distinct}
    sha = {x: hashlib.sha256(x.encode()).hexdigest() for x in distinct}
    least = dict(sha)
    while (new := {x: min([least[x], *(least[y] for y in near[x])]) for x in distinct}) != least:
        least = new
    assert Counter((r.doc_id, r.line_no, r.class_id, r.n_links) for r in rows) == Counter((i, n, least[x], len(near[x])) for i, n, x in every)
    first: dict = {}
    for i, n, x in every:
        first[least[x]] = min(first.get(least[x], (2, 0, 0)), (int(i is None), i or 0, n))
    assert all(r.kept == (first[r.class_id] == (int(r.doc_id is None), r.doc_id or 0, r.line_no)) for r in rows)
    assert line_dedup.line_classes(empty).count() == 0


def test_quality(spark, docs, empty):
    good = [(i, "plain words in a row " * 5, "en", "a") for i in range(0, 60, 2)]
    bad = [(i, "### !!! $$$ " * 9, "en", "a") for i in range(1, 60, 2)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(60)] + [(3, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(table(spark, good + bad + [(100, None, None, None)]), labels).collect()
    assert len(got) == 61 and all(r.predicted == int(r.doc_id % 2 == 0) for r in got if r.doc_id < 60)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert quality_scores(docs, labels.limit(0)).count() == docs.count() and quality_scores(empty, labels).count() == 0


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held = REGISTRY["op3_quality"](spark, SF_DIR).where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert sum(p == q for p, q in held) / len(held) > 0.95


def test_exact_dedup(docs, empty):
    rows = exact_dedup(docs, first_digit=4, widening=4).collect()
    low = lambda t: bytes(t, "utf-8").lower()
    groups: dict = {}
    for i, t in given(docs):
        groups.setdefault(low(t), []).append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(t).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups) and all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert exact_dedup(empty).count() == 0


def test_mixing(docs, empty):
    rows = mix_sources(docs, block=16, least_slots=4).collect()
    assert len(rows) == docs.count() and sum(r["size"] for r in rows) == sum(len(t.split()) for _, t in given(docs))
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    by_source: dict = {}
    for r in rows:
        by_source.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(sum(taken) == int(target) for (_, target), taken in by_source.items())
    assert sum(t for _, t in by_source) == pytest.approx(1.5 * sum(s for s, _ in by_source))
    assert sorted(map(str, mix_sources(docs, block=16, least_slots=4).collect())) == sorted(map(str, rows))
    assert mix_sources(empty).count() == 0


def test_language(spark, docs, empty):
    rows = detect_language(docs).collect()
    none = [r for r in rows if r.doc_id is not None and r.doc_id < 4]
    assert len(rows) == docs.count() and {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in rows) and detect_language(empty).count() == 0
    held = REGISTRY["op6_language_id"](spark, SF_DIR).where("held_out").join(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id")
    found = held.select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert found > 0.97


def test_packing_is_a_round_trip(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(docs, WORDS, window=64, shard_docs=20).collect()
    want = Counter((i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in given(docs))
    assert sum(r.length for r in rows) == sum(len(b) // 4 * n for (_, b), n in want.items())
    once = {i: b for (i, b), n in want.items() if n == 1}
    for i, whole in once.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == whole and all(r.doc_tokens == len(whole) // 4 for r in own)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0
    assert packing.pack_documents(empty, WORDS).count() == 0


def test_packing_deals_like_documents_to_one_shard(spark):
    """Pairs of documents that share their words stand far apart in the table; chance puts 2 % of them into one shard."""
    random.seed(11)
    words = ["".join(random.choices("abcdefghijklmnoprstuvz", k=6)) for _ in range(3000)]
    own = [random.sample(words, 12) for _ in range(500)]
    rows = [(i, " ".join(random.sample(own[i % 500], 11)), "en", "a") for i in range(1000)]
    pieces = packing.pack_documents(table(spark, rows), WORDS, window=256, shard_docs=20).collect()
    shard = {r.doc_id: r.sequence_id >> 32 for r in pieces}
    assert sum(shard[i] == shard[i + 500] for i in range(500)) >= 200
    assert max(Counter(shard.values()).values()) < 40


def test_packing_shards_are_bounded_by_size():
    sizes = np.array([3, 1, 70, 2, 4, 10, 1, 1, 25, 9])
    first, parts = packing.deal(sizes, 10)
    assert parts.tolist() == [1, 1, 7, 1, 1, 1, 1, 1, 3, 1]
    held = Counter()
    for size, f, p in zip(sizes.tolist(), first.tolist(), parts.tolist()):
        for k in range(p):
            held[f + k] += -(-size // p)
    assert max(held.values()) < 20 and np.diff(first[parts == 1]).min() >= 0


def fingerprint(text):
    words = text.encode().lower().split()
    parts = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id by fingerprint, from all pairs."""
    values = np.array(sorted(prints), np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None]) <= 4, 1))
    root = list(range(len(values)))
    for i, j in zip(a.tolist(), b.tolist()):
        low, high = sorted((root[i], root[j]))
        root = [low if r == high else r for r in root]
    least: dict = {}
    for v, r in zip(values.tolist(), root):
        least[r] = min(least.get(r, 1 << 62), prints[v])
    return {v: least[r] for v, r in zip(values.tolist(), root)}


def test_simhash(docs, empty):
    rows = simhash.simhash_groups(docs).collect()
    prints: dict = {}
    for i, t in given(docs):
        if i is not None:
            prints[fingerprint(t)] = min(i, prints.get(fingerprint(t), 1 << 62))
    want = components(prints)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in rows) == Counter((i, fingerprint(t), want.get(fingerprint(t))) for i, t in given(docs))
    assert simhash.simhash_groups(empty).count() == 0


@pytest.mark.parametrize("piece", [16, 2048])
def test_simhash_links_in_crowded_runs(spark, monkeypatch, piece):
    """Fingerprints a few bits around few centres share most keys; pieces, edges and whole groups must lose nothing."""
    monkeypatch.setattr(simhash, "PIECE", piece)
    random.seed(5)
    values = set()
    for _ in range(4):
        centre = random.getrandbits(64)
        for _ in range(120):
            v = centre
            for _ in range(random.randint(0, 7)):
                v ^= 1 << random.randrange(64)
            values.add(v)
    prints = {v: i for i, v in enumerate(sorted(values))}
    nodes = spark.createDataFrame([(simhash.signed(v), i) for v, i in prints.items()], "fp long, rep long")
    roots = {r.node: r.root for r in simhash.connected_components(simhash.links(nodes)).collect()}
    assert {v: roots.get(i, i) for v, i in prints.items()} == components(prints)


def test_nearest(spark):
    random.seed(8)
    vectors = [[random.gauss(0, 1) for _ in range(8)] for _ in range(900)]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(900 + i, vectors[0], "x") for i in range(60)]
    rows += [(2000, None, "x"), (2020, [0.0] * 8, "x"), (2040, [float("nan")] * 8, "x"), (2060, [None] + [1.0] * 7, "x"), (2080, [1.0], "x"), (None, vectors[1], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got: dict = {}
    for r in nearest(table, leaf=16, part=100).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = list(range(960))
    all_rows = np.array([v for _, v, _ in rows[:960]], np.float32).astype(np.float64)
    hits = 0
    for q in range(0, 960, 20):
        scores = (all_rows * all_rows[q]).sum(axis=1)
        best = sorted((i for i in ids if i != q), key=lambda i: (-scores[i], i))[:20]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21)) and all(m[2] == scores[m[1]] for m in mine)
        hits += len({m[1] for m in mine} & set(best))
    assert set(got) == set(range(0, 960, 20)) and hits / (48 * 20) >= 0.9
    assert nearest(table.limit(0)).count() == 0 and nearest(table.where("vec_id = 20")).count() == 0


def without_repeats(pairs, width=50):
    top = 1 << 62
    least: dict = {}
    for i, t in pairs:
        for p in range(len(t) - width + 1):
            s = t[p : p + width]
            least[s] = min(least.get(s, top), top if i is None else i)
    out = Counter()
    for i, t in pairs:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - width + 1):
            if least[t[p : p + width]] < (top if i is None else i):
                gone[p : p + width] = True
        runs = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(t) else 0
        out[i, len(t), int(gone.sum()), runs, np.frombuffer(t, np.uint8)[~gone[: len(t)]].tobytes()] += 1
    return out


def test_suffix_dedup(docs, empty):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.suffix_dedup(docs).collect())
    assert got == without_repeats([(i, t.encode()) for i, t in given(docs)])
    assert suffix_dedup.suffix_dedup(empty).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(REGISTRY[name](spark, SF_DIR), duck(SF_DIR), ORACLE[name]) == []


def test_language_letters_and_code_lengths(spark, docs):
    """Numerals that are no digits are no letters; costs are those of a plain PPM over all counts."""
    import math

    from stintwise.llm import language_id

    odd = [(900, "½ ½ ²"), (901, "① ②"), (902, "Ⅷ 12 ٣ _"), (903, "½a"), (904, "ª")]
    rows = spark.createDataFrame([(i, t, None, None, "x", 7, 1, "k", "n") for i, t in odd], SCHEMA)
    found = {r.doc_id: r.lang_pred for r in detect_language(docs.unionAll(rows)).collect()}
    assert [found[i] for i in (900, 901, 902)] == ["und"] * 3 and found[903] != "und" and found[904] != "und"

    learned = [t for i, t, lang in ((r.doc_id, r.text, r.lang) for r in docs.collect()) if lang == "en" and __import__("zlib").crc32(str("" if i is None else i).encode()) % 3 != 1]
    counts = {}
    for text in learned:
        for word in language_id.WORD.findall((text or "").lower()):
            coded = b"\x01" + word.encode() + b"\x02"
            for at in range(1, len(coded)):
                for k in range(min(4, at) + 1):
                    counts.setdefault(coded[at - k : at], Counter())[coded[at]] += 1

    def bits(context, byte):
        p = 1.0
        for k in range(len(context) + 1):
            node = counts.get(context[k:])
            if node:
                whole = sum(node.values()) + len(node)
                if byte in node:
                    return -math.log2(p * node[byte] / whole)
                p *= len(node) / whole
        return -math.log2(p / 257)

    trees = language_id.train_languages(docs, sample=10**6)
    place = trees.languages.index("en")
    for gram in (b"\x01alph", b"alpha", b"eta\x02", b"\x01zq", b"zzzzq", b"\x01\xd0", b"mma\x02"):
        assert trees.costs(gram)[place] == pytest.approx(bits(gram[:-1], gram[-1]))


def test_nearest_of_two_lengths_and_tight_clusters(spark):
    """Every usable row takes part whatever its length, and a query finds k rows even where its own leaves hold few."""
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=8 if i % 5 < 3 else 5).tolist()) for i in range(400)]
    rows += [(1000 + i, (np.array([50.0, 0, 0, 0, 0, 0, 0, 0]) + 1e-3 * rng.normal(size=8)).tolist()) for i in range(25)]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=20, leaf=4, recall=0.5, calibration=8).collect()
    answers = Counter(r.query_id for r in found)
    asked = [i for i, _ in rows if i % 20 == 0]
    assert answers == {i: 20 for i in asked}
    length = {i: len(v) for i, v in rows}
    assert all(length[r.query_id] == length[r.vec_id] and r.query_id != r.vec_id for r in found)


def test_mix_follows_the_points(spark, docs, monkeypatch):
    """Shares of every prefix of the mix come from the sequence; other points give documents other places."""
    from stintwise.llm import mixing

    shares = spark.createDataFrame([(0, 0.0, 0.5), (1, 0.5, 0.6), (2, 0.6, 1.0)], "nth long, low double, high double")
    slots = mixing.slot_ranks(spark, 2000, shares, 64, run=100).orderBy("slot").collect()
    assert [s.slot for s in slots] == list(range(2000))
    for upto in (10, 100, 777, 2000):
        got = Counter(s.nth for s in slots[:upto])
        assert all(abs(got[nth] - upto * share) <= 3 for nth, share in ((0, 0.5), (1, 0.1), (2, 0.4)))
    places = sorted((str(r.doc_id), r.taken, r.first_slot) for r in mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "GOLDEN", 0.0)
    others = sorted((str(r.doc_id), r.taken, r.first_slot) for r in mix_sources(docs).collect())
    assert [p[:2] for p in places] == [p[:2] for p in others] and places != others
    assert all((slot is None) == (taken == 0) for _, taken, slot in places)


def test_exact_dedup_of_rows_from_a_shuffle(spark, docs):
    """Row numbers are written once, so a source that comes in another order each time still keeps one row a group."""
    shuffled = docs.orderBy(F.rand()).repartition(7)
    found = exact_dedup(shuffled).collect()
    groups = Counter(r.text_sha256 for r in found)
    assert Counter(r.text_sha256 for r in found if r.kept) == {sha: 1 for sha in groups}


def test_packing_statistics_and_greedy_order_against_a_plain_loop(docs):
    learnt = packing.places(docs, WORDS, 100)
    encoded = packing.token_ids(docs, WORDS, 1, learnt).cache()
    n, mean, seen = packing.term_statistics(encoded)
    held = [np.frombuffer(r["ids"], np.uint32) for r in encoded.where("row is not null").orderBy("row").collect()]
    assert n == len(held) == docs.count() and abs(mean - sum(map(len, held)) / n) < 1e-9
    for term in range(len(seen)):
        assert seen[term] == sum(term in set(h.tolist()) for h in held) if seen[term] else True
    assert {t for h in held for t in h.tolist()} == set(np.flatnonzero(seen).tolist())
    idf, window = np.log1p((n - seen + 0.5) / (seen + 0.5)), 48
    left = [len(h) % window for h in held]
    body = [h[len(h) - k :].tolist() for h, k in zip(held, left)]

    def score(query, d):
        total = 0.0
        for t in sorted(set(query)):
            tf = body[d].count(t)
            total += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(body[d]) / max(mean, 1.0))) if tf else 0.0
        return total

    want, rest = [], list(left)
    while any(rest):
        seed = next(i for i, k in enumerate(rest) if k)
        query, room, members = body[seed][len(body[seed]) - rest[seed] :], window, []
        ranked = sorted(range(len(body)), key=lambda d: -round(score(query, d), 9))
        for i in [seed, *ranked]:
            k = min(rest[i], room)
            if k:
                members.append((i, k))
                rest[i] -= k
                room -= k
        if room:
            break
        want.append(members)
    found = {}
    for i, _, length, sequence, _ in packing.pack_shard(held, idf, mean, window):
        found.setdefault(sequence, []).append((i, length))
    full = sum(len(h) // window for h in held)
    assert [found[full + k] for k in range(len(want))] == want
