"""Quality rules, conversation repair and whitening against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from stintwise.llm import repair, rules, whitening
from stintwise.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"

# ---- quality rules ---------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, score_ string, n_chars long"


def plain_counts(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    earlier = sum(bool(WORD.search(line)) and line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), earlier, len(covered)


@pytest.fixture(scope="module")
def odd_texts():
    random.seed(5)
    words = ["the", "of", "naïve", "ж", "***", "x#|", "And", " ", "a\x85b"]
    passage = " ".join(random.choice(words) for _ in range(12))
    texts = [None, "", " \n\t", "one", "\n\n", "a\na\n a\na", passage, f"{passage} {passage}", f"{passage}\n{passage}\r\n{passage}\x0b", "w " * 3000, "z" * 9000]
    texts += ["\n".join(" ".join(random.choice(words[:3]) for _ in range(random.randint(0, 9))) for _ in range(random.randint(1, 30))) for _ in range(60)]
    return texts


@pytest.fixture(scope="module")
def odd_docs(spark, odd_texts):
    rows = [(i, t, "en", "s", i) for i, t in enumerate(odd_texts)]
    return spark.createDataFrame([*rows, rows[7], (None, odd_texts[8], None, None, None)], DOCS).repartition(3)


def test_rules_counts(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(50)] + [(None, 1, 0), (3, None, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in rules.quality_rules(odd_docs, labels, trees=5).select("doc_id", *rules.COUNTS, "base_failed", "kept").collect()]
    for doc_id, *counts, failed, kept in got:
        assert failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (failed and kept)
    want = [(r.doc_id, *plain_counts(r.text)) for r in odd_docs.collect()]
    assert Counter(r[:6] for r in got) == Counter(want)


def test_rules_do_not_depend_on_partitions(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    one, two = (sorted(rules.quality_rules(d, labels, trees=8).select("doc_id", "score").collect(), key=str) for d in (odd_docs, odd_docs.repartition(7)))
    assert one == two


def test_rules_on_nothing(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.quality_rules(odd_docs.limit(0), labels).count() == 0
    kept = rules.quality_rules(odd_docs, labels).select("base_failed", "score", "kept").collect()
    assert all(r.score == 0.5 and r.kept != r.base_failed for r in kept)
    with pytest.raises(ValueError, match="score"):
        rules.apply_rules(odd_docs.withColumn("Score", F.lit(1)), rules.train_rules(odd_docs, labels))


def test_trees_against_plain_walk_and_constraints():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=600)) > 0.3).astype(float)
    monotone = np.array([1, 0, -1, 0])
    forest = rules.grow(x, y, monotone, trees=25, depth=3)

    def walk(row):
        total = forest.start
        for node in forest.roots:
            while forest.child[node] >= 0:
                node = forest.child[node] + (row[forest.feature[node]] > forest.threshold[node])
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x), [walk(r) for r in x])
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.75
    for f, way in ((0, 1), (2, -1)):
        moved = x.copy()
        moved[:, f] += rng.exponential(size=600)
        assert (way * (forest.score(moved) - forest.score(x)) >= -1e-12).all()


def test_best_split_is_the_best_of_all():
    rng = np.random.default_rng(4)
    binned, g, h = rng.integers(0, 6, (80, 3)), rng.normal(size=80), rng.uniform(0.1, 1, 80)

    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + 1) / 2

    gains = {(f, b): score(binned[:, f] <= b) + score(binned[:, f] > b) for f in range(3) for b in range(5)}
    f, b, left, right = rules._best_split(binned, g, h, g.sum(), h.sum(), np.zeros(3), 6, -np.inf, np.inf, 1.0, 1.0)
    assert gains[f, b] == pytest.approx(max(gains.values()))
    rows = binned[:, f] <= b
    assert left == pytest.approx(-g[rows].sum() / (h[rows].sum() + 1)) and right == pytest.approx(-g[~rows].sum() / (h[~rows].sum() + 1))


def test_rules_on_held_out_labels(spark):
    found = REGISTRY["op11_quality_rules"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality is not null and crc32(cast(doc_id as string)) % 3 = 1")
    rows = found.join(labels, "doc_id").where("not base_failed").select("kept", "quality").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.97


# ---- conversation repair ---------------------------------------------------------------------------------------


def plain_best(codes):
    """(cost, audit) by trying every sequence of edits that can be the cheapest: at most two inserts in a place."""
    best = {0: (0, "")}

    def inserted(level):
        for _ in range(2):
            for state, (cost, audit) in list(level.items()):
                to = 3 if state == 2 else 2
                level[to] = min(level.get(to, (99999, "")), (cost + 2, audit + "I"))
        return level

    for code in codes:
        role, fault, following = code & 3, code >> 2, {}
        for state, (cost, audit) in inserted(best).items():
            ways = [("D", 3, state)]
            if fault < 2:
                if (role, state) in {(0, 0), (1, 0), (1, 1), (1, 3), (2, 2)}:
                    ways.append(("K", fault, role + 1))
                ways.append(("R", 2 + fault, 3 if state == 2 else 2))
            for letter, added, to in ways:
                following[to] = min(following.get(to, (99999, "")), (cost + added, audit + letter))
        best = following
    return min(v for state, v in inserted(best).items() if state in (0, 3))


def test_search_against_all_edits():
    random.seed(1)
    for n in range(8):
        for _ in range(120):
            codes = [random.randrange(4) + 4 * random.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
            assert repair.search(codes) == plain_best(codes)
            for size in (1, 2, 3):
                parts = [codes[i : i + size] for i in range(0, n, size)]
                ways = repair.along([repair.segment_table(p, i == len(parts) - 1) for i, p in enumerate(parts)])
                assert n == 0 or (sum(w[1] for w in ways), "".join(w[2] for w in ways)) == plain_best(codes)


def test_bounds_never_exceed_the_cost():
    random.seed(2)
    for _ in range(100):
        codes = [random.randrange(4) + 4 * random.choice([0, 1, 2]) for _ in range(6)]
        for target in (None, 0, 1, 2, 3):
            least = repair.bounds(codes, target)
            for i in range(len(codes) + 1):
                for state in range(4):
                    found = repair.search(codes[i:], state, target)
                    assert found is None or least[i][state] <= found[0]


def plain_repair(rows):
    kept = {}
    for conv, turn, role, text in rows:
        own = kept.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, own in kept.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), hashlib.sha256(r[2].encode()).digest()))
        codes, faults = [], Counter()
        for i, (_, role, text) in enumerate(own):
            bare = text.rstrip(BLANKS)
            fault = 2 if not bare else 3 if (role, text) in [r[1:] for r in own[:i]] else int(bare[-1] not in ".!?")
            faults[fault] += 1
            codes.append("sua".find(role[:1] or "?") % 4 + 4 * fault)
        cost, audit = plain_best([c % 4 + 4 * min(c // 4, 2) for c in codes])
        lines, state, at = [], 0, 0
        for letter in audit:
            name = "assistant" if state == 2 else "user"
            if letter in "KR":
                lines.append(f"{own[at][1] if letter == 'K' else name}:{own[at][2]}")
                state = {"s": 1, "u": 2, "a": 3}[lines[-1][0]]
            elif letter == "I":
                lines.append(f"{name}:")
                state = 3 if state == 2 else 2
            at += letter != "I"
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults[2], faults[3], faults[1], pairs, cost, audit, digest)
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string, seq string, code int"


@pytest.fixture(scope="module")
def conversations(spark):
    random.seed(7)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "u"], ["a.", "b", "", None, " \n", "c!", "x. \n", "d?", "é…", "long " * 2000 + "."]
    rows = [(random.choice([1, 2, 3, 4, 5, None]), random.choice([None, *range(30)]), random.choice(roles), random.choice(texts)) for _ in range(300)]
    rows += [(7, 0, "user", "Hi.")] * 40 + [(8, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(90)]
    return spark.createDataFrame([(*r, "z", 1) for r in rows], CONVERSATIONS).repartition(5)


@pytest.mark.parametrize("segment", [1024, 4])
def test_repair_against_brute_force(conversations, segment):
    got = {r[0]: tuple(r[1:]) for r in repair.repaired_conversations(conversations, segment).collect()}
    assert got == plain_repair([tuple(r)[:4] for r in conversations.collect()])


def test_repair_of_given_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    got = {r[0]: tuple(r[1:]) for r in REGISTRY["op12_repair"](spark, SF_DIR).collect()}
    assert got == plain_repair([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


def test_repaired_rows_are_well_formed(conversations):
    repaired, _ = repair.repair(repair.damaged(conversations), 16)
    convs = {}
    for r in sorted(repaired.collect(), key=lambda r: r.seq):
        convs.setdefault(r.conv_id, []).extend(line[0] for line in r.lines)
    assert all(re.fullmatch("(s?(ua)+)?", "".join(c)) for c in convs.values())


def test_repair_of_nothing(spark, conversations):
    assert repair.repaired_conversations(conversations.limit(0)).count() == 0
    gone = spark.createDataFrame([(c, 0, "user", "x.", "", 0) for c in range(40)], CONVERSATIONS)
    rows = [tuple(r) for r in repair.repaired_conversations(gone).collect()]
    assert len(rows) == 40 and (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in [r[1:] for r in rows]


# ---- whitening -------------------------------------------------------------------------------------------------


def plain_whitening(vectors, most=8):
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    a = ((n * x - sums) / n).astype(float)
    values, w = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)[:most]
    return n, [int(sum(v * v for v in row)) for row in n * x - sums], a @ w[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def compared(found, rows):
    n, deviation, white, share = plain_whitening([v for _, v in rows])
    own = np.full(white.shape, np.nan)
    place = {vec: i for i, (vec, _) in enumerate(rows)}
    for r in found:
        i = place[r.vec_id]
        own[i, r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, deviation[i])
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
    sign = np.sign((own * white).sum(axis=0))
    assert np.abs(own * sign - white).max() < 1e-8


def good(v):
    return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)


def test_whitening_of_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    compared(REGISTRY["op13_whitening"](spark, SF_DIR).collect(), [r for r in rows if good(r[1])])


VECTORS = "vec_id long, embedding array<float>, label int, n long, vector string"


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 5)) * [3, 1, 0.2, 2, 0.01]
    rows = [(i, v) for i, v in enumerate(base.astype(np.float32).tolist())]
    odd = [(100, None), (101, []), (102, [1.0, None, 0, 0, 0]), (103, [float("nan")] * 5), (104, [float("inf"), 0.0, 0, 0, 0])]
    table = spark.createDataFrame([(i, None if v is None else [c if c is None else float(c) for c in v], 1, 2, "v") for i, v in rows + odd], VECTORS).repartition(4)
    compared(whitening.whiten(table).collect(), rows)
    assert whitening.whiten(table.limit(0)).count() == 0
    repeated = table.where("vec_id < 20").unionAll(table.where("vec_id < 20")).withColumn("vec_id", F.when(F.col("vec_id") > 2, F.col("vec_id")))
    assert whitening.whiten(repeated).count() == 40 * 5


def test_whitening_of_equal_rows_and_low_rank(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 1, 2, "v") for i in range(4)], VECTORS)
    assert whitening.whiten(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, -float(i)], 1, 2, "v") for i in range(9)], VECTORS)
    found = whitening.whiten(line).collect()
    assert {r.component for r in found} == {1} and all(r.explained == pytest.approx(1) and r.identity_error < 1e-9 for r in found)


def test_whitening_of_two_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3 + i % 2).astype(np.float32).tolist()) for i in range(40)]
    found = whitening.whiten(spark.createDataFrame([(*r, 1, 2, "v") for r in rows], VECTORS)).collect()
    for dims in (3, 4):
        own = [r for r in rows if len(r[1]) == dims]
        compared([r for r in found if r.vec_id % 2 == dims - 3], own)


def test_large_entries_stay_exact():
    sums = whitening.Sums(3, [3 * 10**18, 5])
    x = np.array([[10**12, 7], [-(10**12), 2]])
    assert [int(v) for v in sums.spread(x)[0]] == [3 * 10**12 - 3 * 10**18, 16]
    assert sums.deviation(x)[0] is None


def test_cholesky_shift_survives_indefinite_sums():
    r = whitening._cholesky(np.array([[1.0, 1.0], [1.0, 1.0 - 1e-15]]), 0.0)
    assert np.isfinite(r).all() and np.allclose(r.T @ r, 1, atol=1e-6)
