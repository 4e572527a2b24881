"""The lap-time model on laps whose times follow a known rule."""

import math

import numpy as np
import pytest
from conftest import by
from pyspark.sql import functions as F
from stintwise.operators import boosting
from stintwise.plans import model, views

KEYS = ["key_season", "key_race_name", "key_driver", "key_lap_number"]


@pytest.fixture(scope="module")
def rows(spark, laps):
    noise = F.pmod(F.xxhash64("event_id"), F.lit(1000)) / 1000 - 0.5
    offset = F.when(F.col("driver_number").cast("int") % 2 == 0, 3.0).otherwise(0.0)
    ruled = views.heuristic_lap_time(F.col("tyre_life"), F.col("compound"), F.col("lap_number"), F.col("track_temp"), F.col("rainfall"))
    keyed = laps.withColumns({k: F.col(k[4:]) for k in KEYS}).withColumn("lap_time_seconds", ruled + offset + noise * 0.2)
    return model.features(keyed, KEYS)


@pytest.fixture(scope="module")
def parts(rows):
    return model.split(rows, KEYS)


@pytest.fixture(scope="module")
def fitted(parts):
    return model.fit(parts[0], trees=25, rate=0.2)


def test_split_is_stable_and_about_a_fifth(rows, parts):
    train, holdout = (p.count() for p in parts)
    assert train + holdout == rows.count() and 0.15 < holdout / (train + holdout) < 0.25
    again = model.split(rows.repartition(7), KEYS)[1]
    assert again.exceptAll(parts[1]).count() == 0


def test_model_learns_the_rule(fitted, parts):
    metrics = model.evaluate(fitted, parts[1]).first()
    assert metrics.r2 > 0.9 and metrics.mae < 1.0 and metrics.rmse >= metrics.mae


def test_importance_is_the_mean_gain_of_an_inputs_cuts(spark, fitted):
    shares = by(model.importance(fitted, spark), "feature")
    assert set(shares) == {*model.LABELS, *model.NUMBERS}
    assert sum(r.importance for r in shares.values()) == pytest.approx(1.0)
    assert model.importance(fitted, spark).first().feature == "Rainfall"
    gains = {c: [n[5] for n in fitted.forest.nodes if n[2] == c] for c in shares}
    means = {c: sum(g) / len(g) if g else 0.0 for c, g in gains.items()}
    for c, r in shares.items():
        assert (r.cuts, r.total_gain) == (len(gains[c]), pytest.approx(sum(gains[c])))
        assert r.importance == pytest.approx(means[c] / sum(means.values()))


def test_unseen_labels_are_coded_minus_one_and_missing_ones_missing(spark, fitted, parts):
    strange = parts[1].limit(4).withColumn("Driver", F.when(F.col("LapNumber") > 0, "Nobody")).withColumn("Circuit", F.lit(None).cast("string"))
    coded = model.coded(strange, fitted.labels).collect()
    assert {(r.Driver, r.Circuit) for r in coded} == {(-1.0, None)}
    scored = model.predict(fitted, strange).collect()
    assert {r.Driver for r in scored} == {"Nobody"} and all(r.prediction is not None for r in scored)


def test_saved_model_predicts_the_same(spark, fitted, parts, tmp_path):
    path = str(tmp_path / "model")
    fitted.save(spark, path)
    a, b = (model.predict(m, parts[1]).select(*KEYS, "prediction") for m in (fitted, model.LapModel.load(spark, path)))
    assert a.exceptAll(b).count() == 0


def test_rows_with_missing_numbers_are_scored(fitted, parts):
    holdout = parts[1].withColumn("AirTemp", F.when(F.col("LapNumber") % 2 == 0, F.col("AirTemp"))).withColumn("Rainfall", F.lit(None).cast("double"))
    scored = model.predict(fitted, holdout)
    assert scored.count() == holdout.count() and scored.where("prediction is null").count() == 0
    assert model.evaluate(fitted, holdout).first().rows == holdout.where(F.col(model.TARGET).isNotNull()).count()


def plain_score(forest, row):
    """One row through the node table, node by node."""
    total = forest.base
    nodes = {(n[0], n[1]): n for n in forest.nodes}
    for tree in sorted({n[0] for n in forest.nodes}):
        at = 0
        while nodes[tree, at][2] is not None:
            _, _, name, threshold, missing_left, *_ = nodes[tree, at]
            x = row[name]
            left = missing_left if x is None or math.isnan(x) else x <= threshold
            at = 2 * at + (1 if left else 2)
        total += nodes[tree, at][7]
    return total


def best_by_trying(rows, g, features):
    """(input, threshold, missing left, gain) by a loop over every value of every input, missing rows on either side."""
    best = (1e-6, None)
    for f, name in enumerate(features):
        for threshold in sorted({r[name] for r in rows if r[name] is not None}):
            for missing_left in (True, False):
                left = np.array([missing_left if r[name] is None else r[name] <= threshold for r in rows])
                if left.all() or not left.any():
                    continue
                gain = sum(x.sum() ** 2 / (len(x) + 1) for x in (g[left], g[~left])) - g.sum() ** 2 / (len(g) + 1)
                if gain > best[0] + 1e-9:
                    best = gain, (name, threshold, missing_left, left)
    return best


@pytest.fixture(scope="module")
def gapped(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        a, b, c = float(rng.integers(0, 12)), float(rng.normal()), float(rng.integers(0, 3))
        y = (5.0 if a > 7 else 0.0) + 2.0 * b + float(rng.normal())
        rows.append((None if a > 9 and i % 2 else a, None if i % 7 == 0 else b, float("nan") if i % 11 == 0 else c, y if i % 13 else None))
    return spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(5)


def test_trees_are_those_of_an_exhaustive_search(gapped):
    """Two trees of depth two: every node has the cut, side, gain and value that trying all of them gives."""
    features = ["a", "b", "c"]
    forest = boosting.fit_forest(gapped, features, "y", trees=2, rate=0.5, depth=2, bins=1000)
    rows = [{c: None if r[c] is None or math.isnan(r[c]) else r[c] for c in features} | {"y": r.y} for r in gapped.collect() if r.y is not None]
    y = np.array([r["y"] for r in rows])
    assert forest.base == pytest.approx(y.mean())
    margin = np.full(len(y), y.mean())
    nodes = {(n[0], n[1]): n for n in forest.nodes}
    for tree in range(2):
        todo = [(0, np.arange(len(rows)))]
        while todo:
            at, own = todo.pop()
            _, _, name, threshold, missing_left, gain, n, value = nodes[tree, at]
            assert n == len(own)
            g = (margin - y)[own]
            best, cut = best_by_trying([rows[i] for i in own], g, features)
            if at < 3:
                assert gain == pytest.approx(best) and (name, threshold) == cut[:2]
                left = np.array([missing_left if rows[i][name] is None else rows[i][name] <= threshold for i in own])
                assert (left == cut[3]).all()
                todo += [(2 * at + 1, own[left]), (2 * at + 2, own[~left])]
            else:
                assert name is None and value == pytest.approx(-0.5 * g.sum() / (len(g) + 1))
        margin = np.array([plain_score(boosting.Forest(features, forest.base, [n for n in forest.nodes if n[0] <= tree]), r) for r in rows])


def test_scores_are_those_of_a_walk_through_the_nodes(gapped):
    forest = boosting.fit_forest(gapped, ["a", "b", "c"], "y", trees=15, rate=0.3, depth=4, bins=32)
    for r in gapped.withColumn("p", forest.prediction()).collect():
        assert r.p == pytest.approx(plain_score(forest, r.asDict()))


def test_missing_rows_go_where_they_belong(spark):
    """Rows without a number behave like large ones here, so their side is right; with the signs turned round, left."""
    for sign, expected in ((1.0, False), (-1.0, True)):
        rows = [(float(i), 10.0 if i * sign > 20 * sign else 0.0) for i in range(40)] + [(None, 10.0)] * 10
        df = spark.createDataFrame(rows, "x double, y double")
        node = boosting.fit_forest(df, ["x"], "y", trees=1, rate=1.0, depth=1).nodes[0]
        assert (node[2], node[4]) == ("x", expected)


def test_forests_of_nothing_and_of_constants(spark, gapped):
    empty = boosting.fit_forest(gapped.limit(0), ["a"], "y", trees=3, rate=0.1, depth=2)
    assert (empty.base, empty.nodes) == (0.0, []) and gapped.select(empty.prediction().alias("p")).distinct().collect()[0].p == 0.0
    flat = boosting.fit_forest(gapped.withColumn("y", F.lit(4.0)), ["a"], "y", trees=3, rate=0.1, depth=2)
    assert flat.base == 4.0 and all(n[2] is None for n in flat.nodes)
    assert [r.importance for r in boosting.importances(flat.table(spark), ["a"]).collect()] == [0.0]
    nulls = boosting.fit_forest(gapped.withColumn("a", F.lit(None).cast("double")), ["a", "b"], "y", trees=2, rate=0.1, depth=2)
    assert {n[2] for n in nulls.nodes} <= {"b", None}


def test_a_level_is_spread_over_tasks(spark):
    """A quarter of a million rows are too many for one task at each of hundreds of levels."""
    df = spark.range(0, 250_000, 1, 8).selectExpr("double(id % 1000) AS x", "double(id % 7) AS z", "double(id % 1000 > 500) + id % 7 AS y")
    sc = spark.sparkContext
    sc.setJobGroup("levels", "levels")
    forest = boosting.fit_forest(df, ["x", "z"], "y", trees=2, rate=0.5, depth=2)
    last = sc.statusTracker().getJobInfo(max(sc.statusTracker().getJobIdsForGroup("levels")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert max(sc.statusTracker().getStageInfo(i).numTasks for i in last.stageIds) > 1
    assert [n[6] for n in forest.nodes if n[1] == 0] == [250_000, 250_000]


def test_blocks_and_stretches_do_not_show(spark, gapped, monkeypatch):
    """Many small blocks, gradients written anew after every second tree: the same trees as with one block and none."""
    plain = boosting.fit_forest(gapped, ["a", "b", "c"], "y", trees=5, rate=0.3, depth=3).nodes
    monkeypatch.setattr(boosting, "STRETCH", 2)
    monkeypatch.setattr(boosting, "ROWS_A_BLOCK", 16)
    again = boosting.fit_forest(gapped.repartition(3), ["a", "b", "c"], "y", trees=5, rate=0.3, depth=3).nodes
    assert [(*n[:5], n[6]) for n in plain] == [(*n[:5], n[6]) for n in again]
    assert [n[7] or 0.0 for n in plain] == pytest.approx([n[7] or 0.0 for n in again])


def test_a_row_reads_its_inputs_once_for_all_trees(gapped):
    forest = boosting.fit_forest(gapped, ["a", "b"], "y", trees=3, rate=0.3, depth=2)
    text = gapped.select(forest.prediction())._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("= NaN") == 2 and text.rindex("= NaN") < text.index("lambdafunction")


def test_a_tree_goes_on_from_the_held_blocks_of_the_one_before(gapped, monkeypatch):
    """Five trees read the packed table once, and a tree moves the rows by one tree only."""
    read, stepped, blocks, after = [], [], boosting._blocks, boosting._stepped
    monkeypatch.setattr(boosting, "_blocks", lambda *a: read.append(1) or blocks(*a))
    monkeypatch.setattr(boosting, "_stepped", lambda state, tree: stepped.append(isinstance(tree, tuple)) or after(state, tree))
    forest = boosting.fit_forest(gapped, ["a", "b", "c"], "y", trees=5, rate=0.3, depth=3)
    assert (len(read), stepped) == (1, [True] * 4) and max(n[0] for n in forest.nodes) == 4
    assert boosting._sums(blocks_of(gapped.sparkSession), ([-1], [0], [0], [0.0]), 0, [1, 9]).shape == (2, 2, 1, 11)


def blocks_of(spark):
    return spark.sparkContext.parallelize([(np.array([[0, 1, 2], [10, 0, 3]], np.uint8), np.ones(3))], 1)
