"""Node tables against MLlib, prefixes against shorter fits, attributions against all subsets of features."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from actionwise.operators import training, trees
from actionwise.operators.metrics import auc_roc
from actionwise.operators.population import with_fold
from actionwise.operators.scoring import model_scorer
from actionwise.specs import ActionSpec, FeatureSpec, TrainSpec

SPEC = FeatureSpec(("c",), ("x", "y", "z"))
ACTION = ActionSpec("recurring_action", features=SPEC)
SCHEMA = "id long, c string, x double, y double, z double, target int"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    x, y, z = rng.integers(0, 30, 500).astype(float), rng.normal(size=500), rng.integers(0, 3, 500).astype(float)
    c = rng.choice(list("abcdef"), 500)
    hit = (x > 14) ^ np.isin(c, ["a", "e"]) | (y + z > 2.5)
    return [(i, str(c[i]), x[i].item(), y[i].item(), z[i].item(), int(hit[i] ^ (rng.random() < 0.1))) for i in range(500)]


@pytest.fixture(scope="module")
def train(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def users(spark, rows):
    """Unknown and missing categories, missing numbers, values on and beyond all thresholds."""
    odd = [(i, [c, None, "new"][i % 3], [x, None, math.inf, -math.inf][i % 4], y, [z, None][i % 2], t) for i, c, x, y, z, t in rows[:120]]
    return spark.createDataFrame(odd + [(r[0] + 1000, *r[1:]) for r in rows[:80]], SCHEMA)


@pytest.fixture(scope="module")
def model(train):
    pipeline = training.build_pipeline(SPEC, TrainSpec())
    gbt = pipeline.getStages()[-1]
    return pipeline.fit(train, {gbt.maxIter: 6, gbt.maxDepth: 3, gbt.stepSize: 0.1})


@pytest.fixture(scope="module")
def table(model):
    return trees.tree_table(model, SPEC)


def scores(df):
    return {r["id"]: (r[ACTION.probability], r[ACTION.prediction]) for r in df.collect()}


def test_table_scores_like_the_library(spark, model, table, users, tmp_path):
    want = scores(model_scorer(model)(users, ACTION))
    table.save(str(tmp_path / "m"))
    for own in (table, trees.load_tree_table(spark, str(tmp_path / "m"))):
        got = scores(trees.tree_scorer(own)(users, ACTION))
        assert set(got) == set(want)
        assert all(got[i][1] == want[i][1] and math.isclose(got[i][0], want[i][0], abs_tol=1e-12) for i in want)


def test_scoring_needs_no_python_worker(table, users):
    scored = trees.tree_scorer(table)(users, ACTION)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and "from_json" not in plan


def test_first_trees_are_the_shorter_fit(train, users):
    spec = TrainSpec(max_depth=(2,), max_iter=(7,), step_size=(0.3,))
    left, inner = training.fold_vectors(with_fold(train, 3, 1), SPEC, 0)
    gbt = training.classifier(spec)
    long = gbt.fit(left, {gbt.maxIter: 7, gbt.maxDepth: 2, gbt.stepSize: 0.3})
    for k in (1, 2, 4, 7):
        short = gbt.fit(left, {gbt.maxIter: k, gbt.maxDepth: 2, gbt.stepSize: 0.3})
        values = trees.leaves_reached(trees.ensemble_nodes(long), F.col("x"))["value"]
        got = inner.withColumn("v", values).select(trees.margin_of(F.col("v"), k).alias("m")).collect()
        assert short.treeWeights == long.treeWeights[:k]
        assert [t.toDebugString.split("\n", 1)[1] for t in short.trees] == [t.toDebugString.split("\n", 1)[1] for t in long.trees[:k]]
        vectors = training.fold_vectors(with_fold(train, 3, 1), SPEC, 0)[1]
        again = vectors.withColumn("v", trees.leaves_reached(trees.ensemble_nodes(short), F.col("x"))["value"]).select(trees.margin_of(F.col("v")).alias("m"))
        assert [r.m for r in got] == [r.m for r in again.collect()]


def test_search_equals_single_fits(spark, train):
    spec = TrainSpec(max_depth=(1, 2), max_iter=(2, 5), step_size=(0.1,), folds=2)
    found = training.staged_search(train, SPEC, spec)
    grid = {tuple(r)[:3]: r["auc"] for r in found.grid.collect()}
    assert set(grid) == {(i, d, 0.1) for i in (2, 5) for d in (1, 2)}
    folded = with_fold(train, 2, spec.seed)
    gbt = training.classifier(spec)
    for (trees_, depth, step), auc in grid.items():
        own = []
        for fold in (0, 1):
            left, inner = training.fold_vectors(folded, SPEC, fold)
            one = gbt.fit(left, {gbt.maxIter: trees_, gbt.maxDepth: depth, gbt.stepSize: step})
            outer = training.Pipeline(stages=[training.string_indexer(SPEC), training.assembler(SPEC)]).fit(folded.filter(F.col("fold") != fold))
            scored = one.transform(outer.transform(folded.filter(F.col("fold") == fold)))
            scored = scored.select("target", vector_to_array("rawPrediction")[1].alias("score"))
            own.append(auc_roc(scored).first()["auc"])
        assert auc == pytest.approx(sum(own) / 2, abs=1e-9)
    assert grid[found.best["max_iter"], found.best["max_depth"], found.best["step_size"]] == max(grid.values())
    assert training.best_params(found.model) == {"maxIter": str(found.best["max_iter"]), "maxDepth": str(found.best["max_depth"]), "stepSize": "0.1"}


def plain_shapley(nodes, x, features, goes_left):
    """From the definition: all subsets of features, by the value of each."""
    children = {c for n in nodes for c in (n["left"], n["right"])}

    def value(place, known):
        n = nodes[place]
        if n["left"] is None:
            return n["value"]
        if n["feature"] in known:
            return value(n["left"] if goes_left(n, x[n["feature"]]) else n["right"], known)
        return sum(nodes[n[s]]["cover"] * value(n[s], known) for s in ("left", "right")) / n["cover"]

    whole = {s: sum(value(p, s) for p in range(len(nodes)) if p not in children) for k in range(features + 1) for s in map(frozenset, itertools.combinations(range(features), k))}
    phi = []
    for i in range(features):
        total = 0.0
        for s, v in whole.items():
            if i not in s:
                weight = math.factorial(len(s)) * math.factorial(features - len(s) - 1) / math.factorial(features)
                total += weight * (whole[s | {i}] - v)
        phi.append(total)
    return whole[frozenset()], phi


def test_attributions_against_all_subsets(table, users):
    nodes = [r.asDict() for r in table.nodes.orderBy("place").collect()]

    def goes_left(node, value):
        return value in node["categories"] if node["categories"] is not None else value <= node["threshold"]

    inputs = {r["id"]: r["x"] for r in users.select("id", trees.feature_array(table).alias("x")).collect()}
    got = trees.attributions(users, table).collect()
    assert len(got) == users.count() and got[0].__fields__ == ["id", "base", "phi_c", "phi_x", "phi_y", "phi_z", "margin"]
    for r in got[::5]:
        base, phi = plain_shapley(nodes, inputs[r["id"]], 4, goes_left)
        assert r["base"] == pytest.approx(base, abs=1e-9)
        assert [r["phi_c"], r["phi_x"], r["phi_y"], r["phi_z"]] == pytest.approx(phi, abs=1e-9)
    for r in got:
        assert r["base"] + r["phi_c"] + r["phi_x"] + r["phi_y"] + r["phi_z"] == pytest.approx(r["margin"], abs=1e-9)


def test_blocks_change_nothing(table, users, monkeypatch):
    whole = trees.attributions(users, table).collect()
    rows, named = table.nodes.collect(), table.features.collect()
    leaves = trees.Leaves.of(rows, len(named), 7)
    x = np.stack([r["x"] for r in users.orderBy("id").select(trees.feature_array(table).alias("x")).collect()])
    monkeypatch.setattr(trees, "LEAVES_AT_ONCE", 3)
    want = {r["id"]: r["phi_x"] for r in whole}
    got = trees.shapley(leaves, x)[:, 1]
    assert got == pytest.approx([want[i] for i in sorted(want)], abs=1e-12)


def test_cover_can_be_counted_on_other_users(table, train, users):
    again = trees.with_cover(table, train)
    cover = lambda t: [r["cover"] for r in t.nodes.orderBy("place").collect()]
    assert cover(again) == cover(table)  # the training rows give the cover that fitting noted
    few = trees.with_cover(table, users.limit(1))
    assert set(cover(few)) == {0, 1}
    r = trees.attributions(users.limit(1), few).first()
    assert r["base"] == pytest.approx(r["margin"])  # one user is its own average


def test_single_leaf_and_no_users(spark, table, users):
    lone = spark.createDataFrame([(0, 0, -1, None, None, None, None, 0.25, 10)], trees.NODES)
    own = trees.TreeTable(lone, table.features)
    r = trees.attributions(users.limit(1), own).first()
    assert (r["base"], r["phi_x"], r["margin"]) == (0.25, 0.0, 0.25)
    assert trees.attributions(users.limit(0), table).collect() == []
    assert trees.attribution_summary(trees.attributions(users, table)).count() == 4
