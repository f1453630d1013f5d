"""Evaluation: the pinned example, MLlib as a second opinion, edge cases."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.mllib.evaluation import BinaryClassificationMetrics
from pyspark.sql import functions as F

from actionwise.functions.exprs import OCTAVES, STEPS, finite, score_bucket
from actionwise.operators import metrics
from actionwise.operators.cumulative import PARTS, running_totals

POINTS = [(0.9, 1), (0.8, 0), (0.7, 1), (0.2, 0), (0.7, 0)]


@pytest.fixture(scope="module")
def pinned(spark):
    return spark.createDataFrame(POINTS, "score double, target int").cache()


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(4000):
        target = int(rng.random() < 0.3)
        # two digits: MLlib thins out curves of more than 1000 points
        score = 0.4 if rng.random() < 1 / 3 else round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * target, 0.2))), 2)
        rows.append((score, target, float(score >= 0.5)))
    return spark.createDataFrame(rows, "score double, target int, prediction double").cache()


def by_threshold(df, column):
    return [(r["threshold"], r[column]) for r in df.orderBy(F.desc("threshold")).collect()]


def test_pinned_roc(pinned):
    got = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(pinned).collect())
    want = [(0, 0), (0, 0.5), (1 / 3, 0.5), (2 / 3, 1), (1, 1), (1, 1)]
    assert got == [pytest.approx(w) for w in want]


def test_pinned_threshold_curves(pinned):
    assert by_threshold(metrics.f1_by_threshold(pinned), "f1") == [
        (0.9, pytest.approx(2 / 3)), (0.8, 0.5), (0.7, pytest.approx(2 / 3)), (0.2, pytest.approx(4 / 7)),
    ]
    assert by_threshold(metrics.recall_by_threshold(pinned), "recall") == [(0.9, 0.5), (0.8, 0.5), (0.7, 1.0), (0.2, 1.0)]
    assert by_threshold(metrics.precision_by_threshold(pinned), "precision") == [(0.9, 1.0), (0.8, 0.5), (0.7, 0.5), (0.2, 0.4)]


def _mllib(df):
    return BinaryClassificationMetrics(df.select("score", F.col("target").cast("double")).rdd.map(tuple))


def _curve(model, name):
    return [(row._1(), row._2()) for row in getattr(model._java_model, name)().toJavaRDD().collect()]


def test_curves_equal_mllib(noisy):
    model = _mllib(noisy)
    for ours, column, theirs in (
        (metrics.f1_by_threshold, "f1", "fMeasureByThreshold"),
        (metrics.recall_by_threshold, "recall", "recallByThreshold"),
        (metrics.precision_by_threshold, "precision", "precisionByThreshold"),
    ):
        got, want = by_threshold(ours(noisy), column), _curve(model, theirs)
        assert len(got) == len(want)
        assert all(g == pytest.approx(w) for g, w in zip(got, want))
    got = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(noisy).collect())
    assert got == [pytest.approx(w) for w in sorted(_curve(model, "roc"))]


def test_auc_equals_mllib(noisy):
    want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target").evaluate(noisy)
    assert metrics.auc_roc(noisy).first()["auc"] == pytest.approx(want)


def test_auc_by_pairs(pinned):
    pos, neg = ([s for s, t in POINTS if t == k] for k in (1, 0))
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert metrics.auc_roc(pinned).first()["auc"] == pytest.approx(wins / (len(pos) * len(neg)))


def test_groups_are_evaluated_apart(noisy):
    both = noisy.withColumn("action", F.lit("a")).unionByName(noisy.withColumn("target", 1 - F.col("target")).withColumn("action", F.lit("b")))
    auc = {r["action"]: r["auc"] for r in metrics.auc_roc(both, by=["action"]).collect()}
    assert auc["a"] == pytest.approx(1 - auc["b"])
    assert metrics.roc_curve(both, by=["action"]).filter("threshold IS NULL").count() == 4


def test_null_group_is_kept(noisy):
    df = noisy.withColumn("action", F.lit(None).cast("string"))
    assert metrics.auc_roc(df, by=["action"]).first()["auc"] == pytest.approx(metrics.auc_roc(noisy).first()["auc"])


def test_bins_bound_the_curve(noisy):
    curve = metrics.threshold_curves(noisy, bins=20)
    assert curve.count() <= 21
    assert curve.orderBy("threshold").first()["recall"] == 1.0


@pytest.mark.parametrize("target", [0, 1])
def test_one_class_only(spark, target):
    df = spark.createDataFrame([(0.1, target, 0.0), (0.9, target, 1.0)], "score double, target int, prediction double")
    assert metrics.auc_roc(df).first()["auc"] is None
    roc = metrics.roc_curve(df).filter("threshold IS NOT NULL").collect()
    assert {r["fpr" if target else "tpr"] for r in roc} == {0.0}
    performance = metrics.model_performance(df).first()
    assert (performance["recall"] is None) == (target == 0)


def test_quadrants(noisy):
    m = metrics.confusion_matrix(noisy).first()
    assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == noisy.count()
    assert metrics.confusion_quadrant(noisy, 1, 0).first()["n"] == m["fn"]
    p = metrics.model_performance(noisy).first()
    assert p["recall"] == pytest.approx(m["tp"] / (m["tp"] + m["fn"]))
    assert p["f1"] == pytest.approx(2 * p["precision"] * p["recall"] / (p["precision"] + p["recall"]))


def test_empty_quadrants_are_zero(spark):
    df = spark.createDataFrame([(1, 1.0)], "target int, prediction double")
    assert metrics.confusion_matrix(df).first().asDict() == {"tp": 1, "fp": 0, "tn": 0, "fn": 0}


@pytest.mark.parametrize("steps", [1, 7, 4096])
def test_running_totals_do_not_depend_on_buckets(noisy, steps):
    points = metrics.score_points(noisy)
    got = {r["score"]: (r["pos_to"], r["neg_to"], r["pos_all"]) for r in running_totals(points, ["pos", "neg"], steps=steps).collect()}
    pos = neg = 0
    rows = sorted(points.collect(), key=lambda r: -r["score"])
    total = sum(r["pos"] for r in rows)
    for r in rows:
        pos, neg = pos + r["pos"], neg + r["neg"]
        assert got[r["score"]] == (pos, neg, total)


def test_buckets_are_monotone(spark):
    rng = random.Random(3)
    edges = [v for e in range(0, 60) for v in (2.0**-e, 2.0**-e * (1 - 1e-16), 2.0**-e * (1 + 3e-16))]
    values = sorted([0.0, -1.0, 2.0, 5e-324, *edges, *[rng.random() ** rng.choice([1, 5, 30]) for _ in range(3000)]])
    df = spark.createDataFrame([(v,) for v in values], "p double").select("p", score_bucket(F.col("p")).alias("b"))
    buckets = [r["b"] for r in sorted(df.collect(), key=lambda r: r["p"])]
    assert buckets == sorted(buckets) and min(buckets) == -(OCTAVES * STEPS + 1) and max(buckets) <= (2 * OCTAVES + 1) * STEPS


@pytest.mark.parametrize("shape", ["narrow", "margin", "negative"])
def test_no_hot_part(spark, shape):
    """Of 200,000 scores, no ordered window holds more than a small share, whatever their scale."""
    score = {"narrow": "0.5 + rand(1) * 1e-4", "margin": "1 + 5 * rand(1)", "negative": "-1000 * rand(1)"}[shape]
    points = metrics.score_points(spark.range(200_000).selectExpr(f"{score} AS score", "cast(id % 2 as int) AS target"))
    out = running_totals(points, ["pos", "neg"])
    assert out.agg(F.max("pos_to"), F.max("neg_to")).first() == (100_000, 100_000)
    value = finite(F.col("score"))
    cut = points.withColumns({"b": score_bucket(F.col("score")), "v": value})
    ends = cut.groupBy("b").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    part = F.floor(F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")) * PARTS)
    assert cut.join(ends, "b").groupBy("b", part).count().agg(F.max("count")).first()[0] < 10_000
