"""Distributed deciles against a plain global ntile."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from actionwise.functions.hashing import hash32
from actionwise.operators import deciles
from actionwise.specs import ACTIONS, ActionSpec, scored_actions

ACTION = ACTIONS[2]
P, D = ACTION.probability, ACTION.decile


def frame(spark, scores):
    return spark.createDataFrame(list(enumerate(scores)), f"id long, {P} double")


def mismatches(df, tiles=10):
    got = deciles.score_deciles(df, ACTION, tiles)
    want = df.withColumn("want", F.ntile(tiles).over(Window.orderBy(F.col(P).asc_nulls_first(), hash32("id"), "id")))
    return got.join(want.select("id", "want"), "id").filter(F.col("want") != F.col(D)).count()


def third_is_hot(rng, n):
    return [0.5 if rng.random() < 1 / 3 else rng.random() for _ in range(n)]


SHAPES = {
    "uniform": lambda rng: [rng.random() for _ in range(5000)],
    "one value": lambda rng: [0.25] * 3000,
    "few values": lambda rng: [rng.choice([0.1, 0.2, 0.2, 0.9]) for _ in range(3000)],
    "hot value": lambda rng: third_is_hot(rng, 5000),
    "narrow range": lambda rng: [0.01 + rng.random() * 1e-9 for _ in range(3000)],
    "hot value in a narrow range": lambda rng: [0.01 + x * 1e-10 for x in third_is_hot(rng, 3000)],
    "rare action": lambda rng: [rng.random() ** 12 * 1e-3 for _ in range(3000)],
    "crowded beside an outlier": lambda rng: [0.5 + rng.random() * 1e-12 for _ in range(2000)] + [0.50009],
    "nulls": lambda rng: [None if rng.random() < 0.4 else rng.random() for _ in range(2000)],
    "ends": lambda rng: [rng.choice([0.0, 1.0, 0.0, -0.5, 1.5]) for _ in range(500)],
    "nan": lambda rng: [rng.choice([0.3, float("nan"), 0.9]) for _ in range(200)],
    "margins": lambda rng: [rng.uniform(1, 6) for _ in range(3000)],
    "negative": lambda rng: [-(rng.random() ** 6) * 1e5 for _ in range(3000)],
    "both signs": lambda rng: [rng.gauss(0, 3) for _ in range(3000)],
    "infinite": lambda rng: [rng.choice([float("inf"), float("-inf"), 2.5, -1e300]) for _ in range(300)],
    "seven users": lambda rng: [rng.random() for _ in range(7)],
    "one user": lambda rng: [0.4],
    "23 users": lambda rng: [rng.choice([0.1, 0.2, 0.3, 0.4, 0.5]) for _ in range(23)],
}


def test_every_shape_equals_ntile(spark):
    """All shapes side by side, each as an action of its own on as many users as it has scores."""
    columns = {ActionSpec(name.replace(" ", "_")): make(random.Random(5)) for name, make in SHAPES.items()}
    actions = list(columns)
    size = max(map(len, columns.values()))
    rows = [
        (i, *[v for scores in columns.values() for v in ((scores[i], True) if i < len(scores) else (None, False))])
        for i in range(size)
    ]
    schema = ", ".join(["id long", *[f"{a.probability} double, {a.scored} boolean" for a in actions]])
    got = deciles.cut_deciles(spark.createDataFrame(rows, schema), actions)
    for a in actions:  # unscored users sort apart, so they do not touch the tiles of the scored ones
        order = Window.partitionBy(a.scored).orderBy(F.col(a.probability).asc_nulls_first(), hash32("id"), "id")
        want = F.when(F.col(a.scored), F.ntile(10).over(order)).otherwise(0)
        got = got.withColumn(f"bad_{a.name}", (want != F.col(a.decile)).cast("int"))
    bad = got.agg(*[F.sum(f"bad_{a.name}").alias(a.name) for a in actions]).first().asDict()
    assert {k: v for k, v in bad.items() if v} == {}


@pytest.mark.parametrize("tiles", [4, 100])
def test_other_tile_counts(spark, tiles):
    assert mismatches(frame(spark, third_is_hot(random.Random(1), 1000)), tiles) == 0


def test_tile_sizes_of_23(spark):
    df = deciles.score_deciles(frame(spark, [i / 23 for i in range(23)]), ACTION)
    sizes = [r["count"] for r in df.groupBy(D).count().orderBy(D).collect()]
    assert sizes == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(0, 1), st.sampled_from([0.0, 0.5, 1.0])), min_size=1, max_size=60))
def test_any_scores(spark, scores):
    assert mismatches(frame(spark, scores)) == 0


def test_empty_input(spark):
    assert deciles.score_deciles(frame(spark, [0.1]).filter("id < 0"), ACTION).count() == 0


def test_no_window_over_users(spark):
    plan = deciles.score_deciles(frame(spark, third_is_hot(random.Random(8), 400)), ACTION)._jdf.queryExecution().optimizedPlan().toString()
    assert "ntile" not in plan


def test_same_for_any_partitioning(spark):
    df = frame(spark, third_is_hot(random.Random(2), 2000))
    results = [sorted(deciles.score_deciles(df.repartition(n), ACTION).select("id", D).collect()) for n in (1, 8)]
    assert results[0] == results[1]


def test_text_keys(spark):
    df = frame(spark, third_is_hot(random.Random(3), 500)).withColumn("id", F.concat(F.lit("u"), F.col("id")))
    assert mismatches(df) == 0


def test_action_without_scored_users(spark):
    a, b = scored_actions(ACTIONS)[:2]
    df = spark.range(20).select(
        "id", (F.col("id") / 20).alias(a.probability), F.lit(True).alias(a.scored),
        F.lit(0.0).alias(b.probability), F.lit(False).alias(b.scored),
    )
    got = deciles.cut_deciles(df, [a, b])
    assert got.filter(F.col(b.decile) != 0).count() == 0
    assert got.groupBy(a.decile).count().filter("count = 2").count() == 10


def test_approximate_deciles_are_close(spark):
    df = frame(spark, SHAPES["uniform"](random.Random(6)))
    both = deciles.approx_deciles(df, ACTION).join(
        deciles.score_deciles(df, ACTION).select("id", F.col(D).alias("exact")), "id"
    )
    assert both.filter(F.abs(F.col(D) - F.col("exact")) > 1).count() == 0
    assert both.filter(F.col(D) != F.col("exact")).count() < 250
