"""Populations, cleaning, sampling, distributions on small hand-made frames."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from actionwise.operators import cleaning, distributions, population
from actionwise.specs import FeatureSpec


def flagged(spark, positives, negatives):
    return spark.range(positives + negatives).withColumn("t", (F.col("id") < positives).cast("int"))


def test_eligible_users(spark):
    as_of = date(2024, 7, 1)
    rows = [
        (1, datetime(2024, 6, 1), None),                     # open
        (2, datetime(2024, 6, 1), datetime(2024, 6, 15)),    # closed before
        (3, datetime(2024, 6, 1), datetime(2024, 8, 1)),     # closes later
        (4, datetime(2020, 6, 1), None),                     # verified too early
        (5, None, None),                                     # never verified
        (6, datetime(2024, 6, 1), datetime(2024, 7, 1)),     # closed on the day
        (7, datetime(2024, 6, 1, 0, 0), None),
    ]
    users = spark.createDataFrame(rows, "id long, verified_at timestamp, closed_at timestamp")
    assert sorted(r["id"] for r in population.eligible_users(users, as_of, 30).collect()) == [1, 3, 7]


def test_window_targets_borders(spark):
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    facts = spark.createDataFrame(
        [
            (1, datetime(2001, 1, 1), "a"), (1, datetime(2001, 1, 2), "a"),
            (2, datetime(2000, 12, 31, 23, 59), "a"), (3, datetime(2001, 7, 1), "a"), (4, datetime(2001, 6, 30), "b"),
        ],
        "actor long, at timestamp, kind string",
    )
    actions = {"a_binary": F.col("kind") == "a", "b_binary": F.col("kind") == "b"}
    got = population.window_targets(users, facts, "actor", "at", actions, date(2001, 1, 1), date(2001, 7, 1))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 1)]


@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_sample_and_split_ignore_partitioning(spark, partitions):
    df = flagged(spark, 200, 1800)
    base = sorted(r["id"] for r in population.downsample_negative(df.coalesce(1), "t").collect())
    other = df.repartition(partitions)
    assert sorted(r["id"] for r in population.downsample_negative(other, "t").collect()) == base
    train, test = population.train_test_split(df.coalesce(1))
    train2, test2 = population.train_test_split(other)
    assert sorted(train.collect()) == sorted(train2.collect()) and sorted(test.collect()) == sorted(test2.collect())


def test_downsample_balances(spark):
    n = population.downsample_negative(flagged(spark, 1000, 9000), "t").count()
    assert 900 < n < 1100


def test_downsample_keeps_everything_when_positives_dominate(spark):
    assert population.downsample_negative(flagged(spark, 500, 20), "t").count() == 20


def test_downsample_of_tiny_ratio_is_not_rounded_up(spark):
    assert population.downsample_negative(flagged(spark, 1, 100_000), "t").count() < 10


def test_no_negatives_and_no_positives(spark):
    assert population.downsample_negative(flagged(spark, 5, 0), "t").count() == 0
    assert population.downsample_negative(flagged(spark, 0, 5), "t").count() == 0
    assert population.class_ratio(flagged(spark, 5, 0), "t").first()["ratio"] is None


def test_split_shares_and_folds(spark):
    df = spark.range(20_000)
    split = {r["split"]: r["count"] for r in population.with_split(df).groupBy("split").count().collect()}
    assert 0.78 < split["train"] / 20_000 < 0.82
    folds = {r["fold"]: r["count"] for r in population.with_fold(df, 3, 1234).groupBy("fold").count().collect()}
    assert set(folds) == {0, 1, 2} and min(folds.values()) > 6300


def test_folds_are_independent_of_the_split(spark):
    df = population.with_fold(population.with_split(spark.range(20_000)), 2, 1234)
    share = df.filter("split = 'test'").agg(F.avg("fold")).first()[0]
    assert 0.45 < share < 0.55


def test_union_matches_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(4, 3)], "y int, x int")
    assert sorted(tuple(r) for r in population.training_union(a, b).collect()) == [(1, 2), (3, 4)]


def test_sentinel_only_in_text(spark):
    df = spark.createDataFrame([("null", 1.0, "x"), ("a", None, "null")], "s string, d double, u string")
    got = [tuple(r) for r in cleaning.null_sentinel(df).collect()]
    assert got == [(None, 1.0, "x"), ("a", None, None)]
    assert cleaning.complete_cases(cleaning.null_sentinel(df)).count() == 0
    assert cleaning.null_audit(cleaning.null_sentinel(df)).first().asDict() == {"s": 1, "d": 1, "u": 1}


def test_cast_of_junk_is_null(spark):
    df = spark.createDataFrame([("1.5",), ("junk",), (None,)], "vx0001 string")
    assert [r[0] for r in cleaning.cast_numeric(df, ["vx0001"]).collect()] == [1.5, None, None]


def test_infer_roles(spark):
    df = spark.createDataFrame([], "id long, segment string, vx0001 string, age int, target int, x_binary int, snapshot_date date")
    assert cleaning.infer_roles(df) == FeatureSpec(("segment",), ("vx0001", "age"))


def test_vendor_rename_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "id int, a int")
    assert cleaning.vendor_rename(df, {"a": "vx0001", "b": "vx0002"}).columns == ["id", "vx0001"]


def test_distribution_counts_null_as_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    got = {r["value"]: (r["n"], r["share"]) for r in distributions.value_distribution(df, ["c"]).collect()}
    assert got == {"a": (2, 0.5), None: (1, 0.25), "b": (1, 0.25)}


def test_drift(spark):
    a = spark.createDataFrame([("x", "u"), ("x", "v"), (None, "u"), ("y", "v")], "c string, d string")
    b = spark.createDataFrame([("z", "u"), ("z", "v")], "c string, d string")
    got = {r["column"]: r["distance"] for r in distributions.distribution_drift(a, b, ["c", "d"]).collect()}
    assert got == {"c": 1.0, "d": 0.0}
    same = distributions.distribution_drift(a, a, ["c", "d"]).collect()
    assert {r["distance"] for r in same} == {0.0}


def test_profile_and_summary_agree(spark):
    df = spark.range(101).select((F.col("id") / 100).alias("p"), F.col("id").alias("q"))
    rows = {r["column"]: r for r in distributions.profile(df, ["p", "q"], quantiles=[0.25, 0.5, 0.75]).collect()}
    text = {r["summary"]: r for r in df.summary().collect()}
    for c in ("p", "q"):
        assert rows[c]["n"] == 101
        for ours, theirs in (("mean", "mean"), ("stddev", "stddev"), ("min", "min"), ("max", "max")):
            assert rows[c][ours] == pytest.approx(float(text[theirs][c]))
        assert rows[c]["quantiles"] == pytest.approx([float(text[q][c]) for q in ("25%", "50%", "75%")])
