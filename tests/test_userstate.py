"""State per user and day against direct aggregation, and categoricals of any size."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from actionwise.operators import training, trees
from actionwise.operators.population import eligible_users
from actionwise.operators.scoring import model_scorer
from actionwise.plans import starschema, userstate
from actionwise.sources.tables import scan, stage
from actionwise.specs import ActionSpec, FeatureSpec, TrainSpec

BASE = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(BASE).exists(), reason="test tables not available")
PERIODS = [starschema.Period(), starschema.Period(date(1999, 3, 15), date(1999, 3, 16)), starschema.Period(date(1990, 1, 1), date(1990, 2, 1))]


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@needs_data
def test_state_gives_the_direct_profile(spark, tmp_path):
    customer, orders, items = (scan(spark, BASE, t) for t in ("customer", "orders", "lineitem"))
    path = str(tmp_path / "state")
    # the facts arrive in two parts, which share days
    for part in (F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 3 != 0):
        userstate.write_state(userstate.daily_state(orders.filter(part), items), path)
    state = userstate.read_state(spark, path)
    assert userstate.merged(state).count() < state.count()
    for period in PERIODS:
        direct = starschema.user_profile(customer, orders, items, period)
        assert same(userstate.profile_at(customer, state, period), direct)
        assert same(userstate.profile_at(customer, userstate.read_state(spark, path, period.as_of.isoformat()), period), direct)
        assert same(userstate.profile_at(customer, userstate.merged(state), period), direct)


@needs_data
def test_only_eligible_users_are_read_on(spark, tmp_path):
    customer, orders, items = (scan(spark, BASE, t) for t in ("customer", "orders", "lineitem"))
    path, period = str(tmp_path / "state"), PERIODS[0]
    userstate.write_state(userstate.daily_state(orders, items), path)
    users = stage(starschema.raw_users(customer, orders), "users")
    few = stage(eligible_users(users, period.as_of, 1500), "eligible")
    got = userstate.profile_at(customer, userstate.read_state(spark, path), period, few)
    assert 0 < got.count() < customer.count()
    assert same(got, starschema.user_profile(customer, orders, items, period, few))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        picked = few.filter(F.col("verified_at") >= F.lit(date(1999, 1, 1)))
        plan = userstate.activity_at(userstate.read_state(spark, path), period, picked)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "might_contain" in plan
    short = userstate.read_state(spark, path, "1999-03-16")
    assert "PartitionFilters: [isnotnull(month" in short._jdf.queryExecution().executedPlan().toString()
    assert short.count() < userstate.read_state(spark, path).count()


def test_categoricals_of_any_size_train(spark):
    rows = [(i, f"v{i % 10_000}", ["common", "other", None][i % 3], float(i % 7), int(i % 7 > 3)) for i in range(12_000)]
    df = spark.createDataFrame(rows, "id long, big string, small string, x double, target int")
    spec, settings = FeatureSpec(("big", "small"), ("x",)), TrainSpec(max_depth=(2,), max_iter=(2,), step_size=(0.1,), folds=2)
    found = training.staged_search(stage(df, "big"), spec, settings)
    assert found.model.transform(df).count() == 12_000
    big, small = (found.model.stages[k].labels for k in (0, 1))
    assert list(big) == sorted([f"v{k}" for k in range(2000)])[:63]  # those stand twice
    assert sorted(small) == ["common", "other"]
    table = trees.tree_table(found.model, spec)
    action = ActionSpec("recurring_action", features=spec)
    got, want = (f(df, action).select("id", action.probability).collect() for f in (trees.tree_scorer(table), model_scorer(found.model)))
    assert dict(map(tuple, got)) == pytest.approx(dict(map(tuple, want)))
    assert training.indexed(df.limit(0), spec, 3).count() == 0


def test_few_categories_are_indexed_as_before(spark):
    rows = [(i, ["b", "a", "c", "a", None][i % 5]) for i in range(50)]
    df, spec = spark.createDataFrame(rows, "id long, c string"), FeatureSpec(("c",), ())
    old = Pipeline(stages=[training.string_indexer(spec)]).fit(df).transform(df)
    new = training.indexed(df, spec, 10)
    assert old.exceptAll(new).count() == 0
    assert {r["c"]: r["c_index"] for r in training.indexed(df, spec, 1).collect()} == {"a": 0.0, "b": 1.0, "c": 1.0, None: 1.0}
