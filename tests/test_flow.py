"""Target generation, training, registry, scoring and ranking end to end on the smallest tables."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from actionwise.operators import scoring, training, trees
from actionwise.operators.deciles import score_deciles
from actionwise.operators.population import train_test_split, training_union
from actionwise.operators.ranking import rank_scored_users
from actionwise.operators.transformers import MetadataDropper
from actionwise.plans import deploy, starschema, targets, train
from actionwise.plans.catalog import QUICK
from actionwise.sources import registry, tables
from actionwise.specs import FeatureSpec, model_actions, scored_actions

BASE = "/root/testdata/sf0.001"
DB = "flow"
AS_OF = date(2001, 7, 1)
pytestmark = pytest.mark.skipif(not Path(BASE).exists(), reason="test tables not available")
RECURRING, AUTO = starschema.BY_NAME["recurring_action"], starschema.BY_NAME["auto_transport"]
TRAINED = [a for a in starschema.ACTIONS if a.name in ("recurring_action", "auto_transport") or a.kind != "model"]


@pytest.fixture(scope="module")
def users(spark):
    tables.create_schema(spark, DB)
    tables.create_schema(spark, DB)  # a second time does no harm
    return tables.stage(starschema.load_profile(spark, BASE), "profile")


@pytest.fixture(scope="module")
def trained(spark, users, tmp_path_factory):
    for action in (RECURRING, AUTO):
        targets.generate_targets(users, action, DB, starschema.VENDOR_CODES, AS_OF)
    return train.train_actions(
        spark, starschema.ACTIONS, DB, str(tmp_path_factory.mktemp("models")), f"{DB}.models",
        names=["recurring_action", "auto_transport"], spec=QUICK, codes=starschema.VENDOR_CODES,
    )


def test_class_tables(spark, users, trained):
    parts = {p: spark.table(targets.table_name(DB, RECURRING, p)) for p in targets.TABLES}
    n = {p: df.count() for p, df in parts.items()}
    assert n["positive_class"] + n["negative_class_all"] == n["full_population"]
    assert 0 < n["negative_class"] <= n["negative_class_all"]
    assert parts["negative_class"].select("id").exceptAll(parts["negative_class_all"].select("id")).count() == 0
    full = parts["full_population"]
    assert "vx0001" in full.columns and "acctbal" not in full.columns
    assert [r[0] for r in full.select("snapshot_date").distinct().collect()] == [AS_OF]
    expected = users.filter("segment != 'null' AND n_orders > 0").count()
    assert n["full_population"] == expected


def test_training_result(spark, trained):
    result = trained["recurring_action"]
    assert 0 <= result.auc.first()["auc"] <= 1
    p = result.performance.first()
    parts = [spark.table(targets.table_name(DB, RECURRING, part)) for part in ("positive_class", "negative_class")]
    held_out = train_test_split(training_union(*parts))[1].count()
    assert p["tp"] + p["fp"] + p["tn"] + p["fn"] == held_out
    assert result.grid.count() == 1
    importance = {r["feature"]: r["importance"] for r in result.importance.collect()}
    assert set(importance) == set(train.coded_features(RECURRING.features, starschema.VENDOR_CODES).columns)
    assert sum(importance.values()) == pytest.approx(1.0)
    assert result.roc.filter("threshold IS NULL").count() == 2


def test_registry(spark, trained):
    rows = {r["model_name"]: r for r in spark.table(f"{DB}.models").collect()}
    assert set(rows) == {"recurring_action", "auto_transport"}
    assert rows["recurring_action"]["s3_uri"] == trained["recurring_action"].uri
    assert "share_urgent" in rows["recurring_action"]["features"] and "id" not in rows["recurring_action"]["features"]
    assert rows["recurring_action"]["params"] == {"maxIter": "5", "maxDepth": "2", "stepSize": "0.1"}


def test_history_holds_the_quality_of_each_model(spark, trained):
    rows = {r["model_name"]: r for r in spark.table(f"{DB}.models_history").collect()}
    assert set(rows) == {"recurring_action", "auto_transport"}
    row, result = rows["recurring_action"], trained["recurring_action"]
    want = result.performance.first().asDict() | {"auc": result.auc.first()["auc"]}
    assert row["metrics"].asDict() == {c: want[c] for c in registry.METRICS}
    assert [tuple(g) for g in row["grid"]] == sorted(map(tuple, result.grid.collect()))
    assert row["importance"] == {r["feature"]: r["importance"] for r in result.importance.collect()}
    assert 0 < len(row["curve"]) <= train.CURVE_BINS + 1
    assert registry.champion_uris(spark.table(f"{DB}.models_history"), ["recurring_action"]) == {"recurring_action": result.uri}


def test_champion_and_challengers(spark):
    values = [(1, 0.7), (2, 0.6), (3, None), (4, 0.8), (5, 0.8), (6, 0.9)]
    history = spark.createDataFrame([("m", f"V{k}", f"u{k}", datetime(2024, 1, k), (v,)) for k, v in values], "model_name string, version string, s3_uri string, trained_at timestamp, metrics struct<auc:double>")
    got = {r["version"]: (r["took_over"], r["is_champion"]) for r in registry.model_history(history.filter("version <> 'V6'")).collect()}
    assert got == {"V1": (True, False), "V2": (False, False), "V3": (False, False), "V4": (True, True), "V5": (False, False)}
    assert registry.champion_uris(history, ["m", "other"]) == {"m": "u6"}


def test_pool_goes_on_after_a_failure_and_resumes(spark, users, trained, tmp_path):
    names = ["recurring_action", "auto_transport", "small_action"]
    targets.generate_targets(users, starschema.BY_NAME["small_action"], DB, starschema.VENDOR_CODES, AS_OF)
    ran, broken = [], {"auto_transport"}

    def one(spark_, action, *args, **more):
        ran.append((action.name, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        if action.name in broken:
            raise RuntimeError("no luck")
        return train.train_action(spark_, action, *args, **more)

    run = lambda: train.train_pool(
        spark, starschema.ACTIONS, DB, str(tmp_path), f"{DB}.pool", names, QUICK, starschema.VENDOR_CODES, workers=3, one=one
    )
    first = run()
    assert set(first.trained) == {"recurring_action", "small_action"} and not first.resumed
    assert {n: str(e) for n, e in first.failed.items()} == {"auto_transport": "no luck"}
    assert sorted(ran) == sorted((n, f"train-{n}") for n in names)
    ran.clear()
    broken.clear()
    second = run()
    assert [n for n, _ in ran] == ["auto_transport"] == list(second.trained) and not second.failed
    assert second.resumed == {n: r.uri for n, r in first.trained.items()}
    assert sorted(r["model_name"] for r in spark.table(f"{DB}.pool").collect()) == sorted(names)
    ran.clear()
    assert not run().trained and not ran


def test_dated_snapshots(spark, tmp_path):
    path, days = str(tmp_path / "dated"), [date(2024, 1, 1), date(2024, 1, 5), date(2024, 2, 1)]
    frame = lambda *rows: spark.createDataFrame(list(rows), "id long, c string")
    state = lambda day: sorted(tuple(r)[:2] for r in tables.read_as_of(spark, path, day).collect())
    tables.write_dated(frame((1, "a"), (2, "b")), path, days[0])
    tables.write_dated(frame((1, "x")), path, days[1])
    tables.write_dated(frame((1, "y"), (3, "z")), path, days[1])  # again: the day is replaced, the other stays
    assert state(days[0]) == [(1, "a"), (2, "b")] == state(date(2024, 1, 4)) and state(days[1]) == [(1, "y"), (3, "z")]
    assert state(date(2023, 12, 31)) == []
    broken = frame((7, "q")).withColumn("c", F.raise_error(F.lit("no luck")))
    with pytest.raises(Exception, match="no luck"):
        tables.write_dated(broken, path, days[1])
    assert state(days[1]) == [(1, "y"), (3, "z")]
    tables.write_dated(frame((9, "w")).withColumn("d", F.lit(2.0)), path, days[2])  # a column more
    assert {(r["id"], r["d"]) for r in tables.snapshot_history(spark, path).collect()} == {(1, None), (2, None), (3, None), (9, 2.0)}
    assert tables.snapshot_history(spark, path).count() == 5
    tables.write_dated(frame((1, "a")).limit(0), path, days[1])
    assert tables.snapshot_history(spark, path).filter(F.col("snapshot_date") == days[1]).count() == 0


def test_stored_model_predicts_the_same(spark, users, trained):
    coded = deploy.coded_actions([RECURRING], starschema.VENDOR_CODES)[0]
    people = deploy.vendor_rename(users, starschema.VENDOR_CODES)
    scorable = scoring.scorable_users(people, coded)
    fresh = scoring.inference_frame(trained["recurring_action"].model.transform(scorable), coded)
    stored = scoring.score_with_model(scorable, coded, trained["recurring_action"].uri)
    assert sorted(fresh.collect()) == sorted(stored.collect())
    # and so does the node table next to it, without the library
    table = trees.load_tree_table(spark, train.tree_path(trained["recurring_action"].uri))
    own = {r["id"]: (r[coded.probability], r[coded.prediction]) for r in trees.tree_scorer(table)(scorable, coded).collect()}
    assert all(abs(own[r["id"]][0] - r[coded.probability]) < 1e-12 and own[r["id"]][1] == r[coded.prediction] for r in fresh.collect())


def test_unknown_model_name(spark, tmp_path):
    with pytest.raises(ValueError, match="no trainable action"):
        train.train_actions(spark, starschema.ACTIONS, DB, str(tmp_path), f"{DB}.models", names=["transport_action"])


def test_deploy_with_trained_models(spark, users, trained):
    models = model_actions(TRAINED)
    scorers = deploy.newest_model_scorers(spark.table(f"{DB}.models"), models)
    scorers["transport_action"] = scoring.table_scorer(starschema.outside_table(users))
    tables.write_snapshot(tables.survivability_table(spark), f"{DB}.survivability", AS_OF)
    actions = [a for a in TRAINED if a.name != "next_positive"]
    scores, ranks = deploy.deploy(
        spark, users, actions, scorers, DB, starschema.VENDOR_CODES, spark.table(f"{DB}.survivability"), AS_OF
    )
    assert scores.count() == ranks.count() == users.count()
    profiles = {r["column"]: r for x in ("scores", "ranks") for r in spark.table(f"{DB}.user_level_{x}_profile").collect()}
    assert all(r["n"] == users.count() and r["min"] <= r["p25"] <= r["p50"] <= r["p75"] <= r["max"] for r in profiles.values())
    assert {"recurring_action", "recurring_action_probability", "recurring_action_score_decile"} <= set(profiles)
    assert scores.filter(" OR ".join(f"{c} IS NULL" for c in scores.columns)).count() == 0
    # the scores of the join-based operators agree with the row-wise ones
    coded = {a.name: a for a in deploy.coded_actions(actions, starschema.VENDOR_CODES)}
    people = deploy.vendor_rename(users, starschema.VENDOR_CODES)
    action = coded["recurring_action"]
    scorable = scoring.scorable_users(people, action)
    scored = tables.stage(scoring.score_with_model(scorable, action, trained["recurring_action"].uri), "scored")
    want = scoring.with_defaults(people, score_deciles(scored, action), action)
    got = scores.select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # and so do the ranks computed from the stored score table
    again = rank_scored_users(scores, users, actions)
    assert ranks.drop("snapshot_date").exceptAll(again).count() == 0


def test_repeated_user_key_is_an_error(spark, users):
    rules = [a for a in starschema.ACTIONS if a.is_rule]
    with pytest.raises(ValueError, match="not unique"):
        deploy.deploy(spark, users.unionByName(users.limit(1)), rules, {}, DB)


def test_missing_model_is_reported(spark, trained):
    with pytest.raises(ValueError, match="long_term"):
        deploy.newest_model_scorers(spark.table(f"{DB}.models"), starschema.ACTIONS)


def test_rerun_replaces_the_snapshot(spark):
    a = spark.createDataFrame([(1, "x")], "id long, c string")
    tables.write_snapshot(a, f"{DB}.snap", date(2024, 1, 1))
    tables.write_snapshot(a.withColumn("d", F.lit(2)).drop("c"), f"{DB}.snap", date(2024, 1, 2))
    assert [r.asDict() for r in spark.table(f"{DB}.snap").collect()] == [{"id": 1, "d": 2, "snapshot_date": date(2024, 1, 2)}]
    assert tables.with_snapshot(a).schema["snapshot_date"].dataType.simpleString() == "date"


def test_latest_models(spark):
    for version, uri, at in (
        ("V1", "m/1", datetime(2024, 1, 1)), ("V2", "m/2", datetime(2024, 3, 1)), ("V3", "m/3", datetime(2024, 3, 1)),
    ):
        registry.append_registry(registry.registry_row(spark, "a", version, uri), f"{DB}.latest", at)
    registry.append_registry(registry.registry_row(spark, "b", "V1", "n/1"), f"{DB}.latest")
    table = spark.table(f"{DB}.latest")
    assert registry.latest_uris(table, ["a", "b", "c"]) == {"a": "m/3", "b": "n/1"}
    assert {r["model_name"]: r["version"] for r in registry.latest_models(table).collect()} == {"a": "V3", "b": "V1"}


def test_unseen_and_missing_categories_do_not_fail(spark):
    spec = FeatureSpec(("c",), ("x",))
    rows = [(i, "ab"[i % 2], float(i % 2), i % 2) for i in range(40)]
    model = training.build_pipeline(spec, QUICK).fit(spark.createDataFrame(rows, "id long, c string, x double, target int"))
    new = spark.createDataFrame([(1, "zzz", 1.0, 1), (2, None, 0.0, 0), (3, "a", None, 0)], "id long, c string, x double, target int")
    assert model.transform(new).count() == 3
    assert {r["id"] for r in training.evaluation_frame(model, new).collect()} == {1, 2, 3}


def test_permutation_importance_finds_the_signal(spark):
    spec = FeatureSpec((), ("signal", "noise"))
    df = spark.range(1200).select(
        "id", (F.col("id") % 2).cast("double").alias("signal"), (F.hash("id") % 97).cast("double").alias("noise"),
        (F.col("id") % 2).cast("int").alias("target"),
    )
    model = training.build_pipeline(spec, QUICK).fit(df)
    got = {r["feature"]: r["auc_drop"] for r in training.permutation_importance(model, df, spec).collect()}
    assert got["signal"] > 0.3 and abs(got["noise"]) < 0.1


@pytest.mark.parametrize("rows", [1, 60])
def test_permutation_does_not_depend_on_the_session(spark, rows):
    spec = FeatureSpec((), ("a", "b"))
    df = spark.range(rows).select("id", (F.col("id") * 2).alias("a"), (F.col("id") % 7).alias("b"))
    before, results = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in (1, 4, 200, 2000):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(training.permuted_features(df.repartition(3), spec).select("id", "_next_a", "_next_b").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(r == results[0] for r in results) and sorted(r["_next_a"] for r in results[0]) == [2 * i for i in range(rows)]


def test_grid_has_all_points():
    from actionwise.specs import TrainSpec

    pipeline = training.build_pipeline(RECURRING.features, TrainSpec())
    gbt = pipeline.getStages()[-1]
    assert len(training.param_grid(gbt, TrainSpec())) == 18
    assert (gbt.getMaxBins(), gbt.getSeed()) == (64, 1234)


def test_metadata_dropper(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "c string, n short")
    indexed = StringIndexer(inputCol="c", outputCol="i").fit(df).transform(df)
    assert indexed.schema["i"].metadata
    dropper = MetadataDropper()
    plain = dropper.transform(indexed)
    assert not plain.schema["i"].metadata
    assert plain.dtypes == indexed.dtypes and plain.collect() == indexed.collect()
    assert MetadataDropper(columns=["n"]).transform(indexed).schema["i"].metadata
    dropper.save(str(tmp_path / "dropper"))
    assert not MetadataDropper.load(str(tmp_path / "dropper")).transform(indexed).schema["i"].metadata


def test_gathered_rows_equal_wide_scores(spark, users):
    wide = scoring.score_actions(users, starschema.ACTIONS, starschema.frozen_scorers())
    staged = tables.stage(wide, "wide")
    actions = scored_actions(starschema.ACTIONS)
    want = deploy.user_level_scores(staged, starschema.ACTIONS).drop("business_requirement_1_binary", "business_requirement_2_binary")
    long = None
    for a in actions:
        rows = score_deciles(staged.filter(a.scored).select("id", a.probability, a.prediction), a).toDF(
            "id", "probability", "prediction", "decile"
        )
        rows = rows.withColumn("action", F.lit(a.name))
        long = rows if long is None else long.unionByName(rows)
    got = scoring.gather_scores(users, long, actions).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
