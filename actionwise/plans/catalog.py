"""Every operator as a query over the parquet tables: name -> callable (spark, directory) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import cleaning, deciles, distributions, metrics, population, quantiles, ranking, scoring, training, trees
from ..sources.registry import latest_models, latest_uris, load_model, registry_row, save_model
from ..sources.registry import model_history as registry_history
from ..sources.tables import read_as_of, scan, stage, staging_dir, write_dated
from ..sources.tables import snapshot_history as history_of
from ..sources.tables import survivability_table as modifier_table
from ..specs import KEY, FeatureSpec, TrainSpec, model_actions, scored_actions
from . import starschema as star
from . import userstate
from .deploy import user_level_scores as score_table
from .targets import class_tables, training_population
from .train import training_data, tree_path

Query = Callable[[SparkSession, str], DataFrame]

RECURRING = star.BY_NAME["recurring_action"]
TRANSPORT = star.BY_NAME["transport_action"]
RULES = [a for a in star.ACTIONS if a.is_rule]
PERIOD = star.Period()
ELIGIBLE_DAYS = 2000
QUICK = TrainSpec(max_depth=(2,), max_iter=(5,), step_size=(0.1,), folds=2)
GRID = TrainSpec(max_depth=(2, 5), max_iter=(5, 10), step_size=(0.01, 0.1), folds=3)
NUMERIC = RECURRING.features.numeric

# Two fixed trees, whose cover is counted on the users at hand.
FROZEN_FEATURES = [(0, "segment", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]), (1, "share_urgent", None), (2, "n_orders", None)]
FROZEN_NODES = [
    (0, 0, 1, 0.2, None, 1, 2, 0.0, 0), (1, 0, -1, None, None, None, None, -0.5, 0), (2, 0, 2, 8.0, None, 3, 4, 0.0, 0),
    (3, 0, -1, None, None, None, None, 0.25, 0), (4, 0, -1, None, None, None, None, 0.75, 0),
    (5, 1, 0, None, [0.0, 2.0], 6, 7, 0.0, 0), (6, 1, -1, None, None, None, None, 0.125, 0), (7, 1, 1, 0.4, None, 8, 9, 0.0, 0),
    (8, 1, -1, None, None, None, None, -0.25, 0), (9, 1, -1, None, None, None, None, 0.375, 0),
]

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return star.raw_users(scan(spark, sf, "customer"), scan(spark, sf, "orders"))


def _dates(df: DataFrame) -> DataFrame:
    return df.select(KEY, F.to_date("verified_at").alias("verified_at"), F.to_date("closed_at").alias("closed_at"))


def _population(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned training population of one action."""
    return training_population(star.load_profile(spark, sf), RECURRING)


def _scored_wide(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_actions(star.load_profile(spark, sf), star.ACTIONS, star.frozen_scorers())


def _evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """(id, action, target, score, prediction) of the frozen scorers for all users with history."""
    users = star.load_profile(spark, sf).filter("n_orders > 0")
    rows = []
    for a in model_actions(star.ACTIONS):
        score = F.col(f"share_{star.PRIORITIES[a.name][1]}")
        rows.append(
            F.struct(
                F.lit(a.name).alias("action"),
                F.col(a.flag).alias("target"),
                score.alias("score"),
                F.when(score >= star.SHARE_THRESHOLD, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
            )
        )
    return users.select(KEY, F.inline(F.array(*rows)))


def _recurring_scored(users: DataFrame) -> DataFrame:
    """Scored users of one action; stored, since deciles read their input several times."""
    scored = star.frozen_scorers()[RECURRING.name](scoring.scorable_users(users, RECURRING), RECURRING)
    return stage(scored.select(KEY, RECURRING.probability, RECURRING.prediction), "scored")


# --- sources ---------------------------------------------------------------------------------------------------------


@query
def scan_users(spark, sf):
    return _dates(_users(spark, sf))


@query
def eligible_users(spark, sf):
    return _dates(population.eligible_users(_users(spark, sf), PERIOD.as_of, ELIGIBLE_DAYS))


@query
def survivability_table(spark, sf):
    """The modifier table next to the number of users who took each action."""
    flags = star.load_profile(spark, sf).select(*[F.sum(a.flag).alias(a.name) for a in star.ACTIONS])
    taken = ranking.unpivot_scores(flags, by=()).select(F.col("key").alias("action"), F.col("score").alias("n_taken"))
    return modifier_table(spark).join(taken, "action", "left")


@query
def latest_model(spark, sf):
    """Newest entry per name of a registry derived from the orders: one version per order, many of the same date."""
    registry = scan(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model_name"),
        F.col("o_orderstatus").alias("version"),
        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("s3_uri"),
        F.to_date("o_orderdate").alias("snapshot_date"),
    )
    return latest_models(registry)


@query
def model_history(spark, sf):
    """Champions of a history derived from the orders: one version per order, its total price standing for its quality."""
    history = scan(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model_name"),
        F.col("o_orderstatus").alias("version"),
        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("s3_uri"),
        F.to_date("o_orderdate").alias("trained_at"),
        F.struct((F.col("o_totalprice") / 1e6).alias("auc")).alias("metrics"),
    )
    return registry_history(history).select("model_name", "s3_uri", "trained_at", "value", "best_before", "gain", "took_over", "is_champion")


SNAPSHOT_DAYS = (date(2001, 1, 1), date(2001, 4, 1), date(2001, 7, 1))


def _snapshots(spark: SparkSession, sf: str) -> str:
    """A folder of dated snapshots of the orders per customer so far; the middle day is written twice, the second time right."""
    path = f"{staging_dir(spark)}/orders-{uuid.uuid4().hex}"
    orders = scan(spark, sf, "orders")

    def so_far(day: date) -> DataFrame:
        past = orders.filter(F.col("o_orderdate") < F.lit(day))
        return past.groupBy(F.col("o_custkey").alias(KEY)).agg(F.count(F.lit(1)).alias("n_orders"))

    write_dated(so_far(SNAPSHOT_DAYS[0]), path, SNAPSHOT_DAYS[1])
    for day in SNAPSHOT_DAYS:
        write_dated(so_far(day), path, day)
    return path


@query
def snapshot_history(spark, sf):
    return history_of(spark, _snapshots(spark, sf))


@query
def snapshot_as_of(spark, sf):
    return read_as_of(spark, _snapshots(spark, sf), date(2001, 5, 15))


# --- population and cleaning -----------------------------------------------------------------------------------------


@query
def user_features(spark, sf):
    return star.load_profile(spark, sf).select(KEY, *star.FEATURE_COLUMNS)


@query
def user_flags(spark, sf):
    return star.load_profile(spark, sf).select(KEY, *[a.flag for a in star.ACTIONS])


@query
def profiles_from_state(spark, sf):
    """Profiles of the eligible users at two cutoffs, both merged from one stored state per user and day."""
    customer, orders = scan(spark, sf, "customer"), scan(spark, sf, "orders")
    path = f"{staging_dir(spark)}/state-{uuid.uuid4().hex}"
    userstate.write_state(userstate.daily_state(orders, scan(spark, sf, "lineitem")), path)
    users = stage(star.raw_users(customer, orders), "users")
    rows = None
    for period in (star.Period(date(2000, 7, 1), date(2001, 1, 1)), PERIOD):
        eligible = population.eligible_users(users, period.as_of, ELIGIBLE_DAYS)
        state = userstate.read_state(spark, path, period.as_of.isoformat())
        own = userstate.profile_at(customer, state, period, eligible).withColumn("cutoff", F.lit(period.cutoff))
        rows = own if rows is None else rows.unionByName(own)
    return star.mark_sentinel(rows).select("cutoff", KEY, *star.FEATURE_COLUMNS, *[a.flag for a in star.ACTIONS])


@query
def indexed_features(spark, sf):
    """Frequency indexes of a small and a larger categorical; from the fifth value on all share one."""
    spec = FeatureSpec(("c_mktsegment", "nation"), ())
    users = scan(spark, sf, "customer").select(F.col("c_custkey").alias(KEY), "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    return training.indexed(users, spec, 4).select(KEY, "c_mktsegment_index", "nation_index")


@query
def feature_set_projection(spark, sf):
    return cleaning.project_features(star.load_profile(spark, sf), RECURRING.features, RECURRING.flag)


@query
def vendor_rename(spark, sf):
    return cleaning.vendor_rename(star.load_profile(spark, sf).select(KEY, *star.FEATURE_COLUMNS), star.VENDOR_CODES)


@query
def null_sentinel(spark, sf):
    return cleaning.null_sentinel(star.load_profile(spark, sf).select(KEY, "segment", "acctbal"))


@query
def complete_cases(spark, sf):
    return _population(spark, sf)


@query
def null_audit(spark, sf):
    return cleaning.null_audit(
        cleaning.null_sentinel(star.load_profile(spark, sf).select(KEY, *star.FEATURE_COLUMNS))
    )


@query
def class_balance(spark, sf):
    return population.class_balance(_population(spark, sf), RECURRING.flag)


@query
def positive_class(spark, sf):
    return population.positive_class(_population(spark, sf), RECURRING.flag)


@query
def negative_class(spark, sf):
    return population.negative_class(_population(spark, sf), RECURRING.flag)


@query
def class_ratio(spark, sf):
    return population.class_ratio(_population(spark, sf), RECURRING.flag)


@query
def downsample_negative(spark, sf):
    everyone = stage(_population(spark, sf), "population")
    return population.downsample_negative(everyone, RECURRING.flag).select(KEY, RECURRING.flag)


@query
def value_distribution(spark, sf):
    return distributions.value_distribution(star.load_profile(spark, sf), ["segment", "n_orders", RECURRING.flag])


@query
def distribution_drift(spark, sf):
    everyone = stage(_population(spark, sf), "population")  # read for both sides, their totals and the class ratio
    return distributions.distribution_drift(
        population.negative_class(everyone, RECURRING.flag),
        population.downsample_negative(everyone, RECURRING.flag),
        RECURRING.features.columns,
    ).select("column", F.round("distance", 9).alias("distance"))


def _populations(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four populations a training run starts from, each stored."""
    everyone = stage(_population(spark, sf), "population")
    return {name: stage(df, name) for name, df in class_tables(everyone, RECURRING).items()}


@query
def feature_quantiles(spark, sf):
    """Exact deciles of every numeric feature of all users."""
    return quantiles.exact_quantiles(stage(star.load_profile(spark, sf).select(*NUMERIC), "features"), NUMERIC, 10)


@query
def binned_distribution(spark, sf):
    """Every feature of the four populations, over bins that the full one fills equally."""
    found = _populations(spark, sf)
    edges = distributions.common_edges(found["full_population"], NUMERIC)
    return distributions.binned_distribution(found, edges, RECURRING.features.categorical)


@query
def feature_drift(spark, sf):
    """How far three populations are from the full one, in every feature."""
    rows = distributions.drift(_populations(spark, sf), "full_population", NUMERIC, RECURRING.features.categorical)
    return rows.select("population", "column", F.round("psi", 9).alias("psi"), F.round("ks", 9).alias("ks"))


@query
def window_targets(spark, sf):
    users = scan(spark, sf, "customer").select(F.col("c_custkey").alias(KEY))
    actions = {
        star.BY_NAME[name].flag: F.col("o_orderpriority") == priority
        for name, (priority, _) in star.PRIORITIES.items()
    }
    orders = scan(spark, sf, "orders")
    return population.window_targets(
        users, orders, "o_custkey", "o_orderdate", actions, PERIOD.cutoff, PERIOD.as_of
    )


@query
def cast_numeric(spark, sf):
    """Numbers delivered as text; one segment delivers text that is no number."""
    text = star.load_profile(spark, sf).select(
        KEY,
        F.when(F.col("segment") == star.NULL_SENTINEL, F.lit("unknown"))
        .otherwise(F.col("acctbal").cast("string"))
        .alias("vx0001"),
        F.col("n_orders").cast("string").alias("vx0002"),
    )
    return cleaning.cast_numeric(text, cleaning.infer_roles(text).numeric)


@query
def training_union(spark, sf):
    everyone = stage(_population(spark, sf), "population")
    positive = population.positive_class(everyone, RECURRING.flag)
    negative = population.downsample_negative(everyone, RECURRING.flag)
    return training_data(positive, negative, RECURRING, RECURRING.features)


@query
def train_split(spark, sf):
    data = cleaning.rename_target(_population(spark, sf), RECURRING.flag)
    return population.with_split(data.select(KEY, "target"))


# --- evaluation ------------------------------------------------------------------------------------------------------


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_evaluation(spark, sf), by=["action"])


@query
def model_performance(spark, sf):
    return metrics.model_performance(_evaluation(spark, sf), by=["action"])


@query
def auc_roc(spark, sf):
    return metrics.auc_roc(_evaluation(spark, sf), by=["action"])


@query
def roc_curve(spark, sf):
    return metrics.roc_curve(_evaluation(spark, sf), by=["action"])


@query
def f1_by_threshold(spark, sf):
    return metrics.f1_by_threshold(_evaluation(spark, sf), by=["action"])


@query
def recall_by_threshold(spark, sf):
    return metrics.recall_by_threshold(_evaluation(spark, sf), by=["action"])


@query
def precision_by_threshold(spark, sf):
    return metrics.precision_by_threshold(_evaluation(spark, sf), by=["action"])


# --- training (learned values, no SQL counterpart) ---------------------------------------------------------------------


def _labelled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored training rows of one action, split into train and test."""
    everyone = stage(_population(spark, sf), "population")
    positive = population.positive_class(everyone, RECURRING.flag)
    negative = population.downsample_negative(everyone, RECURRING.flag)
    data = stage(training_data(positive, negative, RECURRING, RECURRING.features), "training")
    return population.train_test_split(data)


def _model(train: DataFrame):
    pipeline = training.build_pipeline(RECURRING.features, QUICK)
    gbt = pipeline.getStages()[-1]
    return pipeline.fit(train, {gbt.maxIter: QUICK.max_iter[0], gbt.maxDepth: QUICK.max_depth[0]})


@query
def gbt_scores(spark, sf):
    train, _ = _labelled(spark, sf)
    users = scoring.scorable_users(star.load_profile(spark, sf), RECURRING)
    return scoring.inference_frame(_model(train).transform(users), RECURRING)


@query
def cv_grid(spark, sf):
    """AUC of each grid point over three folds."""
    train, _ = _labelled(spark, sf)
    return training.staged_search(stage(train, "train"), RECURRING.features, GRID).grid


@query
def cv_grid_points(spark, sf):
    """The grid of a search without what is learned: that each point has an AUC, and that the best one is a point."""
    train, _ = _labelled(spark, sf)
    found = training.staged_search(stage(train, "train"), RECURRING.features, GRID)
    best = F.lit(True)
    for name, value in found.best.items():
        best &= F.col(name) == value
    return found.grid.select(
        "max_iter", "max_depth", "step_size",
        F.coalesce(F.col("auc").between(0, 1), F.lit(False)).alias("has_auc"),
        (~best | (F.col("auc") == F.max("auc").over(Window.partitionBy()))).alias("best_is_highest"),
        F.sum(best.cast("int")).over(Window.partitionBy()).alias("n_best"),
    )


@query
def stored_model_scores(spark, sf):
    """Two stored models of one name: the newer one, loaded as pipeline and as node table, scores every scorable user alike."""
    train, _ = _labelled(spark, sf)
    model = _model(train)
    base = f"{staging_dir(spark)}/models-{uuid.uuid4().hex}"
    uris = [f"{base}/{version}" for version in ("V1p0", "V2p0")]
    save_model(model, uris[1])
    trees.tree_table(model, RECURRING.features).save(tree_path(uris[1]))
    registry = None
    for day, uri in enumerate(uris, 1):
        row = registry_row(spark, RECURRING.name, uri[-4:], uri, RECURRING.features.columns, training.best_params(model))
        row = row.withColumn("snapshot_date", F.timestamp_add("DAY", F.lit(day), F.lit("2001-01-01").cast("timestamp")))
        registry = row if registry is None else registry.unionByName(row)
    uri = latest_uris(registry, [RECURRING.name])[RECURRING.name]
    users = scoring.scorable_users(star.load_profile(spark, sf), RECURRING)
    scored = scoring.model_scorer(load_model(uri))(users, RECURRING)
    scored = scored.withColumnsRenamed({RECURRING.probability: "_p", RECURRING.prediction: "_c"})
    both = trees.tree_scorer(trees.load_tree_table(spark, tree_path(uri)))(scored, RECURRING)
    same = (F.abs(F.col("_p") - F.col(RECURRING.probability)) < 1e-12) & (F.col("_c") == F.col(RECURRING.prediction))
    return both.select(KEY, F.regexp_extract(F.lit(uri), "[^/]+$", 0).alias("version"), same.alias("same"), F.col("_p").between(0, 1).alias("in_range"))


def _attributions(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _labelled(spark, sf)
    users = scoring.scorable_users(star.load_profile(spark, sf), RECURRING)
    return trees.attributions(users, trees.tree_table(_model(train), RECURRING.features))


@query
def feature_attributions(spark, sf):
    """Whether the attributions of each scorable user add up to the margin that the model gives."""
    rows = _attributions(spark, sf)
    total = sum([F.col(f"phi_{c}") for c in RECURRING.features.columns], F.col("base"))
    return rows.select(KEY, (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up"))


@query
def attribution_summary(spark, sf):
    return trees.attribution_summary(_attributions(spark, sf))


def _frozen(spark: SparkSession, sf: str) -> tuple[DataFrame, trees.TreeTable]:
    users = stage(training_population(star.load_profile(spark, sf), RECURRING), "population")
    table = trees.TreeTable(spark.createDataFrame(FROZEN_NODES, trees.NODES), spark.createDataFrame(FROZEN_FEATURES, trees.FEATURES))
    return users, trees.with_cover(table, users)


@query
def frozen_tree_cover(spark, sf):
    return _frozen(spark, sf)[1].nodes.select("place", "cover")


@query
def frozen_attributions(spark, sf):
    """Attributions by two fixed trees: their values depend on the users alone."""
    names = ["base", *[f"phi_{name}" for _, name, _ in FROZEN_FEATURES], "margin"]
    return trees.attributions(*_frozen(spark, sf)).select(KEY, *[(F.round(c, 9) + 0.0).alias(c) for c in names])


@query
def feature_importance(spark, sf):
    train, _ = _labelled(spark, sf)
    return training.feature_importance(spark, _model(train), RECURRING.features)


@query
def permutation_importance(spark, sf):
    train, test = _labelled(spark, sf)
    return training.permutation_importance(_model(train), test, RECURRING.features)


@query
def permuted_features(spark, sf):
    """What shuffling gives each user: the numbers of the next user in hash order."""
    users = star.load_profile(spark, sf).filter("n_orders > 0")
    names = ("acctbal", "n_orders", "recency_days", "tenure_days")
    shifted = training.permuted_features(users.select(KEY, *names), FeatureSpec((), names))
    return shifted.select(KEY, *[F.col(f"_next_{c}").alias(c) for c in names])


# --- scoring ---------------------------------------------------------------------------------------------------------


@query
def scorable_users(spark, sf):
    return scoring.scorable_users(star.load_profile(spark, sf), RECURRING)


@query
def unscored_users(spark, sf):
    users = star.load_profile(spark, sf)
    return scoring.unscored_users(users, scoring.scorable_users(users, RECURRING))


@query
def scores_with_defaults(spark, sf):
    users = star.load_profile(spark, sf)
    return scoring.with_defaults(users, deciles.score_deciles(_recurring_scored(users), RECURRING), RECURRING)


@query
def score_deciles(spark, sf):
    return deciles.score_deciles(_recurring_scored(star.load_profile(spark, sf)), RECURRING)


@query
def score_deciles_by_cuts(spark, sf):
    """The same: there is one way for any number of users."""
    return deciles.score_deciles(_recurring_scored(star.load_profile(spark, sf)), RECURRING)


@query
def approx_deciles(spark, sf):
    return deciles.approx_deciles(_recurring_scored(star.load_profile(spark, sf)), RECURRING)


@query
def transport_scores(spark, sf):
    users = star.load_profile(spark, sf)
    return scoring.table_scores(users.select(KEY, TRANSPORT.flag), star.outside_table(users), TRANSPORT)


@query
def binary_decisioning(spark, sf):
    return scoring.binary_decisioning(star.load_profile(spark, sf), RULES)


def _all_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all actions, those of transport joined from the outside table; stored for the deciles."""
    users = stage(star.load_profile(spark, sf), "profile")
    return stage(scoring.score_actions(users, star.ACTIONS, star.table_scorers(star.outside_table(users))), "scores")


@query
def user_level_scores(spark, sf):
    return score_table(_all_scored(spark, sf), star.ACTIONS)


@query
def user_level_scores_by_cuts(spark, sf):
    return score_table(_all_scored(spark, sf), star.ACTIONS)


@query
def gathered_scores(spark, sf):
    """The same scores from one row per user and action."""
    scores = stage(_scored_wide(spark, sf), "scores")
    rows = F.array(
        *[
            F.struct(
                F.lit(a.name).alias("action"),
                F.col(a.probability).alias("probability"),
                F.col(a.prediction).alias("prediction"),
                F.col(a.decile).alias("decile"),
            )
            for a in scored_actions(star.ACTIONS)
        ]
    )
    long = deciles.with_deciles(scores, scored_actions(star.ACTIONS)).select(KEY, F.inline(rows)).filter("decile > 0")
    users = scan(spark, sf, "customer").select(F.col("c_custkey").alias(KEY))
    return scoring.gather_scores(users, long, scored_actions(star.ACTIONS))


@query
def score_summary(spark, sf):
    columns = [c for a in scored_actions(star.ACTIONS) for c in (a.probability, a.prediction)]
    return _rounded(distributions.exact_profile(stage(_scored_wide(spark, sf), "scores"), columns))


def _rounded(stats: DataFrame) -> DataFrame:
    whole = ("column", "n", "min", "p25", "p50", "p75", "max")
    return stats.select(*whole, *[F.round(c, 9).alias(c) for c in ("mean", "stddev")])


@query
def rank_summary(spark, sf):
    ranks = stage(ranking.rank_actions(_scored_wide(spark, sf), star.ACTIONS), "ranks")
    return _rounded(distributions.exact_profile(ranks, [a.name for a in star.ACTIONS]))


# --- ranking ---------------------------------------------------------------------------------------------------------


@query
def scores_with_flags(spark, sf):
    users = star.load_profile(spark, sf)
    scores = scoring.binary_decisioning(users, RULES).join(
        _scored_wide(spark, sf).select(KEY, *[a.prediction for a in scored_actions(star.ACTIONS)]), KEY
    )
    return ranking.scores_with_flags(scores, users, star.ACTIONS)


def _action_scores(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.action_scores(_scored_wide(spark, sf), star.ACTIONS, modifier_table(spark))


@query
def action_scores(spark, sf):
    return _action_scores(spark, sf)


@query
def unpivot_scores(spark, sf):
    return ranking.unpivot_scores(_action_scores(spark, sf))


@query
def raw_ranks(spark, sf):
    return ranking.raw_ranks(ranking.unpivot_scores(_action_scores(spark, sf))).select(KEY, "key", "raw_rank")


@query
def action_ranks(spark, sf):
    return ranking.action_ranks(ranking.unpivot_scores(_action_scores(spark, sf))).select(KEY, "key", "raw_rank", "rank")


@query
def pivoted_ranks(spark, sf):
    long = ranking.action_ranks(ranking.unpivot_scores(_action_scores(spark, sf)))
    return ranking.pivot_ranks(long, star.ACTIONS)


@query
def user_level_ranks(spark, sf):
    return ranking.rank_actions(_scored_wide(spark, sf), star.ACTIONS)
