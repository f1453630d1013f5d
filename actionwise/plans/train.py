"""Training of the action models."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import cast_numeric, rename_target
from ..operators.metrics import auc_roc, model_performance, roc_curve, threshold_curves
from ..operators.population import train_test_split, training_union
from ..operators.training import best_params, evaluation_frame, feature_importance, staged_search
from ..operators.trees import tree_table
from ..sources.registry import append_history, append_registry, history_row, latest_uris, registry_row, save_model
from ..sources.tables import stage, staging_dir
from ..specs import ActionSpec, FeatureSpec, TrainSpec, model_actions
from .targets import table_name

CURVE_BINS = 100  # points of the curve kept in the history

@dataclass(frozen=True)
class TrainResult:
    """A trained action model with its evaluation tables."""

    action: ActionSpec
    model: PipelineModel
    uri: str
    grid: DataFrame
    performance: DataFrame
    auc: DataFrame
    roc: DataFrame
    curves: DataFrame
    importance: DataFrame


def coded_features(features: FeatureSpec, codes: Mapping[str, str]) -> FeatureSpec:
    """Feature names as they are stored."""
    return FeatureSpec(
        tuple(codes.get(c, c) for c in features.categorical), tuple(codes.get(c, c) for c in features.numeric)
    )


def tree_path(uri: str) -> str:
    """Where the node table of a stored pipeline stands."""
    return f"{uri.rstrip('/')}_trees"


def training_data(positive: DataFrame, negative: DataFrame, action: ActionSpec, features: FeatureSpec) -> DataFrame:
    """Both classes with numeric features cast and the flag renamed to `target`."""
    data = cast_numeric(training_union(positive, negative), features.numeric)
    return rename_target(data, action.flag).drop("snapshot_date")


def train_action(
    spark: SparkSession,
    action: ActionSpec,
    database: str,
    model_dir: str,
    registry: str,
    spec: TrainSpec = TrainSpec(),
    codes: Mapping[str, str] | None = None,
    lock: AbstractContextManager = nullcontext(),
) -> TrainResult:
    """Read the class tables, search the grid, evaluate on held-out users, store the model, append to registry and history.

    The history is the table `<registry>_history`. `lock` is held while these tables are appended to.
    """
    features = coded_features(action.features, codes or {})
    parts = [spark.table(table_name(database, action, part)) for part in ("positive_class", "negative_class")]
    staging_dir(spark)  # boosting cuts its own lineage in the checkpoint folder
    train, test = train_test_split(training_data(*parts, action, features), spec.train_fraction, spec.seed)
    search = staged_search(stage(train, f"train-{action.name}"), features, spec)  # read for each fold and point
    model = search.model
    uri = f"{model_dir.rstrip('/')}/{spec.version}/{action.name}"
    save_model(model, uri)
    tree_table(model, features).save(tree_path(uri))
    # the evaluation tables all start from the scored test users: score them once
    scored = stage(evaluation_frame(model, test), f"evaluation-{action.name}")
    result = TrainResult(
        action=action,
        model=model,
        uri=uri,
        grid=search.grid,
        performance=model_performance(scored),
        auc=auc_roc(scored),
        roc=roc_curve(scored),
        curves=threshold_curves(scored),
        importance=feature_importance(spark, model, features),
    )
    row = registry_row(spark, action.name, spec.version, uri, features.columns, best_params(model))
    quality = history_row(row, result.performance, result.auc, result.grid, threshold_curves(scored, bins=CURVE_BINS), result.importance)
    quality = stage(quality, f"history-{action.name}")
    with lock:
        append_history(quality, f"{registry}_history")
        append_registry(row, registry)  # last: a registered model is complete
    return result


@dataclass(frozen=True)
class TrainRun:
    """What became of each action: trained now, found trained before, or failed with an error."""

    trained: dict[str, TrainResult]
    resumed: dict[str, str]
    failed: dict[str, Exception]


def trained_before(spark: SparkSession, registry: str, names: Iterable[str], version: str) -> dict[str, str]:
    """Uri of the actions that already have a model of this version in the registry."""
    if not spark.catalog.tableExists(registry):
        return {}
    own = spark.table(registry).filter(F.col("version") == version)
    return latest_uris(own, list(names))


def train_pool(
    spark: SparkSession,
    actions: Sequence[ActionSpec],
    database: str,
    model_dir: str,
    registry: str,
    names: Iterable[str] | None = None,
    spec: TrainSpec = TrainSpec(),
    codes: Mapping[str, str] | None = None,
    workers: int = 2,
    resume: bool = True,
    one: Callable[..., TrainResult] | None = None,
) -> TrainRun:
    """Train actions `workers` at a time, each in a scheduler pool of its own, so that short stages of one fill the gaps of another.

    (Pools share executors evenly where the session sets spark.scheduler.mode=FAIR.) A failing action doesn't stop the others, and its error is
    returned. Models are registered as they are done: run again with `resume`, only the actions without a model of the spec's version
    are trained. Only training runs at once; the registry is appended to by one action at a time.
    """
    wanted = _wanted(actions, names)
    done = trained_before(spark, registry, [a.name for a in wanted], spec.version) if resume else {}
    train_one, lock = one or train_action, Lock()
    staging_dir(spark)  # set once, before the workers need it

    def work(action: ActionSpec) -> TrainResult | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"train-{action.name}")
        try:
            return train_one(spark, action, database, model_dir, registry, spec, codes, lock=lock)
        except Exception as error:  # the others go on; the caller sees what failed
            return error
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    todo = [a for a in wanted if a.name not in done]
    jobs = [(inheritable_thread_target(spark)(work), a) for a in todo]  # each with local properties of its own
    pool = ThreadPool(max(1, min(workers, len(todo))))
    try:
        ended = dict(zip((a.name for a in todo), pool.map(lambda job: job[0](job[1]), jobs, chunksize=1)))
    finally:
        pool.close()
    failed = {n: r for n, r in ended.items() if isinstance(r, Exception)}
    return TrainRun({n: r for n, r in ended.items() if n not in failed}, done, failed)


def _wanted(actions: Sequence[ActionSpec], names: Iterable[str] | None) -> list[ActionSpec]:
    known = {a.name for a in model_actions(actions)}
    wanted = known if names is None else set(names)
    if unknown := wanted - known:
        raise ValueError(f"no trainable action: {sorted(unknown)}")
    return [a for a in actions if a.name in wanted]


def train_actions(
    spark: SparkSession,
    actions: Sequence[ActionSpec],
    database: str,
    model_dir: str,
    registry: str,
    names: Iterable[str] | None = None,
    spec: TrainSpec = TrainSpec(),
    codes: Mapping[str, str] | None = None,
) -> dict[str, TrainResult]:
    """Train the selected actions (all with a model by default), one after the other; the first failure ends it."""
    return {a.name: train_action(spark, a, database, model_dir, registry, spec, codes) for a in _wanted(actions, names)}
