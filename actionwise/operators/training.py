"""Gradient-boosted-tree pipeline per action: indexing, assembling, grid search with cross-validation, importances."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..sources.tables import stage
from ..specs import KEY, FeatureSpec, TrainSpec
from .metrics import auc_roc
from .population import with_fold
from .scoring import positive_probability
from .trees import ensemble_nodes, leaves_reached, margin_of


def string_indexer(features: FeatureSpec) -> StringIndexer:
    """One indexer for all categoricals; values unseen in training and NULL share an extra index."""
    return StringIndexer(
        inputCols=list(features.categorical),
        outputCols=[f"{c}_index" for c in features.categorical],
        handleInvalid="keep",
    )


def frequent_values(df: DataFrame, column: str, most: int) -> list[str]:
    """The `most` most frequent values, ties in alphabetical order; NULL is none. Counted with map-side combine, and only these reach the driver."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("value IS NOT NULL")
    return [r["value"] for r in counts.orderBy(F.desc("n"), "value").limit(most).collect()]


def bounded_indexers(df: DataFrame, features: FeatureSpec, most: int) -> list[StringIndexerModel]:
    """Indexes by frequency for at most `most` values per categorical; rare, unknown and missing ones share the next index.

    So a categorical of any size has no more than most + 1 indexes, and trees with as many bins never fail on it. Up to `most` values
    the result is that of `string_indexer`. A column without any value has the empty text as its only one.
    """
    return [
        StringIndexerModel.from_labels(frequent_values(df, c, most) or [""], inputCol=c, outputCol=f"{c}_index", handleInvalid="keep")
        for c in features.categorical
    ]


def indexed(df: DataFrame, features: FeatureSpec, most: int) -> DataFrame:
    """The rows with `<categorical>_index`."""
    return PipelineModel(stages=bounded_indexers(df, features, most)).transform(df)


def assembler(features: FeatureSpec) -> VectorAssembler:
    """Indexed categoricals, then numerics; incomplete rows pass through and are masked after scoring."""
    inputs = [f"{c}_index" for c in features.categorical] + list(features.numeric)
    return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")


def classifier(spec: TrainSpec) -> GBTClassifier:
    """Node ids are cached per row, which spares deep trees from being shipped and walked again at every level."""
    return GBTClassifier(
        labelCol="target", featuresCol="features", seed=spec.seed, maxBins=spec.max_bins, cacheNodeIds=True
    )


def build_pipeline(features: FeatureSpec, spec: TrainSpec) -> Pipeline:
    indexers = [string_indexer(features)] if features.categorical else []
    return Pipeline(stages=[*indexers, assembler(features), classifier(spec)])


def evaluator() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol="target", metricName="areaUnderROC")


def param_grid(gbt: GBTClassifier, spec: TrainSpec) -> list:
    return (
        ParamGridBuilder()
        .addGrid(gbt.maxIter, list(spec.max_iter))
        .addGrid(gbt.maxDepth, list(spec.max_depth))
        .addGrid(gbt.stepSize, list(spec.step_size))
        .build()
    )


def cross_validate(train: DataFrame, features: FeatureSpec, spec: TrainSpec) -> CrossValidatorModel:
    """Grid search over hash folds; indexers are fitted on the training rows of each fold.

    The grid points of a fold are fitted `parallelism` at a time.
    """
    pipeline = build_pipeline(features, spec)
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=param_grid(pipeline.getStages()[-1], spec),
        evaluator=evaluator(),
        numFolds=spec.folds,
        seed=spec.seed,
        parallelism=spec.parallelism,
        foldCol="fold",
    )
    return search.fit(with_fold(train, spec.folds, spec.seed))


def grid_metrics(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """Average cross-validation AUC per grid point."""
    rows = []
    for params, metric in zip(model.getEstimatorParamMaps(), model.avgMetrics):
        named = {p.name: v for p, v in params.items()}
        rows.append((named["maxIter"], named["maxDepth"], named["stepSize"], float(metric)))
    return spark.createDataFrame(rows, "max_iter int, max_depth int, step_size double, auc double")


@dataclass(frozen=True)
class SearchResult:
    """Outcome of a grid search: AUC per point, the best point, and the pipeline fitted with it on all rows."""

    grid: DataFrame
    best: dict[str, float]
    model: PipelineModel


def fold_vectors(folded: DataFrame, features: FeatureSpec, fold: int, spec: TrainSpec = TrainSpec()) -> tuple[DataFrame, DataFrame]:
    """Stored vectors of the rows outside a fold, and of those inside as arrays; indexers know the outer rows only."""
    outer, inner = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
    prepare = Pipeline(stages=[*bounded_indexers(outer, features, spec.max_bins - 1), assembler(features)]).fit(outer)
    left = stage(prepare.transform(outer).select("target", "features"), f"fold-{fold}")
    return left, prepare.transform(inner).select("target", vector_to_array("features").alias("x"))


def staged_scores(folded: DataFrame, features: FeatureSpec, spec: TrainSpec) -> DataFrame:
    """(fold, max_iter, max_depth, step_size, target, score) of each row in each grid point, by models that didn't see it.

    Boosting adds tree after tree, and neither its data nor its seeds depend on how many follow. So the first k trees of a long ensemble are
    the ensemble fitted with maxIter k, and one fit per fold, depth and step answers for all numbers of trees. Vectors are made once per
    fold; the fits run `parallelism` at a time; all scores come from one pass over the rows.
    """
    session = folded.sparkSession
    vectors = {fold: fold_vectors(folded, features, fold, spec) for fold in range(spec.folds)}
    gbt = classifier(spec)
    points = [(fold, depth, step) for fold in vectors for depth in spec.max_depth for step in spec.step_size]

    def fit(point: tuple[int, int, float]):
        fold, depth, step = point
        return gbt.fit(vectors[fold][0], {gbt.maxIter: max(spec.max_iter), gbt.maxDepth: depth, gbt.stepSize: step})

    pool = ThreadPool(spec.parallelism)
    try:
        fitted = dict(zip(points, pool.map(inheritable_thread_target(session)(fit), points)))
    finally:
        pool.close()
    scored = None
    for fold, (_, inner) in vectors.items():
        own = [(depth, step) for f, depth, step in points if f == fold]
        values = {f"v{k}": leaves_reached(ensemble_nodes(fitted[fold, *p]), F.col("x"))["value"] for k, p in enumerate(own)}
        cells = [
            F.struct(F.lit(trees).alias("max_iter"), F.lit(depth).alias("max_depth"), F.lit(step).alias("step_size"), margin_of(F.col(f"v{k}"), trees).alias("score"))
            for k, (depth, step) in enumerate(own)
            for trees in spec.max_iter
        ]
        rows = inner.withColumns(values).select(F.lit(fold).alias("fold"), "target", F.inline(F.array(*cells)))
        scored = rows if scored is None else scored.unionByName(rows)
    return scored


def staged_search(train: DataFrame, features: FeatureSpec, spec: TrainSpec) -> SearchResult:
    """Grid search with cross-validation over hash folds, with one fit for all numbers of trees.

    A point's AUC is the average over folds, each exact; a fold whose rows are all of one class takes no part. Equal points: the smaller model.
    """
    session = train.sparkSession
    scored = staged_scores(with_fold(train, spec.folds, spec.seed), features, spec)
    names = ["max_iter", "max_depth", "step_size"]
    grid = auc_roc(scored, by=["fold", *names]).groupBy(*names).agg(F.avg("auc").alias("auc"))
    rows = [tuple(r) for r in grid.collect()]  # one row per grid point
    rows += [(*p, None) for p in ((i, d, s) for i in spec.max_iter for d in spec.max_depth for s in spec.step_size) if p not in {r[:3] for r in rows}]
    best = max(rows, key=lambda r: (-1.0 if r[3] is None else r[3], -r[0], -r[1], -r[2]))
    gbt = classifier(spec)
    pipeline = Pipeline(stages=[*bounded_indexers(train, features, spec.max_bins - 1), assembler(features), gbt])
    model = pipeline.fit(train, dict(zip((gbt.maxIter, gbt.maxDepth, gbt.stepSize), best)))
    table = session.createDataFrame(rows, "max_iter int, max_depth int, step_size double, auc double")
    return SearchResult(table, dict(zip(names, best)), model)


def best_params(model: PipelineModel) -> dict[str, str]:
    gbt = model.stages[-1]
    return {"maxIter": str(gbt.getMaxIter()), "maxDepth": str(gbt.getMaxDepth()), "stepSize": str(gbt.getStepSize())}


def evaluation_frame(model: PipelineModel, test: DataFrame) -> DataFrame:
    """(id, target, score, prediction) of held-out rows."""
    return model.transform(test).select(KEY, "target", positive_probability().alias("score"), "prediction")


def feature_importance(spark: SparkSession, model: PipelineModel, features: FeatureSpec) -> DataFrame:
    """(feature, importance) of the tree ensemble, mapped back to column names."""
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(w)) for name, w in zip(features.columns, weights)], "feature string, importance double"
    )


RANGES = 4096  # hash ranges in which rows are put in order


def permuted_features(test: DataFrame, features: FeatureSpec, seed: int = 7) -> DataFrame:
    """Add `_next_<feature>`: the values of the next user in the order (hash, key); the last one gets the first one's.

    Users are put in order inside fixed ranges of the hash. The last one of a range takes the first one of the next range that has users, from
    a table of one row per range. The result depends on the keys and the seed alone.
    """
    names = features.columns
    place = F.struct("_order", KEY)
    ordered = test.withColumn("_order", hash32(KEY, seed + 1)).withColumn("_range", F.expr(f"_order div {2**32 // RANGES}"))
    heads = ordered.groupBy("_range").agg(F.min_by(F.struct(*names), place).alias("head"))
    along = Window.orderBy("_range")
    first = F.first("head").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follow = heads.select("_range", F.coalesce(F.lead("head").over(along), first).alias("_follow"))
    inside = Window.partitionBy("_range").orderBy("_order", KEY)
    shifted = ordered.withColumn("_lead", F.lead(F.struct(*names)).over(inside)).join(follow, "_range")
    shifted = shifted.withColumn("_lead", F.coalesce("_lead", "_follow"))
    return shifted.withColumns({f"_next_{c}": F.col("_lead")[c] for c in names}).drop("_lead", "_follow", "_range", "_order")


def permutation_importance(model: PipelineModel, test: DataFrame, features: FeatureSpec, seed: int = 7) -> DataFrame:
    """(feature, auc, auc_drop): how much AUC falls when one feature is shuffled among the users.

    A feature is shuffled by giving each user the value of the next one in hash order. All features are scored in one pass over rows
    tagged with the feature that was shuffled: as many copies of a test row as there are features, and one more.
    """
    shifted = permuted_features(test, features, seed)
    variants = F.array(F.lit("none"), *[F.lit(c) for c in features.columns])
    shuffled = shifted.withColumn("feature", F.explode(variants)).withColumns(
        {c: F.when(F.col("feature") == c, F.col(f"_next_{c}")).otherwise(F.col(c)) for c in features.columns}
    )
    scored = model.transform(shuffled).select("feature", "target", positive_probability().alias("score"))
    auc = auc_roc(scored, by=["feature"])
    base = auc.filter(F.col("feature") == "none").select("auc").scalar()
    return auc.filter(F.col("feature") != "none").select("feature", "auc", (base - F.col("auc")).alias("auc_drop"))
