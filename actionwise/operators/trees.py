"""Boosted trees as a table of nodes: scored by column expressions, cut to fewer trees, and explained per user.

A fitted pipeline becomes two small tables, which any reader of parquet can use without the library that fitted it:

    nodes     place (over all trees), tree, feature (-1 in a leaf), threshold or left categories, places of both children, value
              (already multiplied with the weight of its tree), cover (training rows that came by)
    features  feature, name, labels (of a categorical: a label's index is its place; NULL and unknown ones share the next index)

Both are bounded by the model (trees x 2 ** (depth + 1) nodes), never by the users.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import staging_dir
from ..specs import KEY, ActionSpec, FeatureSpec
from .scoring import Scorer

NODES = "place int, tree int, feature int, threshold double, categories array<double>, left int, right int, value double, cover bigint"
FEATURES = "feature int, name string, labels array<string>"
LEAVES_AT_ONCE = 512  # leaves a block of users is held against at once
USERS_AT_ONCE = 128


@dataclass(frozen=True)
class TreeTable:
    nodes: DataFrame
    features: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.nodes.sparkSession

    def save(self, path: str) -> None:
        self.nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        self.features.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_tree_table(spark: SparkSession, path: str) -> TreeTable:
    return TreeTable(spark.read.schema(NODES).parquet(f"{path}/nodes"), spark.read.schema(FEATURES).parquet(f"{path}/features"))


def ensemble_nodes(model: GBTClassificationModel) -> DataFrame:
    """Node table of a fitted ensemble, from the files that it stores itself as."""
    spark = SparkSession.active()
    path = f"{staging_dir(spark)}/ensemble-{uuid.uuid4().hex}"
    model.write().save(path)
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    rows = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    # one row per node, no more than the model has: they are put in order in one task
    order = Window.orderBy("tree", "id")
    placed = rows.withColumn("place", (F.row_number().over(order) - 1).cast("int")).withColumn("base", F.col("place") - F.col("id"))
    inner = F.col("leftChild") >= 0
    plain = F.col("split.numCategories") < 0
    return placed.select(
        "place",
        "tree",
        F.when(inner, F.col("split.featureIndex")).otherwise(-1).alias("feature"),
        F.when(inner & plain, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner & ~plain, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        F.when(inner, F.col("base") + F.col("leftChild")).alias("left"),
        F.when(inner, F.col("base") + F.col("rightChild")).alias("right"),
        (F.col("prediction") * F.get(weights, F.col("tree"))).alias("value"),
        F.col("rawCount").alias("cover"),
    )


def tree_table(model: PipelineModel, features: FeatureSpec) -> TreeTable:
    """Both tables of a fitted pipeline."""
    labels: dict[str, list[str]] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            names = stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
            labels |= {c: list(own) for c, own in zip(names, stage.labelsArray)}
    spark = SparkSession.active()
    rows = [(k, name, labels.get(name)) for k, name in enumerate(features.columns)]
    return TreeTable(ensemble_nodes(model.stages[-1]), spark.createDataFrame(rows, FEATURES))


def feature_array(table: TreeTable) -> Column:
    """The features of a user as the trees see them: indexes and numbers, NaN where a number is missing."""
    cells = []
    for row in table.features.orderBy("feature").collect():  # one row per feature of the model
        column = F.col(row["name"])
        if row["labels"] is None:
            cells.append(F.coalesce(column.cast("double"), F.lit(float("nan"))))
        else:
            known = F.array(*[F.lit(x) for x in row["labels"]]).cast("array<string>")
            found = F.nullif(F.array_position(known, column.cast("string")), F.lit(0))
            cells.append((F.coalesce(found, F.lit(len(row["labels"]) + 1)) - 1).cast("double"))
    return F.array(*cells)


def leaves_reached(nodes: DataFrame, features: Column) -> Column:
    """Array with the leaf (a node) each tree leads to, in the order of the trees.

    The node table is a constant of the plan: it comes once to each task, and not into the rows. A NaN never is at most a threshold: it goes
    right, as it does while fitting. `features` should be a plain column, as each step reads it.
    """
    rows = [r.asDict() for r in nodes.orderBy("place").collect()]  # bounded by the model
    kept = ("place", "feature", "threshold", "categories", "left", "right", "value")
    kind = "array<struct<place:int,feature:int,threshold:double,categories:array<double>,left:int,right:int,value:double>>"
    table = F.from_json(F.lit(json.dumps([{c: r[c] for c in kept if r[c] is not None} for r in rows])), kind)
    firsts = {r["tree"]: r["place"] for r in reversed(rows)}
    roots = F.array(*[F.lit(firsts[tree]) for tree in sorted(firsts)]).cast("array<int>")
    steps = F.sequence(F.lit(1), F.lit(max(1, depth_of(rows))))

    def step(place: Column, _: Column) -> Column:
        node = F.get(table, place)
        x = F.get(features, node["feature"])
        left = F.when(node["categories"].isNull(), x <= node["threshold"]).otherwise(F.array_contains(node["categories"], x))
        return F.when(node["feature"] < 0, place).when(left, node["left"]).otherwise(node["right"])

    return F.transform(roots, lambda root: F.get(table, F.aggregate(steps, root, step)))


def depth_of(rows: Sequence[dict]) -> int:
    """Most splits on the way to a leaf; children stand behind their parents."""
    depth: dict[int, int] = {}
    for row in rows:
        own = depth.setdefault(row["place"], 0)
        for child in (row["left"], row["right"]):
            if child is not None:
                depth[child] = own + 1
    return max(depth.values(), default=0)


def margin_of(values: Column, trees: int | None = None) -> Column:
    """Sum over the first `trees` trees (all by default) of an array of leaf values."""
    own = values if trees is None else F.slice(values, 1, trees)
    return F.aggregate(own, F.lit(0.0), lambda total, value: total + value)


def probability_of(margin: Column) -> Column:
    """Probability of class 1: the logistic function of twice the margin."""
    return 1 / (1 + F.exp(-2 * margin))


def tree_scorer(table: TreeTable) -> Scorer:
    """Scorer that needs nothing but the node table: no model object and no Python worker."""

    def score(users: DataFrame, action: ActionSpec) -> DataFrame:
        found = users.withColumn("_x", feature_array(table))
        found = found.withColumn("_margin", margin_of(leaves_reached(table.nodes, F.col("_x"))["value"]))
        return found.withColumns(
            {
                action.probability: probability_of(F.col("_margin")),
                action.prediction: F.when(F.col("_margin") > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
            }
        ).drop("_x", "_margin")

    return score


def with_cover(table: TreeTable, users: DataFrame) -> TreeTable:
    """The same trees with the cover counted on other users: how many of them come by each node."""
    found = users.select(F.explode(leaves_reached(table.nodes, feature_array(table))["place"]).alias("place"))
    counts = {r["place"]: r["n"] for r in found.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one row per leaf
    rows = [r.asDict() for r in table.nodes.orderBy("place").collect()]
    for row in reversed(rows):  # children stand behind their parents
        row["cover"] = counts.get(row["place"], 0) if row["left"] is None else rows[row["left"]]["cover"] + rows[row["right"]]["cover"]
    return TreeTable(table.spark.createDataFrame([tuple(r[c] for c in table.nodes.columns) for r in rows], NODES), table.features)


# --- attributions


@dataclass(frozen=True)
class Leaves:
    """All leaves with what their paths ask of each feature. Arrays are (leaf, feature)."""

    value: np.ndarray
    low: np.ndarray    # a number must be above; infinite where the path never goes right
    high: np.ndarray   # and at most this; infinite where the path never goes left
    share: np.ndarray  # cover share of the path's splits on the feature, 1 if there is none
    allowed: np.ndarray  # (leaf, feature, index): indexes of categoricals that stay on the path
    categorical: np.ndarray

    @classmethod
    def of(cls, rows: Sequence, features: int, categories: int) -> Leaves:
        nodes = {r["place"]: r for r in rows}
        children = {c for r in rows for c in (r["left"], r["right"]) if c is not None}
        categorical = np.zeros(features, bool)
        out: list[tuple] = []
        start = (np.full(features, -np.inf), np.full(features, np.inf), np.ones(features), np.ones((features, categories), bool))
        todo = [(p, *start) for p in nodes if p not in children]
        while todo:
            place, low, high, share, allowed = todo.pop()
            node = nodes[place]
            if node["left"] is None:
                out.append((node["value"], low, high, share, allowed))
                continue
            j = node["feature"]
            for side in ("left", "right"):
                child = nodes[node[side]]
                own = [low.copy(), high.copy(), share.copy(), allowed.copy()]
                own[2][j] *= child["cover"] / node["cover"] if node["cover"] else 0.0
                if node["categories"] is None:
                    if side == "left":
                        own[1][j] = min(own[1][j], node["threshold"])
                    else:
                        own[0][j] = max(own[0][j], node["threshold"])
                else:
                    categorical[j] = True
                    hit = np.isin(np.arange(categories), node["categories"])
                    own[3][j] &= hit if side == "left" else ~hit
                todo.append((node[side], *own))
        columns = [np.array([r[k] for r in out]).reshape(len(out), *shape) for k, shape in enumerate(((), (features,), (features,), (features,), (features, categories)))]
        return cls(*columns, categorical)

    def block(self, part: slice) -> Leaves:
        return Leaves(self.value[part], self.low[part], self.high[part], self.share[part], self.allowed[part], self.categorical)

    def met(self, x: np.ndarray) -> np.ndarray:
        """(user, leaf, feature): whether the feature stays on the path. NaN only ever goes right."""
        wide = x[:, None, :]
        inside = (np.isinf(self.low) | (wide > self.low)) & (wide <= self.high)
        number = np.where(np.isnan(wide), np.isinf(self.high), inside)
        if not self.categorical.any():
            return number
        index = np.where(self.categorical, x, 0).astype(np.int64)
        label = self.allowed[np.arange(len(self.value))[None, :, None], np.arange(x.shape[1])[None, None, :], index[:, None, :]]
        return np.where(self.categorical, label, number)


def shapley(leaves: Leaves, x: np.ndarray) -> np.ndarray:
    """(user, feature) attributions of the trees' margin.

    What a leaf gives to a set S of features is its value, times 1 or 0 for each feature in S (met or not), times the cover share for each other.
    The weights of all sets together are an integral over t of the product of `t met + (1 - t) share`, leaving out the feature
    itself: a polynomial in t, which as many Gauss-Legendre points as half the features integrate exactly.
    """
    features = x.shape[1]
    points, weights = np.polynomial.legendre.leggauss(features // 2 + 1)
    out = np.zeros(x.shape)
    for a in range(0, len(leaves.value), LEAVES_AT_ONCE):
        part = leaves.block(slice(a, a + LEAVES_AT_ONCE))
        met = part.met(x).astype(float)
        others = np.zeros(met.shape)
        for t, weight in zip((points + 1) / 2, weights / 2):
            factor = t * met + (1 - t) * part.share
            ahead = np.ones(met.shape)
            ahead[..., 1:] = np.cumprod(factor[..., :-1], axis=2)
            behind = np.ones(met.shape)
            behind[..., :-1] = np.cumprod(factor[..., :0:-1], axis=2)[..., ::-1]
            others += weight * ahead * behind
        out += np.einsum("l,ulf,ulf->uf", part.value, met - part.share, others)
    return out


def attributions(users: DataFrame, table: TreeTable, key: str = KEY) -> DataFrame:
    """(key, base, phi_<feature>..., margin): how much each feature moves a user's margin away from the average over the cover.

    base + all phi = margin. Users stay where they are; tasks hold the model's leaves and blocks of users in numpy. As column
    expressions the same takes an interpreted loop over leaves, features and points per user, about a hundred times slower.
    """
    rows = table.nodes.collect()
    named = table.features.orderBy("feature").collect()
    leaves = Leaves.of(rows, len(named), max([len(r["labels"]) + 1 for r in named if r["labels"] is not None], default=1))
    base = float((leaves.value * leaves.share.prod(axis=1)).sum())
    names = [f"phi_{r['name']}" for r in named]
    inputs = users.withColumn("_x", feature_array(table)).withColumn("margin", margin_of(leaves_reached(table.nodes, F.col("_x"))["value"]))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), USERS_AT_ONCE):
                part = batch.iloc[a : a + USERS_AT_ONCE]
                phi = shapley(leaves, np.stack(part["_x"].to_numpy()))
                yield pd.DataFrame({key: part[key].to_numpy(), "base": base, **dict(zip(names, phi.T)), "margin": part["margin"].to_numpy()})

    key_type = dict(users.dtypes)[key]
    schema = ", ".join([f"{key} {key_type}", "base double", *[f"`{n}` double" for n in names], "margin double"])
    return inputs.select(key, "_x", "margin").mapInPandas(explain, schema)


def attribution_summary(rows: DataFrame) -> DataFrame:
    """(feature, mean_abs, mean) over all users: which features move scores most, and where to."""
    names = [c for c in rows.columns if c.startswith("phi_")]
    cells = [cell for c in names for cell in (F.lit(c.removeprefix("phi_")), F.col(c))]
    long = rows.select(F.stack(F.lit(len(names)), *cells).alias("feature", "phi"))
    return long.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"), F.avg("phi").alias("mean"))
