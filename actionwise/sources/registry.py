"""Append-only registry of trained models."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REGISTRY_SCHEMA = "model_name string, version string, s3_uri string, features array<string>, params map<string,string>"


def registry_row(
    spark: SparkSession, name: str, version: str, uri: str, features: Sequence[str] = (), params: dict[str, str] | None = None
) -> DataFrame:
    """One row describing a trained model, its feature list and chosen parameters included."""
    return spark.createDataFrame([(name, version, uri, list(features), params or {})], REGISTRY_SCHEMA)


def append_registry(row: DataFrame, table: str, at: datetime | None = None) -> None:
    """Append with the time of the snapshot."""
    stamp = F.lit(at) if at else F.current_timestamp()
    row.withColumn("snapshot_date", stamp).write.mode("append").format("parquet").saveAsTable(table)


def latest_models(registry: DataFrame) -> DataFrame:
    """Newest row per model name; several of the same time are decided by the uri.

    max_by combines on the map side, so a name with a very long history is reduced before the shuffle.
    """
    newest = F.max_by(F.struct("version", "s3_uri"), F.struct("snapshot_date", "s3_uri", "version"))
    return (
        registry.groupBy("model_name")
        .agg(newest.alias("row"), F.max("snapshot_date").alias("snapshot_date"))
        .select("model_name", "row.version", "row.s3_uri", "snapshot_date")
    )


def latest_uris(registry: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """Uri of the newest model per name: one query, one row per name asked for."""
    rows = latest_models(registry.filter(F.col("model_name").isin(list(names)))).collect()
    return {r["model_name"]: r["s3_uri"] for r in rows}


# --- evaluation history

HISTORY_SCHEMA = (
    "model_name string, version string, s3_uri string, trained_at timestamp, features array<string>, params map<string,string>, "
    "metrics struct<auc:double,tp:bigint,fp:bigint,tn:bigint,fn:bigint,recall:double,precision:double,accuracy:double,f1:double>, "
    "grid array<struct<max_iter:int,max_depth:int,step_size:double,auc:double>>, "
    "curve array<struct<threshold:double,precision:double,recall:double,f1:double>>, importance map<string,double>"
)
METRICS = ("auc", "tp", "fp", "tn", "fn", "recall", "precision", "accuracy", "f1")


def history_row(
    row: DataFrame, performance: DataFrame, auc: DataFrame, grid: DataFrame, curve: DataFrame, importance: DataFrame, at: datetime | None = None
) -> DataFrame:
    """A registry row with everything known about the model's quality, in nested columns. All tables are bounded: `curve` by its bins."""
    scalar = lambda df, e: df.agg(F.expr(e).alias("x")).scalar()
    metrics = performance.withColumn("auc", auc.select("auc").scalar()).select(F.struct(*METRICS).alias("metrics"))
    nested = {
        "metrics": metrics.scalar(),
        "grid": scalar(grid, "sort_array(collect_list(struct(max_iter, max_depth, step_size, auc)))"),
        "curve": scalar(curve, "sort_array(collect_list(struct(threshold, precision, recall, f1)))"),
        "importance": scalar(importance, "map_from_entries(sort_array(collect_list(struct(feature, importance))))"),
        "trained_at": F.lit(at) if at else F.current_timestamp(),
    }
    kinds = [part.strip().split(" ", 1) for part in re.split(r", (?=\w+ )", HISTORY_SCHEMA)]
    return row.withColumns(nested).select(*[F.col(c).cast(t) for c, t in kinds])


def append_history(row: DataFrame, table: str) -> None:
    row.write.mode("append").format("parquet").saveAsTable(table)


def model_history(history: DataFrame, metric: str = "auc") -> DataFrame:
    """Each model version with its metrics, how it compares to the champion before it, and whether it is the champion of its name now.

    Champion is the highest metric so far, ties going to the older version: a challenger must be better. A name's versions are few.
    """
    order = Window.partitionBy("model_name").orderBy("trained_at", "version", "s3_uri")
    earlier, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("model_name")
    value = F.col(f"metrics.{metric}")
    place = F.struct(F.coalesce(value, F.lit(-1.0)).alias("value"), (-F.row_number().over(order)).alias("age"))
    ranked = history.withColumns({"value": value, "best_before": F.max(value).over(earlier), "_place": place})
    return ranked.withColumns(
        {
            "gain": F.col("value") - F.col("best_before"),
            "took_over": F.coalesce(F.col("value") > F.col("best_before"), F.col("best_before").isNull() & F.col("value").isNotNull()),
            "is_champion": F.col("_place") == F.max("_place").over(whole),
        }
    ).select("model_name", "version", "s3_uri", "trained_at", "metrics", "value", "best_before", "gain", "took_over", "is_champion")


def champion_uris(history: DataFrame, names: Sequence[str], metric: str = "auc") -> dict[str, str]:
    """Uri of the best model per name, rather than of the newest."""
    rows = model_history(history.filter(F.col("model_name").isin(list(names))), metric).filter("is_champion").collect()
    return {r["model_name"]: r["s3_uri"] for r in rows}


def save_model(model: Model, uri: str) -> None:
    model.write().overwrite().save(uri)


def load_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)
