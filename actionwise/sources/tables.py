"""Tables: scans, schema creation, dated snapshots, staged intermediates."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import KEY, MODIFIERS


def scan(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read a parquet table below a directory."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def with_snapshot(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Add snapshot_date; today unless a date is given, which makes reruns reproducible."""
    return df.withColumn("snapshot_date", F.lit(as_of) if as_of else F.current_date())


def write_snapshot(df: DataFrame, table: str, as_of: date | None = None, buckets: int = 0, key: str = KEY) -> None:
    """Replace a catalog table, schema included, by a dated snapshot.

    With `buckets` the table is bucketed by its key, so that later joins of such tables on the key need no shuffle.
    """
    writer = with_snapshot(df, as_of).write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, key)
    writer.saveAsTable(table)


def write_dated(df: DataFrame, path: str, as_of: date) -> None:
    """Write the snapshot of a day into its own partition of a folder; other days stay, the day's older state is replaced.

    Only the partitions written are replaced, and only when all tasks have committed: a job that fails leaves the day as it was.
    A day may also be replaced by an empty snapshot.
    """
    day = f"{path.rstrip('/')}/snapshot_date={as_of.isoformat()}"
    rows = df.drop("snapshot_date")
    held = stage(rows, "snapshot")  # computed in full, and checked, before anything of the day is touched
    if held.isEmpty():
        held.coalesce(1).write.mode("overwrite").parquet(day)
    else:
        dated = held.withColumn("snapshot_date", F.lit(as_of))
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots of a folder with their `snapshot_date`; a column that an older one lacks is NULL there."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return rows.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def read_as_of(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    """The newest snapshot not later than a day; only its partition is read. Without one, an empty table."""
    history = snapshot_history(spark, path)
    newest = history.filter(F.col("snapshot_date") <= F.lit(as_of)).agg(F.max("snapshot_date")).scalar()
    return history.filter(F.col("snapshot_date") == newest)


def survivability_table(spark: SparkSession, modifiers: dict[str, float] = MODIFIERS) -> DataFrame:
    """(action, modifier), one row per action: a literal relation, known in full to the optimizer."""
    rows = ", ".join(f"('{action}', {modifier!r}D)" for action, modifier in modifiers.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(action, modifier)")


def staging_dir(spark: SparkSession) -> str:
    """Shared folder for intermediates: the one the cluster names in spark.checkpoint.dir, else one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once as parquet and read it back: cuts the lineage, survives lost executors.

    As with checkpoints, the owner of the folder decides when old files go.
    """
    path = f"{staging_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
