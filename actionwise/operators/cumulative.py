"""Running totals along a score without putting all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import STEPS, finite, score_bucket

PARTS = 4096  # equal parts of the score range that a bucket holds


def running_totals(
    points: DataFrame, measures: Sequence[str], by: Sequence[str] = (), score: str = "score", steps: int = STEPS, parts: int = PARTS
) -> DataFrame:
    """Add `<m>_to` (sum over rows with this score or a higher one) and `<m>_all` (sum over the group).

    points: one row per (by, score). Rows are cut into buckets of the score, and each bucket into equal parts between its own least and
    greatest score, so that scores crowded into a narrow range, of any scale or sign, spread out. Sums of buckets and of parts are
    small tables that say where a part starts; the ordered window only runs inside a part.
    """
    value = finite(F.col(score))
    cut = points.withColumns({"_bucket": score_bucket(F.col(score), steps), "_value": value})
    group, bucket, part = list(by), [*by, "_bucket"], [*by, "_bucket", "_part"]

    def before(place: list[str], inside: list[str]) -> Window:
        return Window.partitionBy(*inside).orderBy(F.col(place[-1]).desc()).rowsBetween(Window.unboundedPreceding, -1)

    def joined(left: DataFrame, right: DataFrame, key: list[str], more: list[str]) -> DataFrame:
        """Null-safe on the key, so that a NULL group keeps its rows."""
        renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in key], *more)
        match = F.lit(True)
        for c in key:
            match &= F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        return left.join(renamed, match).drop(*[f"_r_{c}" for c in key])

    per_bucket = cut.groupBy(*bucket).agg(
        F.min("_value").alias("_low"), F.max("_value").alias("_high"), *[F.sum(m).alias(m) for m in measures]
    )
    starts = per_bucket.select(
        *bucket,
        "_low",
        "_high",
        *[F.coalesce(F.sum(m).over(before(bucket, group)), F.lit(0)).alias(f"_{m}_bucket") for m in measures],
        *[F.sum(m).over(Window.partitionBy(*group)).alias(f"{m}_all") for m in measures],
    )
    whole = [f"_{m}_bucket" for m in measures] + [f"{m}_all" for m in measures]
    share = F.try_divide(F.col("_value") / 2 - F.col("_low") / 2, F.col("_high") / 2 - F.col("_low") / 2)
    placed = joined(cut, starts, bucket, ["_low", "_high", *whole]).withColumn("_part", F.coalesce(F.floor(share * parts), F.lit(0)))
    per_part = placed.groupBy(*part).agg(*[F.sum(m).alias(m) for m in measures])
    per_part = per_part.select(
        *part, *[F.coalesce(F.sum(m).over(before(part, bucket)), F.lit(0)).alias(f"_{m}_part") for m in measures]
    )
    inside = Window.partitionBy(*part).orderBy(F.col("_value").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = joined(placed, per_part, part, [f"_{m}_part" for m in measures])
    return running.select(
        *points.columns,
        *[(F.col(f"_{m}_bucket") + F.col(f"_{m}_part") + F.sum(m).over(inside)).alias(f"{m}_to") for m in measures],
        *[f"{m}_all" for m in measures],
    )
