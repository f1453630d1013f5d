"""User populations: eligibility, labels, class balance, audience samples and splits."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from ..functions.hashing import hash_fraction
from ..specs import KEY, MODEL_SEED, SAMPLE_SEED, TRAIN_FRACTION


def eligible_users(users: DataFrame, as_of: date, days: int) -> DataFrame:
    """Users verified within the period before as_of and still open on that day."""
    since = F.date_sub(F.lit(as_of), days)
    still_open = F.col("closed_at").isNull() | (F.col("closed_at") > F.lit(as_of))
    return users.select(KEY, "verified_at", "closed_at").filter((F.col("verified_at") >= since) & still_open)


def window_targets(
    users: DataFrame, facts: DataFrame, actor: str, at: str, actions: Mapping[str, Column], start: date, end: date
) -> DataFrame:
    """1 if the user took the action inside [start, end), else 0; one pass over the facts for all actions.

    actions: column name -> condition on a fact row.
    """
    inside = facts.filter((F.col(at) >= F.lit(start)) & (F.col(at) < F.lit(end)))
    taken = inside.groupBy(F.col(actor).alias(KEY)).agg(
        *[F.max(F.when(hit, F.lit(1)).otherwise(F.lit(0))).alias(name) for name, hit in actions.items()]
    )
    return users.select(KEY).join(taken, KEY, "left").fillna(0, subset=list(actions))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows per target value."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def positive_class(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target) == 1)


def negative_class(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target) == 0)


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """(positives, negatives, ratio) from one aggregate; the ratio is NULL without negatives."""
    counts = df.agg(
        F.count_if(F.col(target) == 1).alias("positives"), F.count_if(F.col(target) == 0).alias("negatives")
    )
    return counts.withColumn("ratio", ratio(F.col("positives"), F.col("negatives")))


def downsample_negative(df: DataFrame, target: str, seed: int = SAMPLE_SEED, key: str = KEY) -> DataFrame:
    """About as many negatives as there are positives; all of them when they already are the smaller class.

    A negative is kept when the hash of its key falls below the class ratio, so the sample is the same for every
    partitioning, engine and rerun. The ratio is a scalar subquery.
    """
    fraction = class_ratio(df, target).select(F.least(F.coalesce("ratio", F.lit(1.0)), F.lit(1.0))).scalar()
    return negative_class(df, target).filter(hash_fraction(key, seed) < fraction)


def training_union(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """UNION ALL of the class tables, matched by column name."""
    return positive.unionByName(negative)


def with_split(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = MODEL_SEED, key: str = KEY) -> DataFrame:
    """Mark rows `train` or `test` by key hash."""
    return df.withColumn("split", F.when(hash_fraction(key, seed) < fraction, "train").otherwise("test"))


def train_test_split(
    df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = MODEL_SEED, key: str = KEY
) -> tuple[DataFrame, DataFrame]:
    inside = hash_fraction(key, seed) < fraction
    return df.filter(inside), df.filter(~inside)


def with_fold(df: DataFrame, folds: int, seed: int, key: str = KEY) -> DataFrame:
    """Cross-validation fold in [0, folds) by key hash; a seed of its own keeps it independent of the split."""
    return df.withColumn("fold", F.floor(hash_fraction(key, seed + 1) * folds).cast("int"))


def duplicate_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Keys that occur more than once, with their number of rows; user and score tables must have none."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
