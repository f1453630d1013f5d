"""Small column helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL on an empty denominator (also under ANSI mode)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def complete(columns: Iterable[str]) -> str:
    """SQL condition: none of the columns is NULL."""
    return " AND ".join(f"{c} IS NOT NULL" for c in columns) or "true"


OCTAVES = 40   # scores nearer to 0 than 2^-40 share a bucket, as do those beyond 2^40
STEPS = 1024   # buckets per octave


def finite(score: Column) -> Column:
    """Score as a finite double; NULL counts as the lowest, NaN as the highest."""
    top = F.lit(1.7e308)
    return F.greatest(F.least(F.coalesce(score.cast("double"), -top), top), -top)


def score_bucket(score: Column, steps: int = STEPS) -> Column:
    """Bucket number, monotone in the score, between -(2 OCTAVES + 1) steps and (2 OCTAVES + 1) steps.

    Buckets have equal relative width on both sides of 0, so that scores of any scale spread over many buckets.
    """
    p = finite(score)
    size = F.least(F.greatest(F.abs(p), F.lit(2.0**-OCTAVES)), F.lit(2.0**OCTAVES))
    octave = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-OCTAVES)), F.lit(OCTAVES))
    step = F.floor((size * F.pow(F.lit(2.0), -octave) - 1) * steps)
    place = 1 + (octave + OCTAVES) * steps + F.greatest(F.least(step, F.lit(steps - 1)), F.lit(0))
    return F.when(F.abs(p) < 2.0**-OCTAVES, 0).when(p > 0, place).otherwise(-place).cast("int")
