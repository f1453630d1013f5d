"""Population cleaning: sentinel values, complete cases, casts, renames, column roles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import KEY, NULL_SENTINEL, FeatureSpec


def null_sentinel(df: DataFrame, sentinel: str = NULL_SENTINEL) -> DataFrame:
    """Replace the literal sentinel string by NULL in all string columns."""
    text = {c: F.nullif(F.col(c), F.lit(sentinel)) for c, t in df.dtypes if t == "string"}
    return df.withColumns(text) if text else df


def complete_cases(df: DataFrame) -> DataFrame:
    """Rows without any NULL."""
    return df.na.drop("any")


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, one wide row from one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def project_features(df: DataFrame, features: FeatureSpec, target: str) -> DataFrame:
    """Key, the features of one model and its target."""
    return df.select(KEY, *features.columns, target)


def vendor_rename(df: DataFrame, codes: Mapping[str, str]) -> DataFrame:
    """Rename readable columns back to the vendor's codes."""
    return df.withColumnsRenamed({c: v for c, v in codes.items() if c in df.columns})


def cast_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast to double; text that is not a number becomes NULL instead of failing under ANSI mode."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def rename_target(df: DataFrame, flag: str) -> DataFrame:
    return df.withColumnRenamed(flag, "target")


def infer_roles(
    df: DataFrame, marker: str = "00", drop: Iterable[str] = (KEY, "target", "snapshot_date")
) -> FeatureSpec:
    """Derive feature roles from names: columns with the vendor marker, and all non-string ones, are numeric."""
    skip = set(drop)
    kept = [(c, t) for c, t in df.dtypes if c not in skip and not c.endswith("_binary")]
    categorical = tuple(c for c, t in kept if t == "string" and marker not in c)
    return FeatureSpec(categorical, tuple(c for c, _ in kept if c not in categorical))
