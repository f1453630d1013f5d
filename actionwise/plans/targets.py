"""Target generation: the labelled, cleaned and class-balanced training tables of one action."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from ..operators.cleaning import complete_cases, null_sentinel, project_features, vendor_rename
from ..operators.population import downsample_negative, negative_class, positive_class
from ..sources.tables import write_snapshot
from ..specs import SAMPLE_SEED, ActionSpec

TABLES = ("full_population", "positive_class", "negative_class", "negative_class_all")


def table_name(database: str, action: ActionSpec, part: str) -> str:
    return f"{database}.{action.name}_users_{part}"


def training_population(users: DataFrame, action: ActionSpec) -> DataFrame:
    """Key, features and target of one action, complete cases only."""
    return complete_cases(null_sentinel(project_features(users, action.features, action.flag)))


def class_tables(population: DataFrame, action: ActionSpec, seed: int = SAMPLE_SEED) -> dict[str, DataFrame]:
    """The four populations a training run starts from."""
    return {
        "full_population": population,
        "positive_class": positive_class(population, action.flag),
        "negative_class": downsample_negative(population, action.flag, seed),
        "negative_class_all": negative_class(population, action.flag),
    }


def generate_targets(
    users: DataFrame,
    action: ActionSpec,
    database: str,
    codes: Mapping[str, str] | None = None,
    as_of: date | None = None,
    seed: int = SAMPLE_SEED,
) -> list[str]:
    """Write the four tables, vendor-coded and dated; returns their names.

    Features are computed once: the class tables are cut from the stored full population.
    """
    spark = users.sparkSession
    names = {part: table_name(database, action, part) for part in TABLES}
    write_snapshot(vendor_rename(training_population(users, action), codes or {}), names["full_population"], as_of)
    stored = spark.table(names["full_population"]).drop("snapshot_date")
    for part, df in class_tables(stored, action, seed).items():
        if part != "full_population":
            write_snapshot(df, names[part], as_of)
    return list(names.values())
