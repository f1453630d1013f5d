"""Scoring and ranking of all users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import vendor_rename
from ..operators.deciles import with_deciles
from ..operators.distributions import exact_profile
from ..operators.population import duplicate_keys
from ..operators.ranking import rank_actions
from ..operators.scoring import Scorer, flipped_flag, model_scorer, score_actions
from ..sources.registry import latest_uris, load_model
from ..sources.tables import stage, write_snapshot
from ..specs import KEY, ActionSpec, model_actions, scored_actions
from .train import coded_features


def user_level_scores(scores: DataFrame, actions: Sequence[ActionSpec]) -> DataFrame:
    """Output of `score_actions` to the score table: flipped business flags, and probability, prediction and decile
    of each action."""
    ranked = with_deciles(scores, scored_actions(actions))
    flags = [flipped_flag(a) for a in actions if a.is_rule]
    columns = [c for a in scored_actions(actions) for c in (a.probability, a.prediction, a.decile)]
    return ranked.select(KEY, *flags, *columns)


def newest_model_scorers(registry: DataFrame, actions: Sequence[ActionSpec]) -> dict[str, Scorer]:
    """Scorers from the newest stored pipeline of each model action."""
    names = [a.name for a in model_actions(actions)]
    uris = latest_uris(registry, names)
    missing = set(names) - set(uris)
    if missing:
        raise ValueError(f"no model registered for {sorted(missing)}")
    return {name: model_scorer(load_model(uris[name])) for name in names}


def coded_actions(actions: Sequence[ActionSpec], codes: Mapping[str, str]) -> list[ActionSpec]:
    """Actions whose features carry the names the models were trained on."""
    return [replace(a, features=coded_features(a.features, codes)) for a in actions]


def deploy(
    spark: SparkSession,
    users: DataFrame,
    actions: Sequence[ActionSpec],
    scorers: Mapping[str, Scorer],
    database: str,
    codes: Mapping[str, str] | None = None,
    modifiers: DataFrame | None = None,
    as_of: date | None = None,
    buckets: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Score users, write `user_level_scores` and `user_level_ranks`, and return both tables.

    The models run once: their output is staged, deciles and ranks both read the stage. A key that occurs twice, in the
    users or in an outside score table, is an error. What was written is profiled, quartiles included, into tables of the same names
    ending in `_profile`.
    """
    stored = coded_actions(actions, codes or {})
    scores = stage(score_actions(vendor_rename(users, codes or {}), stored, scorers), "scores")
    repeated = duplicate_keys(scores).take(1)
    if repeated:
        raise ValueError(f"user key is not unique: {repeated[0][KEY]!r} occurs {repeated[0]['n']} times")
    write_snapshot(user_level_scores(scores, stored), f"{database}.user_level_scores", as_of, buckets)
    write_snapshot(rank_actions(scores, stored, modifiers), f"{database}.user_level_ranks", as_of, buckets)
    written = [spark.table(f"{database}.user_level_{x}") for x in ("scores", "ranks")]
    columns = [[c for a in scored_actions(stored) for c in (a.probability, a.prediction, a.decile)], [a.name for a in stored]]
    for x, table, names in zip(("scores", "ranks"), written, columns):
        write_snapshot(exact_profile(table, names), f"{database}.user_level_{x}_profile", as_of)
    return tuple(written)
