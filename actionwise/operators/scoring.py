"""Scoring users for all actions.

A scorer is a callable (users, action) -> users with `<action>_probability` and `<action>_prediction` appended. Scores
of all actions live side by side on the user row, so scoring any number of models needs no join: users who may not be
scored (action taken, or a feature missing) keep their row and get the default by a conditional expression.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import complete
from ..specs import KEY, ActionSpec, scored_actions
from .cleaning import null_sentinel

Scorer = Callable[[DataFrame, ActionSpec], DataFrame]


def positive_probability(vector: str = "probability") -> Column:
    """Probability of class 1 from an ML vector column, without leaving the JVM."""
    return vector_to_array(F.col(vector))[1]


def inference_frame(predictions: DataFrame, action: ActionSpec) -> DataFrame:
    """Project a pipeline's output to (id, probability, prediction)."""
    return predictions.select(
        KEY,
        positive_probability().alias(action.probability),
        F.col("prediction").alias(action.prediction),
    )


def score_with_model(users: DataFrame, action: ActionSpec, uri: str) -> DataFrame:
    """Load a stored pipeline and score users with it."""
    return inference_frame(PipelineModel.load(uri).transform(users), action)


def model_scorer(model: PipelineModel) -> Scorer:
    """Scorer that appends the output of a trained pipeline to the user row."""

    def score(users: DataFrame, action: ActionSpec) -> DataFrame:
        scored = model.transform(users).withColumns(
            {action.probability: positive_probability(), action.prediction: F.col("prediction")}
        )
        extra = [c for c in scored.columns if c not in users.columns and c not in (action.probability, action.prediction)]
        return scored.drop(*extra)

    return score


def expression_scorer(probability: Column, threshold: float) -> Scorer:
    """Scorer from a column expression; predicts 1 from the threshold upwards."""

    def score(users: DataFrame, action: ActionSpec) -> DataFrame:
        return users.withColumns(
            {
                action.probability: probability.cast("double"),
                action.prediction: (probability >= threshold).cast("double"),
            }
        )

    return score


def outside_scores(scores: DataFrame, action: ActionSpec) -> DataFrame:
    """Rename an outside score table (user_id, transport_adoption_*) to the columns of the action."""
    return scores.select(
        F.col("user_id").alias(KEY),
        F.col("transport_adoption_prediction").alias(action.prediction),
        F.col("transport_adoption_probability").alias(action.probability),
    )


def table_scores(users: DataFrame, scores: DataFrame, action: ActionSpec) -> DataFrame:
    """LEFT JOIN of users with the outside score table; users absent from it keep NULL."""
    return users.join(outside_scores(scores, action), KEY, "left")


def table_scorer(scores: DataFrame) -> Scorer:
    """Scorer that reads an outside score table (one row per user)."""
    return lambda users, action: table_scores(users, scores, action)


def is_scorable(action: ActionSpec) -> str:
    """SQL condition: action not taken yet and every feature of its model present."""
    return f"{action.flag} = 0 AND {complete(action.features.columns)}"


def scorable_users(users: DataFrame, action: ActionSpec) -> DataFrame:
    """Users a model is applied to: (id, features), sentinel cleared, complete cases only."""
    features = null_sentinel(users.select(KEY, action.flag, *action.features.columns))
    return features.filter(is_scorable(action)).drop(action.flag)


def unscored_users(users: DataFrame, scorable: DataFrame) -> DataFrame:
    """Keys of users that are not scored."""
    return users.select(KEY).join(scorable.select(KEY), KEY, "left_anti")


def with_defaults(users: DataFrame, scored: DataFrame, action: ActionSpec) -> DataFrame:
    """All users with their score; 0.0 / 0.0 / decile 0 where there is none.

    One left join in place of an anti join plus a union.
    """
    columns = {a: d for a, d in ((action.probability, 0.0), (action.prediction, 0.0), (action.decile, 0)) if a in scored.columns}
    return users.select(KEY).join(scored.select(KEY, *columns), KEY, "left").fillna(columns)


def score_actions(users: DataFrame, actions: Sequence[ActionSpec], scorers: Mapping[str, Scorer]) -> DataFrame:
    """Wide scores of all actions.

    users: one row per user with flags and features. Returns (id, flags, and per scored action probability, prediction
    and the boolean `scored`). Predictions of users that may not be scored are 0.
    """
    wide = null_sentinel(users)
    out = [KEY, *(a.flag for a in actions)]
    marks = {}
    for action in scored_actions(actions):
        wide = scorers[action.name](wide, action)
        # decided once per row and used by both columns below
        marks[action.scored] = f"coalesce({is_scorable(action)} AND {action.probability} IS NOT NULL, false)"
        out += [
            f"if({action.scored}, {action.probability}, 0D) AS {action.probability}",
            f"if({action.scored}, {action.prediction}, 0D) AS {action.prediction}",
            action.scored,
        ]
    return wide.selectExpr("*", *[f"{mark} AS {name}" for name, mark in marks.items()]).selectExpr(*out)


def flipped_flag(rule: ActionSpec) -> Column:
    """The flag of a business rule turned round: 1 = not done yet, show it."""
    return F.when(F.col(rule.flag) == 0, F.lit(1)).otherwise(F.lit(0)).alias(rule.flag)


def binary_decisioning(users: DataFrame, rules: Sequence[ActionSpec]) -> DataFrame:
    """The flags of all business rules, flipped."""
    return users.select(KEY, *map(flipped_flag, rules))


def gather_scores(users: DataFrame, long: DataFrame, actions: Sequence[ActionSpec]) -> DataFrame:
    """Collect per-action score rows (id, action, probability, prediction, decile) into one wide row per user.

    One aggregation for all actions instead of a join per action; users or actions without a row get zeros.
    """
    parts = [
        F.expr(f"max({value}) FILTER (WHERE action = '{a.name}')").alias(column)
        for a in actions
        for value, column in (("probability", a.probability), ("prediction", a.prediction), ("decile", a.decile))
    ]
    wide = long.groupBy(KEY).agg(*parts)
    return users.select(KEY).join(wide, KEY, "left").fillna(0)
