"""Declarative description of actions, feature roles and training settings."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

# Survivability modifier per action.
MODIFIERS = {
    "business_requirement_1": 1.01,
    "business_requirement_2": 1.00,
    "recurring_action": 0.9151,
    "auto_transport": 0.6667,
    "next_positive": 0.81673,
    "small_action": 0.7852,
    "long_term": 0.6453,
    "transport_action": 0.6657,
}

# Fixed values of the ranking rule.
TAKEN_SCORE = -1.0      # score of an action the user has already taken
TAKEN_RANK = 100        # rank shown for an action already taken
UNLIKELY_FACTOR = 0.1   # share of the modifier kept when the model predicts "no"
FOLLOW_STEP = 0.0001    # how far a following action ranks behind the one it follows

# Fixed values of training: search grid, folds, split, seeds.
MAX_DEPTHS = (2, 5, 10)
MAX_ITERS = (5, 20, 100)
STEP_SIZES = (0.01, 0.1)
MAX_BINS = 64
FOLDS = 3
TRAIN_FRACTION = 0.8
MODEL_SEED = 1234
SAMPLE_SEED = 123

KEY = "id"
NULL_SENTINEL = "null"


@dataclass(frozen=True)
class FeatureSpec:
    """Explicit feature roles; the key, the target and dates never are features."""

    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return self.categorical + self.numeric


@dataclass(frozen=True)
class ActionSpec:
    """One action that can be suggested to a user.

    kind: ``rule`` (a business requirement without a score), ``model`` (scored by a trained pipeline)
    or ``table`` (scores delivered by an outside process).
    suppressed_by: actions that, once taken, also count as having taken this one.
    follows: action this one is placed right behind whenever that action is predicted.
    """

    name: str
    kind: str = "model"
    features: FeatureSpec = field(default_factory=FeatureSpec)
    suppressed_by: tuple[str, ...] = ()
    follows: str | None = None

    @property
    def modifier(self) -> float:
        return MODIFIERS[self.name]

    @property
    def flag(self) -> str:
        return f"{self.name}_binary"

    @property
    def probability(self) -> str:
        return f"{self.name}_probability"

    @property
    def prediction(self) -> str:
        return f"{self.name}_prediction"

    @property
    def decile(self) -> str:
        return f"{self.name}_score_decile"

    @property
    def scored(self) -> str:
        return f"{self.name}_scored"

    @property
    def score(self) -> str:
        return f"{self.name}_score"

    @property
    def is_rule(self) -> bool:
        return self.kind == "rule"


ACTIONS = (
    ActionSpec("business_requirement_1", kind="rule"),
    ActionSpec("business_requirement_2", kind="rule"),
    ActionSpec("recurring_action"),
    ActionSpec("auto_transport"),
    ActionSpec("next_positive", suppressed_by=("recurring_action",)),
    ActionSpec("small_action"),
    ActionSpec("long_term"),
    ActionSpec("transport_action", kind="table", follows="auto_transport"),
)


def scored_actions(actions: Iterable[ActionSpec]) -> list[ActionSpec]:
    """Actions that carry a propensity score."""
    return [a for a in actions if not a.is_rule]


def model_actions(actions: Iterable[ActionSpec]) -> list[ActionSpec]:
    """Actions whose score comes from a trained pipeline."""
    return [a for a in actions if a.kind == "model"]


@dataclass(frozen=True)
class TrainSpec:
    """Hyper-parameter search settings."""

    max_depth: tuple[int, ...] = MAX_DEPTHS
    max_iter: tuple[int, ...] = MAX_ITERS
    step_size: tuple[float, ...] = STEP_SIZES
    max_bins: int = MAX_BINS
    folds: int = FOLDS
    train_fraction: float = TRAIN_FRACTION
    seed: int = MODEL_SEED
    parallelism: int = 4
    version: str = "V1p0"
