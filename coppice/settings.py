"""Typed job settings. Text values are parsed one by one, booleans by their word."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

# The setting names that existing configurations use, and ours.
ALIASES = {
    "fraction": "fraction",
    "numTrees": "trees",
    "n_estimators": "trees",
    "maxDepth": "depth",
    "max_depth": "depth",
    "max_features": "subset",
    "criterion": "impurity",
    "class_weight": "class_weight",
    "bootstrap": "bootstrap",
    "random_state": "seed",
}

TRUE_WORDS = {"true", "1", "yes"}
FALSE_WORDS = {"false", "0", "no"}


def parse_bool(text: str) -> bool:
    word = text.strip().lower()
    if word in TRUE_WORDS:
        return True
    if word in FALSE_WORDS:
        return False
    raise ValueError(f"not a boolean: {text!r}")


PARSERS = {"float": float, "int": int, "bool": parse_bool, "str": str}


@dataclass(frozen=True)
class TrainSettings:
    """How to split, prepare and fit.

    ``fit_partitions`` fixes the layout the learner sees, and so makes a fit repeatable on any
    cluster; ``0`` keeps the layout of the input and saves two shuffles. Only the forest draws
    random numbers by partition. ``max_memory_mb`` bounds the node statistics of one pass: more
    memory means fewer passes for deep trees or many columns. ``aggregation_depth`` is the depth of
    the tree in which the linear learners add up gradients; over very many partitions or hashed
    slots take 3 or 4, so that no task gathers too many of them. ``kernel_features`` random features
    stand for the Gaussian kernel of width ``gamma``, 0 meaning one over the number of inputs.
    """

    fraction: float = 0.7
    trees: int = 12
    depth: int = 10
    subset: str = "auto"
    impurity: str = "gini"
    class_weight: str = "none"
    bootstrap: bool = True
    seed: int = 21
    split_seed: int = 42
    stratified: bool = True
    max_categories: int = 4
    label_order: str = "alphabetAsc"
    invalid: str = "error"
    fit_partitions: int = 0
    max_iter: int = 10
    reg_param: float = 0.001
    text_features: int = 1 << 18
    max_bins: int = 32
    max_memory_mb: int = 256
    aggregation_depth: int = 2
    kernel_features: int = 256
    gamma: float = 0.0

    def __post_init__(self) -> None:
        if not 0.0 < self.fraction < 1.0:
            raise ValueError(f"fraction must lie between 0 and 1, not {self.fraction}")
        if self.class_weight not in ("none", "balanced"):
            raise ValueError(f"class_weight is 'none' or 'balanced', not {self.class_weight!r}")

    @classmethod
    def from_strings(cls, values: Mapping[str, str]) -> TrainSettings:
        kinds = {f.name: f.type for f in fields(cls)}
        parsed = {}
        for key, text in values.items():
            name = ALIASES.get(key, key)
            if name not in kinds:
                raise ValueError(f"unknown setting {key!r}")
            parsed[name] = PARSERS[kinds[name]](text)
        return cls(**parsed)

    def but(self, **changes: object) -> TrainSettings:
        return replace(self, **changes)

    def as_params(self) -> dict[str, str]:
        return {f.name: str(getattr(self, f.name)) for f in fields(self)}


# The two published configurations.
SMALL_FOREST = TrainSettings(fraction=0.7, trees=12, depth=10)
FULL_FOREST = TrainSettings(
    trees=100,
    depth=20,
    subset="auto",
    impurity="gini",
    class_weight="balanced",
    bootstrap=True,
    seed=21,
)

# Share of rows a split trains on when no size is asked for.
DEFAULT_FRACTION = 0.75
