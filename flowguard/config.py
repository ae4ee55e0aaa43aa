"""Experiment configuration: one frozen dataclass instead of module-level environment reads."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

# Fixed values that must equal the reference's for the same results.
MODEL_NAIVE_BAYES = "naive_bayes"
MODEL_LOGISTIC_REGRESSION = "logistic_regression"
MODEL_GBT = "gradient_boosted_trees"
MODEL_RANDOM_FOREST = "random_forest"
ENSEMBLE_HARD = "ensemble_hard_vote"
ENSEMBLE_SOFT = "ensemble_soft_vote"
# Training order: cheap models first, random forest last (also decides ties in ranking).
TRAINING_ORDER = (MODEL_NAIVE_BAYES, MODEL_LOGISTIC_REGRESSION, MODEL_GBT, MODEL_RANDOM_FOREST)
FAST_MODELS = (MODEL_NAIVE_BAYES, MODEL_RANDOM_FOREST)
MODEL_ALIASES = {"gbt": MODEL_GBT, "rf": MODEL_RANDOM_FOREST, "nb": MODEL_NAIVE_BAYES, "lr": MODEL_LOGISTIC_REGRESSION}
CICIDS_NORMAL_LABEL = "BENIGN"
KDD_NORMAL_LABEL = "normal"
BINARY_NORMAL = "normal"
BINARY_ATTACK = "attack"
LABEL_CANDIDATES = ("Label", " Label")
UNKNOWN_LABEL = "__unknown"
KDD_CATEGORICAL = ("protocol_type", "service", "flag")


@dataclass(frozen=True)
class ExperimentConfig:
    """All knobs of one experiment.

    Defaults are those of the command-line runner (binary mode, full profile, 30% sample).
    """

    dataset: str = "cicids"                 # "cicids" | "kdd" | any name for an already-loaded table
    mode: str = "binary"                    # "binary" | "multiclass"
    split: str = "file"                     # "file" | "random" | "hash"
    data_size: str = "full"                 # "small" | "medium" | "full"
    sample_fraction: float = 0.3            # share of the training rows that models are fitted on
    test_fraction: float = 1.0              # share of the test rows that are scored
    fast: bool = False
    class_weights: bool = True
    models: tuple[str, ...] = ()            # empty = fast set or full training order
    train_fraction: float = 0.8
    seed: int = 42
    rf_trees: int = 15
    gbt_iter: int = 50
    lr_iter: int = 100
    lr_reg: float = 0.01
    normal_label: str = CICIDS_NORMAL_LABEL
    train_sources: tuple[str, ...] = ()     # file split: source names for training
    test_sources: tuple[str, ...] = ()      # file split: source names for testing
    key_cols: tuple[str, ...] = ()          # hash split: the columns whose hash decides
    categorical: tuple[str, ...] = ()       # columns indexed with StringIndexer (set for KDD)
    keep_categorical_metadata: bool = False  # True: trees see nominal features (needs max_bins)
    max_bins: int = 32
    gbt_one_vs_rest: bool = False           # multiclass: train GBT one-vs-rest instead of leaving it out
    fit_threads: int = 4                    # models fitted side by side; 1: one after another
    label_col: str = "label"
    source_col: str = "source_file"

    def __post_init__(self) -> None:
        if self.mode not in ("binary", "multiclass"):
            raise ValueError(f"Unknown mode {self.mode!r}. Use binary or multiclass.")
        if self.split not in ("file", "random", "hash"):
            raise ValueError(f"Unknown split {self.split!r}. Use file, random or hash.")
        if not 0.0 < self.sample_fraction <= 1.0:
            raise ValueError("sample_fraction must be in (0, 1].")
        if not 0.0 < self.test_fraction <= 1.0:
            raise ValueError("test_fraction must be in (0, 1].")
        if self.dataset == "kdd":
            if not self.categorical:
                object.__setattr__(self, "categorical", KDD_CATEGORICAL)
            if self.normal_label == CICIDS_NORMAL_LABEL:
                object.__setattr__(self, "normal_label", KDD_NORMAL_LABEL)

    def with_(self, **changes) -> "ExperimentConfig":
        return replace(self, **changes)

    @classmethod
    def from_env(cls, env: dict | None = None) -> "ExperimentConfig":
        """Read the same variables the reference's users set (NIDS_*)."""
        env = os.environ if env is None else env

        def flag(name: str, default: str) -> bool:
            return env.get(name, default).lower() in ("1", "true", "yes")

        models = tuple(m.strip().lower() for m in env.get("NIDS_MODELS", "").split(",") if m.strip())
        dataset = env.get("NIDS_DATASET", "cicids").lower()
        return cls(
            dataset=dataset,
            mode=env.get("NIDS_MODE", "binary").lower(),
            split=env.get("NIDS_SPLIT", "file").lower(),
            data_size=env.get("NIDS_DATA_SIZE", "full").lower(),
            sample_fraction=float(env.get("NIDS_SAMPLE_FRACTION", "0.3")),
            fast=flag("NIDS_FAST", "0"),
            class_weights=flag("NIDS_CLASS_WEIGHTS", "1"),
            models=models,
            rf_trees=int(env.get("NIDS_RF_TREES", "15")),
            gbt_iter=int(env.get("NIDS_GBT_ITER", "50")),
            lr_iter=int(env.get("NIDS_LR_ITER", "100")),
            lr_reg=float(env.get("NIDS_LR_REG", "0.01")),
            normal_label=KDD_NORMAL_LABEL if dataset == "kdd" else CICIDS_NORMAL_LABEL,
        )
