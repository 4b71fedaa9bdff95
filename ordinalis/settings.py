"""Run settings: one frozen dataclass, used on the driver only."""

from __future__ import annotations

from dataclasses import dataclass, field


# Ensemble weights of the four regressors, boosters first.
MODEL_WEIGHTS = {"boost_a": 0.4, "boost_b": 0.3, "boost_c": 0.2, "forest": 0.1}

# Start vector of the threshold search, one cut between neighbouring classes.
START_THRESHOLDS = (0.5, 1.5, 2.5, 3.5)


@dataclass(frozen=True)
class Settings:
    """Everything a whole run needs; the defaults are the full-size configuration."""

    seed: int = 42
    num_classes: int = 5

    # text stages
    translate: bool = True
    max_length: int = 512  # tokens of review and reply together, half for each
    vocab_size: int = 30_000

    # two-text classifier
    clean_before_fit: bool = False  # keyword cleaning before the classifier learns, not only before it scores
    all_train: bool = True
    holdout_share: float = 0.2
    num_epochs: int = 3
    batch_size: int = 16
    label_smoothing: float = 0.3
    hash_features: int = 1 << 16
    sentiment_reg: float = 0.01
    sentiment_iterations: int = 20
    cross_fit: bool = False  # score train rows out of fold instead of with the model that saw them
    pca_components: int = 2
    pca_fit_on: str = "all"  # or "train"

    # cross-validated ensemble
    num_trials: int = 10
    num_folds: int = 10
    weights: dict[str, float] = field(default_factory=lambda: dict(MODEL_WEIGHTS))
    boost_rounds: int = 1000
    patience: int = 100
    round_block: int | None = None  # longest block of rounds; None: as long as patience is sure to look
    refit_rounds: str = "all"  # or "mean_best": the folds' mean best round of the trial
    forest_trees: int = 80
    forest_depth: int = 7
    full_thresholds: bool = False  # cut between any two predictions instead of on edges of 1/256
    fit_threads: int | None = None  # fits that run at a time; None: as many as keep the cores busy

    def start_thresholds(self) -> tuple[float, ...]:
        """Where the threshold search starts: half way between neighbouring classes."""
        return tuple(k + 0.5 for k in range(self.num_classes - 1))

    def trial_seeds(self) -> list[int]:
        """One learner seed per trial: the base seed times 1, 2, 3, ..."""
        return [self.seed * (trial + 1) for trial in range(self.num_trials)]
