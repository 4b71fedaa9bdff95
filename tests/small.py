"""The whole run with few trials, folds and rounds, for unit tests only."""

from ordinalis.settings import Settings


def small_settings(**changes) -> Settings:
    base = dict(num_trials=2, num_folds=3, boost_rounds=5, forest_trees=10, forest_depth=5, patience=3,
                round_block=5, sentiment_iterations=5, hash_features=1 << 12)
    base.update(changes)
    return Settings(**base)
