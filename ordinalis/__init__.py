"""Ordinal text scoring on Spark: text features, classifiers, ensembles and kappa."""

__version__ = "0.1.0"
