"""Fully-connected neural networks over tables, as Spark jobs."""

from tabgrad.plans.fit import FitResult, TrainConfig, fit, fit_features, validate
from tabgrad.plans.forward import forward, score, score_predictions
from tabgrad.plans.model import Model

__all__ = [
    "FitResult",
    "Model",
    "TrainConfig",
    "fit",
    "fit_features",
    "forward",
    "score",
    "score_predictions",
    "validate",
]
