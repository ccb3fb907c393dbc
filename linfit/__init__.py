"""Fit, tune and score linear models on Spark tables."""

from linfit.operators.bagging import BaggedModel, bagged_logistic_fit, bagged_predict
from linfit.operators.linear import LinearModel, linear_predict, ridge_fit
from linfit.operators.logistic import LogisticModel, logistic_fit, logistic_predict
from linfit.operators.metrics import binary_scores, confusion_matrix
from linfit.operators.minibatch import minibatch_logistic_fit
from linfit.operators.moments import gram
from linfit.operators.resample import holdout, with_fold
from linfit.plans.tuning import CVResult, cross_validate_logistic, param_grid

__all__ = [
    "BaggedModel",
    "CVResult",
    "LinearModel",
    "LogisticModel",
    "bagged_logistic_fit",
    "bagged_predict",
    "binary_scores",
    "confusion_matrix",
    "cross_validate_logistic",
    "gram",
    "holdout",
    "linear_predict",
    "logistic_fit",
    "logistic_predict",
    "minibatch_logistic_fit",
    "param_grid",
    "ridge_fit",
    "with_fold",
]
