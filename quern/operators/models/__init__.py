"""Predictive methods by name."""

from __future__ import annotations

from quern.operators.models.base import Estimator
from quern.operators.models.boosting import BoostedClassifier, BoostedRegressor
from quern.operators.models.linear import LinearRegressor, LogisticClassifier
from quern.operators.models.trees import TreeClassifier, TreeRegressor
from quern.types import Method

METHODS: dict[Method, type[Estimator]] = {
    Method.linear: LinearRegressor,
    Method.logit: LogisticClassifier,
    Method.tree_regression: TreeRegressor,
    Method.tree_classification: TreeClassifier,
    Method.boosted_regression: BoostedRegressor,
    Method.boosted_classification: BoostedClassifier,
}


def create(method: Method | str, **parameters) -> Estimator:
    return METHODS[Method(method)](**parameters)
