"""Ordinary least squares and L2 logistic regression, from sums that Spark computes."""

from __future__ import annotations

from typing import Any

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators import metrics
from quern.operators.models.base import MATRIX, Estimator, document, new, ref
from quern.types import quoted


def gram(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means, and centred cross products of columns: one aggregation, of fixed size."""
    means = df.agg(F.count("*").alias("n"), *(F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(columns))).first()
    n, mean = means["n"], np.array([means[f"m{i}"] or 0.0 for i in range(len(columns))])
    centred = [F.col(quoted(c)) - F.lit(float(m)) for c, m in zip(columns, mean, strict=True)]
    sums = df.agg(*(F.sum(centred[i] * centred[j]).alias(f"s{i}_{j}") for i in range(len(columns)) for j in range(i + 1))).first()
    out = np.zeros((len(columns), len(columns)))
    for i in range(len(columns)):
        for j in range(i + 1):
            out[i, j] = out[j, i] = sums[f"s{i}_{j}"] or 0.0
    return n, mean, out


class LinearRegressor(Estimator):
    """OLS with intercept; the normal equations about the mean, minimum norm where they are singular."""

    def __init__(self, normalize: bool = False):
        self.normalize = normalize  # has no effect on the fit of OLS

    def build(self, df: DataFrame, target: int | str) -> LinearRegressor:
        rows = self._start(df, target)
        _, mean, products = gram(rows.dropna(), [*self.features, self.target])
        k = len(self.features)
        scale = np.sqrt(np.diag(products)[:k])
        scale[scale == 0] = 1
        a, b = products[:k, :k] / np.outer(scale, scale), products[:k, k] / scale
        self.coefficients = np.linalg.lstsq(a, b, rcond=1e-12)[0] / scale if k else np.zeros(0)
        self.intercept = float(mean[k] - self.coefficients @ mean[:k])
        return self

    def to_pfa(self) -> dict:
        kernel = {"m.kernel.linear": [new([float(c) for c in self.coefficients]), new([ref(c) for c in self.features])]}
        return document(self.features, {"+": [kernel, self.intercept]} if self.features else self.intercept)

    def get_info(self, df: DataFrame) -> dict[str, Any]:
        r = metrics.regression(self.predict(df), self.target, "prediction").first()
        return {"MSE": r["mse"], "R_squared": r["r2"]}


class LogisticClassifier(Estimator):
    """One-versus-rest logistic regression with an L2 penalty; C is the inverse strength for a sum of losses."""

    def __init__(self, C: float = 0.01, max_iter: int = 100):
        self.C, self.max_iter = C, max_iter

    def build(self, df: DataFrame, target: int | str) -> LogisticClassifier:
        rows = self._start(df, target).dropna()
        self.labels = sorted(r[0] for r in rows.select(quoted(self.target)).distinct().collect())
        if len(self.labels) < 2:
            raise ValueError("the target has fewer than two classes")
        assembled = VectorAssembler(inputCols=self.features, outputCol="_x").transform(rows).select("_x", F.col(quoted(self.target)).alias("_label")).cache()
        penalty = 1 / (self.C * assembled.count())
        self.rows: list[tuple[np.ndarray, float]] = []
        for label in self.labels if len(self.labels) > 2 else self.labels[1:]:
            one = assembled.withColumn("_y", (F.col("_label") == label).cast("double"))
            fitted = LogisticRegression(featuresCol="_x", labelCol="_y", regParam=penalty, elasticNetParam=0, standardization=False, maxIter=self.max_iter, tol=1e-9).fit(one)
            self.rows.append((np.array(fitted.coefficients.toArray()), float(fitted.intercept)))
        assembled.unpersist()
        return self

    def to_pfa(self) -> dict:
        rows = self.rows if len(self.rows) > 1 else [(-self.rows[0][0], -self.rows[0][1]), self.rows[0]]
        weights = new([new([float(x) for x in w]) for w, _ in rows], MATRIX)
        inputs = new([new([ref(c)]) for c in self.features], MATRIX)
        scores = {"la.add": [{"la.dot": [weights, inputs]}, new([new([b]) for _, b in rows], MATRIX)]}
        return document(self.features, {"a.argmax": {"m.link.logit": scores}}, "int") | {"labels": self.labels}

    def get_info(self, df: DataFrame) -> dict[str, Any]:
        labelled = self.predict(df).withColumn("_class", F.element_at(F.array(*(F.lit(float(x)) for x in self.labels)), F.col("prediction").cast("int") + 1))
        share = metrics.accuracy(labelled.withColumn("_y", F.col(quoted(self.target)).cast("double")), "_y", "_class").first()["accuracy"]
        return {"ROC": share, "accuracy": share}
