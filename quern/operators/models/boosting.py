"""Gradient boosting with trees over binned features.

Features are binned once: their distinct values if these are few, else quantiles. A level of a tree is
one aggregation to (node, feature, bin), whose size is bounded by 2**depth * features * bins and doesn't
depend on the rows; cuts, child statistics and leaf values follow from it on the driver. The running
prediction is a column; it is written out every few trees, so plans stay short.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators import metrics
from quern.operators.durable import stored
from quern.operators.models.base import Estimator, document, new
from quern.operators.models.trees import Node, gains, leaf_expression, shares, tree_action
from quern.types import quoted

BINS = 256
STORE_EVERY = 10
TOP = 5


def cuts(rows: DataFrame, features: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Thresholds between bins by feature: midpoints of distinct values, or of quantiles where these are many."""
    sets = rows.agg(*(F.approx_count_distinct(quoted(f)).alias(f"d{i}") for i, f in enumerate(features))).first()
    out = {}
    for i, f in enumerate(features):
        if (sets[f"d{i}"] or 0) <= bins * 0.9:
            values = sorted(r[0] for r in rows.select(quoted(f)).where(F.col(quoted(f)).isNotNull()).distinct().limit(4 * bins).collect())
        else:
            values = sorted(set(rows.approxQuantile(f, [k / bins for k in range(bins + 1)], 0.001)))
        out[f] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    return out


def bin_of(feature: str, thresholds: list[float]) -> Column:
    """The number of thresholds below a value, by binary search in the JVM: array_position of the first not below."""
    if not thresholds:
        return F.lit(0)
    edges = F.array(*(F.lit(float(t)) for t in thresholds))
    return F.size(F.filter(edges, lambda t: t < F.col(quoted(feature))))


def grow_binned(rows: DataFrame, thresholds: dict[str, list[float]], r: str, h: str, *, max_depth: int, min_leaf: int, max_leaves: int | None, step: Any) -> dict[int, Node]:
    """A tree on the residuals r with columns b_<k> of bins; leaf values are step(sum r, sum h, n)."""
    features = list(thresholds)
    nodes: dict[int, Node] = {0: Node(0, 0, 0.0, [0.0])}
    level, leaves = [0], 1
    for depth in range(max_depth + 1):
        if not level:
            break
        inside = F.expr(leaf_expression(nodes, lambda x: str(x.id)))
        cells = F.explode(F.array(*(F.struct(F.lit(k).alias("f"), F.col(f"b_{k}").alias("b")) for k in range(len(features)))))
        found = rows.select(inside.alias("node"), r, h, cells.alias("c")).where(F.col("node").isin(level)).groupBy("node", "c.f", "c.b")
        found = found.agg(F.count("*").alias("n"), F.sum(r).alias("r"), F.sum(F.col(r) * F.col(r)).alias("q"), F.sum(h).alias("h")).toPandas()
        candidates = []
        for i, own in found.groupby("node"):
            node = nodes[int(i)]
            first = own[own.f == 0]
            n, total, square, weight = (float(first[c].sum()) for c in ("n", "r", "q", "h"))
            node.n, node.impurity, node.value = int(n), max(0.0, square / n - (total / n) ** 2), [step(total, weight, n)]
            if depth == max_depth or node.impurity <= 1e-12:
                continue
            best = (1e-9, None)
            for k, cell in own.groupby("f"):
                cell = cell.sort_values("b")
                left_n, left_r, at = np.cumsum(cell.n.to_numpy()), np.cumsum(cell.r.to_numpy()), cell.b.to_numpy()
                ok = (left_n >= min_leaf) & (n - left_n >= min_leaf)
                if ok.any():
                    gain = np.where(ok, left_r**2 / left_n + (total - left_r) ** 2 / np.maximum(n - left_n, 1) - total**2 / n, 0.0)
                    j = int(gain.argmax())
                    if gain[j] > best[0] * (1 + 1e-9):
                        best = (float(gain[j]), (features[int(k)], thresholds[features[int(k)]][int(at[j])]))
            if best[1]:
                candidates.append((best[0], node, best[1]))
        candidates.sort(key=lambda c: (-c[0], c[1].id))
        if max_leaves is not None:
            candidates = candidates[: max(0, max_leaves - leaves)]
        leaves += len(candidates)
        level = []
        for _, node, (feature, threshold) in candidates:
            node.feature, node.threshold, node.left, node.right = feature, threshold, len(nodes), len(nodes) + 1
            for child in (node.left, node.right):
                nodes[child] = Node(child, 0, 0.0, [0.0], depth=depth + 1)
                level.append(child)
    return nodes


def tree_column(nodes: dict[int, Node]) -> Column:
    return F.expr(leaf_expression(nodes, lambda x: f"CAST({x.value[0]!r} AS DOUBLE)"))


class _Boosted(Estimator):
    def __init__(self, n_estimators: int = 100, max_leaf_nodes: int = 32, min_samples_leaf: int = 1, learning_rate: float = 0.01, max_depth: int | None = None, random_state: int = 0):
        self.n, self.max_leaves, self.min_leaf, self.rate = n_estimators, max_leaf_nodes, min_samples_leaf, learning_rate
        self.max_depth = max_depth or math.ceil(math.log2(max_leaf_nodes))
        self.random_state = random_state  # the learner has no randomness
        self.trees: list[list[dict[int, Node]]] = []  # by stage, by class
        self.first: list[float] = []

    def _binned(self, rows: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
        thresholds = cuts(rows, self.features)
        return rows.select("*", *(bin_of(f, t).alias(f"b_{k}") for k, (f, t) in enumerate(thresholds.items()))), thresholds

    def importance(self) -> dict[str, float]:
        total: dict[str, float] = {}
        for stage in self.trees:
            for nodes in stage:
                own = gains(nodes)
                whole = sum(own.values()) or 1.0
                for c, g in own.items():
                    total[c] = total.get(c, 0.0) + g / whole
        return shares(total, self.features)

    def _dependence(self, df: DataFrame, model: dict) -> dict[str, list]:
        out = {}
        by_column: dict[str, list[str]] = {}
        for f in self.features:
            by_column.setdefault(f.split("__")[0], []).append(f)
        for c in metrics.top_features(self.importance(), TOP):
            labels = by_column[c]
            if labels == [c]:
                out[c] = [tuple(r) for r in metrics.partial_dependence(df, model, c, metrics.grid(df, c)).collect()]
            else:  # indicators: the effect at 1
                out[c] = [(f, metrics.partial_dependence(df, model, f, [1.0]).first()["prediction"]) for f in labels]
        return out


class BoostedRegressor(_Boosted):
    """Least squares: starts at the mean, each tree fits the residuals and counts with the learning rate."""

    def build(self, df: DataFrame, target: int | str) -> BoostedRegressor:
        rows, thresholds = self._binned(self._start(df, target))
        self.first = [float(rows.agg(F.avg(quoted(self.target))).first()[0] or 0.0)]
        rows = stored(rows.withColumn("_f", F.lit(self.first[0])).withColumn("_one", F.lit(1.0)), "boosting")
        for k in range(self.n):
            residual = rows.withColumn("_r", F.col(quoted(self.target)) - F.col("_f"))
            nodes = grow_binned(residual, thresholds, "_r", "_one", max_depth=self.max_depth, min_leaf=self.min_leaf, max_leaves=self.max_leaves, step=lambda r, h, n: r / n)
            self.trees.append([nodes])
            rows = rows.withColumn("_f", F.col("_f") + self.rate * tree_column(nodes))
            if (k + 1) % STORE_EVERY == 0 and k + 1 < self.n:
                rows = stored(rows, "boosting")
        return self

    def to_pfa(self) -> dict:
        trees = [tree_action(stage[0], lambda x: x.value[0]) for stage in self.trees]
        return document(self.features, {"+": [self.first[0], {"*": [self.rate, {"a.sum": new(trees)}]}]} if trees else self.first[0])

    def staged(self, df: DataFrame) -> DataFrame:
        return metrics.staged_regression(df, self.target, self.first[0], [self.rate * tree_column(s[0]) for s in self.trees])

    def get_info(self, df: DataFrame) -> dict[str, Any]:
        stages = self.staged(df).collect()
        return {
            "MSE": stages[-1]["mse"], "R_squared": stages[-1]["r2"], "staged": [tuple(r) for r in stages],
            "variable_importance": self.importance(), "partial_dependence": self._dependence(df, self.to_pfa()),
        }


class BoostedClassifier(_Boosted):
    """Deviance loss: one score for two classes (log odds), else one for each class (softmax), with Newton leaves."""

    def build(self, df: DataFrame, target: int | str) -> BoostedClassifier:
        rows, thresholds = self._binned(self._start(df, target))
        counts = rows.groupBy(F.col(quoted(self.target)).alias("y")).count().orderBy("y").collect()
        if len(counts) < 2:
            raise ValueError("the target has fewer than two classes")
        self.labels = [float(r["y"]) for r in counts]
        total = sum(r["count"] for r in counts)
        k = len(self.labels)
        if k == 2:
            p = counts[1]["count"] / total
            self.first = [math.log(p / (1 - p))]
            step = lambda r, h, n: r / h if abs(h) > 1e-150 else 0.0
        else:
            self.first = [r["count"] / total for r in counts]
            step = lambda r, h, n: (k - 1) / k * r / h if abs(h) > 1e-150 else 0.0
        scores = [f"_f{c}" for c in range(len(self.first))]
        rows = stored(rows.select("*", *(F.lit(x).alias(s) for x, s in zip(self.first, scores, strict=True))), "boosting")
        y = F.col(quoted(self.target))
        for stage in range(self.n):
            if k == 2:
                shares_ = [1 / (1 + F.exp(-F.col("_f0")))]
                wanted = [(y == self.labels[1]).cast("double")]
            else:
                top = F.greatest(*scores)
                whole = sum((F.exp(F.col(s) - top) for s in scores), F.lit(0.0))
                shares_ = [F.exp(F.col(s) - top) / whole for s in scores]
                wanted = [(y == label).cast("double") for label in self.labels]
            trees = []
            for p, w in zip(shares_, wanted, strict=True):
                residual = rows.withColumn("_r", w - p)
                weight = F.abs("_r") * (1 - F.abs("_r"))
                trees.append(grow_binned(residual.withColumn("_h", weight), thresholds, "_r", "_h", max_depth=self.max_depth, min_leaf=self.min_leaf, max_leaves=self.max_leaves, step=step))
            self.trees.append(trees)
            rows = rows.withColumns({s: F.col(s) + self.rate * tree_column(t) for s, t in zip(scores, trees, strict=True)})
            if (stage + 1) % max(1, STORE_EVERY // len(scores)) == 0 and stage + 1 < self.n:
                rows = stored(rows, "boosting")
        return self

    def _score(self, c: int) -> Any:
        trees = [tree_action(stage[c], lambda x: x.value[0]) for stage in self.trees]
        return {"+": [self.first[c], {"*": [self.rate, {"a.sum": new(trees)}]}]} if trees else self.first[c]

    def to_pfa(self) -> dict:
        scores = [self._score(c) for c in range(len(self.first))]
        if len(scores) == 1:
            scores = [{"-": [0.0, scores[0]]}, scores[0]]
        return document(self.features, {"a.argmax": new(scores)}, "int") | {"labels": self.labels}

    def staged(self, df: DataFrame) -> DataFrame:
        steps = [[self.rate * tree_column(stage[c]) for stage in self.trees] for c in range(len(self.first))]
        first = self.first
        if len(first) == 1:
            first, steps = [-first[0], first[0]], [[-s for s in steps[0]], steps[0]]
        return metrics.staged_accuracy(df, self.target, first, steps, self.labels)

    def get_info(self, df: DataFrame) -> dict[str, Any]:
        stages = self.staged(df).collect()
        dependence = {}
        for c, label in enumerate(self.labels if len(self.first) > 1 else self.labels[1:]):
            dependence[label] = self._dependence(df, document(self.features, self._score(c)))
        return {
            "ROC": stages[-1]["accuracy"], "accuracy": stages[-1]["accuracy"], "staged": [tuple(r) for r in stages],
            "variable_importance": self.importance(), "partial_dependence": dependence,
        }
