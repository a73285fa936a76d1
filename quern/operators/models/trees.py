"""Exact CART trees.

Large nodes are grown level by level with aggregations, one job for each level: rows, keyed by the node
they are in, are melted to (node, feature, value) and pre-aggregated; windows over each node's and feature's
distinct values give the running sums and the best cut; only the best cut of every node comes to the driver.
Rows move down by an expression made from the few large nodes, so no row is rewritten.

A node of SMALL rows or fewer is finished by one task, which has its rows in memory; all of them in one job.
Both ways choose the same cuts. Predictions of trees of more than WIDE nodes walk the node table in Arrow
batches, as one expression of so many branches would not compile.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators import metrics
from quern.operators.models.base import Estimator, document, ref
from quern.types import quoted

SMALL = 50_000
WIDE = 200


@dataclass
class Node:
    """A node of a tree; feature is None at a leaf. value: the mean, or the shares of the classes."""

    id: int
    n: int
    impurity: float
    value: list[float]
    feature: str | None = None
    threshold: float | None = None
    left: int | None = None
    right: int | None = None
    depth: int = 0


def best_splits(rows: DataFrame, node: Column, features: list[str], stats: list[str], min_leaf: int = 1) -> DataFrame:
    """(node, feature, threshold, gain, n_left): the best cut of every node, by the decrease of the sum of squares.

    stats: columns whose sum of squares counts; one target for regression, class indicators for gini (for
    indicators the sum of squares is n times the gini impurity, halved).
    """
    sums = [F.sum(s).alias(f"s{i}") for i, s in enumerate(stats)]
    melted = rows.select(node.alias("node"), *stats, F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(quoted(f)).alias("x")) for f in features))).alias("m"))
    melted = melted.select("node", "m.feature", "m.x", *stats).where("node IS NOT NULL AND x IS NOT NULL")
    cells = melted.groupBy("node", "feature", "x").agg(F.count("*").alias("n"), *sums)
    w = Window.partitionBy("node", "feature").orderBy("x")
    upto, whole = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("node", "feature")
    names = ["n", *(f"s{i}" for i in range(len(stats)))]
    run = cells.select("node", "feature", "x", F.lead("x").over(w).alias("next"), *(F.sum(c).over(upto).alias(f"l_{c}") for c in names), *(F.sum(c).over(whole).alias(f"t_{c}") for c in names))
    right = lambda c: F.col(f"t_{c}") - F.col(f"l_{c}")
    square = lambda pick, n: sum((pick(c) * pick(c) for c in names[1:]), F.lit(0.0)) / n
    gain = square(lambda c: F.col(f"l_{c}"), F.col("l_n")) + square(right, F.col("t_n") - F.col("l_n")) - square(lambda c: F.col(f"t_{c}"), F.col("t_n"))
    cuts = run.where(F.col("next").isNotNull() & (F.col("l_n") >= min_leaf) & (F.col("t_n") - F.col("l_n") >= min_leaf))
    cuts = cuts.select("node", F.struct(F.round(gain, 9).alias("gain"), (-F.array_position(F.array(*(F.lit(f) for f in features)), F.col("feature"))).alias("order"), (-F.col("x")).alias("x"), "feature", ((F.col("x") + F.col("next")) / 2).alias("threshold"), F.col("l_n").alias("n_left")).alias("cut"))
    best = cuts.groupBy("node").agg(F.max("cut").alias("cut"))
    return best.select("node", "cut.feature", "cut.threshold", "cut.gain", "cut.n_left")


def leaf_expression(nodes: dict[int, Node], value: Any, at: int = 0) -> str:
    """Nested CASE over a node table; value(node) is the SQL at a leaf."""
    node = nodes[at]
    if node.feature is None:
        return value(node)
    test = f"{quoted(node.feature)} <= CAST({node.threshold!r} AS DOUBLE)"
    return f"CASE WHEN {test} THEN {leaf_expression(nodes, value, node.left)} ELSE {leaf_expression(nodes, value, node.right)} END"


def tree_action(nodes: dict[int, Node], value: Any, at: int = 0) -> Any:
    """A tree as nested PFA ifs."""
    node = nodes[at]
    if node.feature is None:
        return {"double": value(node)}
    return {"if": {"<=": [ref(node.feature), node.threshold]}, "then": tree_action(nodes, value, node.left), "else": tree_action(nodes, value, node.right)}


def subtree(x: np.ndarray, y: np.ndarray, *, max_depth: int | None, min_split: int, min_leaf: int) -> list[tuple]:
    """(n, impurity, value, feature, threshold, left, right, depth) of the nodes of a tree over rows in memory; feature -1 at a leaf. A missing value goes right."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0)]
    made = 1
    for at in todo:  # grows while it is walked
        rows, depth = at
        own, n = y[rows], len(rows)
        means = own.sum(axis=0) / n
        impurity = max(0.0, float(((own * own).sum(axis=0) / n - means * means).sum()))
        node = [n, impurity, means.tolist(), -1, 0.0, -1, -1, depth]
        nodes.append(node)
        if n < max(2, min_split) or impurity <= 1e-12 or (max_depth is not None and depth >= max_depth):
            continue
        best = 1e-9
        for f in range(x.shape[1]):
            value = x[rows, f]
            order = np.argsort(value, kind="stable")
            order = order[: n - int(np.isnan(value).sum())]  # missing ones come last
            m, value = len(order), value[order]
            cut = np.flatnonzero(value[1:] > value[:-1])
            cut = cut[(cut + 1 >= min_leaf) & (m - cut - 1 >= min_leaf)]
            if not len(cut):
                continue
            total = np.cumsum(own[order], axis=0)
            left, whole, size = total[cut], total[-1], (cut + 1)[:, None]
            gain = np.round((left**2 / size + (whole - left) ** 2 / (m - size) - whole**2 / m).sum(axis=1), 9)
            k = int(gain.argmax())
            if gain[k] > best:
                best = float(gain[k])
                node[3], node[4] = f, float((value[cut[k]] + value[cut[k] + 1]) / 2)
        if node[3] >= 0:
            node[5], node[6] = made, made + 1
            made += 2
            down = x[rows, node[3]] <= node[4]
            todo += [(rows[down], depth + 1), (rows[~down], depth + 1)]
    return [tuple(node) for node in nodes]


def _finish(rows: DataFrame, nodes: dict[int, Node], small: list[int], features: list[str], stats: list[str], max_depth: int | None, min_split: int, min_leaf: int) -> None:
    """Grows the whole subtrees of small nodes, one task for each node."""
    names = [f"x{k}" for k in range(len(features))]
    inside = set(small)
    where = F.expr(leaf_expression(nodes, lambda x: str(x.id) if x.id in inside else "CAST(NULL AS INT)"))
    depths = {i: nodes[i].depth for i in small}

    def run(own: pd.DataFrame) -> pd.DataFrame:
        at = int(own["node"].iloc[0])
        found = subtree(own[names].to_numpy(np.float64), own[stats].to_numpy(np.float64), max_depth=None if max_depth is None else max_depth - depths[at], min_split=min_split, min_leaf=min_leaf)
        return pd.DataFrame([(at, k, *x) for k, x in enumerate(found)], columns=["node", "k", "n", "impurity", "value", "feature", "threshold", "left", "right", "depth"])

    picked = rows.select(where.alias("node"), *(F.col(quoted(f)).alias(x) for f, x in zip(features, names, strict=True)), *stats).where("node IS NOT NULL")
    found = picked.groupBy("node").applyInPandas(run, "node int, k int, n long, impurity double, value array<double>, feature int, threshold double, left int, right int, depth int").toPandas()
    for at, own in found.sort_values(["node", "k"]).groupby("node"):
        first, at = len(nodes), int(at)
        name = lambda k, first=first, at=at: at if k == 0 else first + k - 1
        for r in own.itertuples():
            leaf = r.feature < 0
            nodes[name(r.k)] = Node(
                name(r.k), int(r.n), float(r.impurity), [float(v) for v in r.value], None if leaf else features[r.feature], None if leaf else float(r.threshold),
                None if leaf else name(r.left), None if leaf else name(r.right), depths[at] + int(r.depth),
            )


def walk(nodes: dict[int, Node], features: list[str], value: Any) -> Any:
    """A function of a pandas frame of the features that gives each row's leaf's value(node)."""
    ids = sorted(nodes)
    number = {i: k for k, i in enumerate(ids)}
    own = [nodes[i] for i in ids]
    feature = np.array([-1 if x.feature is None else features.index(x.feature) for x in own])
    threshold = np.array([x.threshold or 0.0 for x in own])
    left, right = (np.array([0 if x.feature is None else number[c] for x, c in side]) for side in ([(x, x.left) for x in own], [(x, x.right) for x in own]))
    values = np.array([float(value(x)) if x.feature is None else 0.0 for x in own])

    def run(x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), number[0])
        active = np.flatnonzero(feature[at] >= 0)
        while len(active):
            k = at[active]
            at[active] = np.where(x[active, feature[k]] <= threshold[k], left[k], right[k])
            active = active[feature[at[active]] >= 0]
        return values[at]

    return run


def grow(rows: DataFrame, features: list[str], stats: list[str], *, max_depth: int | None, min_split: int, min_leaf: int, max_leaves: int | None) -> dict[int, Node]:
    """Grows a tree on rows with the given statistics columns."""
    totals = [F.count("*").alias("n"), *(F.sum(s).alias(f"s{i}") for i, s in enumerate(stats)), *(F.sum(F.col(s) * F.col(s)).alias(f"q{i}") for i, s in enumerate(stats))]

    def fill(node_id: int, r: Any, depth: int) -> Node:
        n = r["n"]
        means = [(r[f"s{i}"] or 0.0) / n for i in range(len(stats))] if n else [0.0] * len(stats)
        impurity = sum((r[f"q{i}"] or 0.0) / n - m * m for i, m in enumerate(means)) if n else 0.0
        return Node(node_id, n, max(0.0, impurity), means, depth=depth)

    nodes = {0: fill(0, rows.agg(*totals).first(), 0)}
    level, leaves, small = [0], 1, []
    while level and features:
        level = [i for i in level if nodes[i].n >= max(2, min_split) and nodes[i].impurity > 1e-12 and (max_depth is None or nodes[i].depth < max_depth)]
        if max_leaves is None:
            small += [i for i in level if nodes[i].n <= SMALL]
            level = [i for i in level if nodes[i].n > SMALL]
        if not level:
            break
        inside = ", ".join(str(i) for i in level)
        where = F.expr(f"CASE WHEN ({leaf_expression(nodes, lambda x: str(x.id))}) IN ({inside}) THEN ({leaf_expression(nodes, lambda x: str(x.id))}) END")
        found = [r for r in best_splits(rows, where, features, stats, min_leaf).collect() if r["gain"] > 1e-9]
        found.sort(key=lambda r: (-r["gain"], r["node"]))
        if max_leaves is not None:
            found = found[: max(0, max_leaves - leaves)]
        if not found:
            break
        after = {}
        for r in found:
            node = nodes[r["node"]]
            node.feature, node.threshold = r["feature"], r["threshold"]
            node.left, node.right = len(nodes) + len(after), len(nodes) + len(after) + 1
            after[node.left] = after[node.right] = node.depth + 1
        leaves += len(found)
        nodes |= {i: Node(i, 0, 0.0, [], depth=d) for i, d in after.items()}
        where = F.expr(leaf_expression(nodes, lambda x: str(x.id)))
        for r in rows.groupBy(where.alias("node")).agg(*totals).where(F.col("node").isin(list(after))).collect():
            nodes[r["node"]] = fill(r["node"], r, after[r["node"]])
        level = list(after)
    if small:
        _finish(rows, nodes, small, features, stats, max_depth, min_split, min_leaf)
    return nodes


def gains(nodes: dict[int, Node]) -> dict[str, float]:
    """Impurity decrease by feature."""
    out: dict[str, float] = {}
    for x in nodes.values():
        if x.feature is not None:
            a, b = nodes[x.left], nodes[x.right]
            out[x.feature] = out.get(x.feature, 0.0) + x.n * x.impurity - a.n * a.impurity - b.n * b.impurity
    return out


def shares(totals: dict[str, float], features: list[str]) -> dict[str, float]:
    """Importance in % by source column: indicators count for their column."""
    whole = sum(totals.values()) or 1.0
    out: dict[str, float] = {}
    for c in features:
        out[c.split("__")[0]] = out.get(c.split("__")[0], 0.0) + 100 * totals.get(c, 0.0) / whole
    return out


def node_table(spark, trees: list[tuple[int, dict[int, Node]]]) -> DataFrame:
    """The node tables of trees as a DataFrame."""
    rows = [(t, x.id, x.left, x.right, x.feature, x.threshold, x.n, x.impurity, x.value) for t, nodes in trees for x in nodes.values()]
    return spark.createDataFrame(rows, "tree int, node int, left int, right int, feature string, threshold double, n long, impurity double, value array<double>")


class _Tree(Estimator):
    def __init__(self, min_samples_split: int = 10, min_samples_leaf: int = 1, max_depth: int | None = None, max_leaf_nodes: int | None = None, random_state: int = 0):
        self.min_split, self.min_leaf, self.max_depth, self.max_leaves = min_samples_split, min_samples_leaf, max_depth, max_leaf_nodes
        self.random_state = random_state  # the learner has no randomness

    def _grow(self, rows: DataFrame, stats: list[str]) -> None:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.nodes = grow(rows, self.features, stats, max_depth=self.max_depth, min_split=self.min_split, min_leaf=self.min_leaf, max_leaves=self.max_leaves)
        finally:
            rows.unpersist()

    def importance(self) -> dict[str, float]:
        return shares(gains(self.nodes), self.features)

    @staticmethod
    def _value(node: Node) -> float:
        return node.value[0]

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        if len(self.nodes) <= WIDE:
            return super().predict(df, output)
        sent = df.sparkSession.sparkContext.broadcast((self.nodes, self.features))
        value, made = self._value, []

        @F.pandas_udf("double")
        def leaf(*columns: pd.Series) -> pd.Series:
            if not made:
                made.append(walk(*sent.value, value))
            return pd.Series(made[0](np.stack([c.to_numpy(np.float64) for c in columns], axis=1)))

        return df.withColumn(output, leaf(*(F.col(quoted(f)).cast("double") for f in self.features)))


class TreeRegressor(_Tree):
    def build(self, df: DataFrame, target: int | str) -> TreeRegressor:
        rows = self._start(df, target).withColumn("_y", F.col(quoted(target)))
        self._grow(rows, ["_y"])
        return self

    def to_pfa(self) -> dict:
        return document(self.features, tree_action(self.nodes, self._value))

    def get_info(self, df: DataFrame) -> dict[str, Any]:
        r = metrics.regression(self.predict(df), self.target, "prediction").first()
        return {"MSE": r["mse"], "R_squared": r["r2"], "variable_importance": self.importance()}


class TreeClassifier(_Tree):
    @staticmethod
    def _value(node: Node) -> float:
        return float(node.value.index(max(node.value)))

    def build(self, df: DataFrame, target: int | str) -> TreeClassifier:
        rows = self._start(df, target)
        self.labels = sorted(r[0] for r in rows.select(quoted(self.target)).distinct().collect())
        stats = [f"_y{k}" for k in range(len(self.labels))]
        for s, label in zip(stats, self.labels, strict=True):
            rows = rows.withColumn(s, (F.col(quoted(self.target)) == label).cast("double"))
        self._grow(rows, stats)
        return self

    def to_pfa(self) -> dict:
        return document(self.features, tree_action(self.nodes, self._value), "int") | {"labels": self.labels}

    def get_info(self, df: DataFrame) -> dict[str, Any]:
        labelled = self.predict(df).withColumn("_class", F.element_at(F.array(*(F.lit(float(x)) for x in self.labels)), F.col("prediction").cast("int") + 1))
        share = metrics.accuracy(labelled.withColumn("_y", F.col(quoted(self.target)).cast("double")), "_y", "_class").first()["accuracy"]
        return {"ROC": share, "accuracy": share, "variable_importance": self.importance()}
