"""Model quality as aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.compile import to_sql
from quern.types import quoted


def regression(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """mse and r2 = 1 - SSR / SST, SST about the mean of this dataset; two passes for accuracy's sake."""
    y, p = F.col(quoted(label)).cast("double"), F.col(quoted(prediction)).cast("double")
    mean = F.broadcast(df.agg(F.avg(y).alias("_mean")))
    out = df.crossJoin(mean).agg(F.avg((y - p) ** 2).alias("mse"), F.sum((y - p) ** 2).alias("_r"), F.sum((y - F.col("_mean")) ** 2).alias("_t"))
    return out.select("mse", (1 - F.col("_r") / F.nullif("_t", F.lit(0.0))).alias("r2"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(quoted(label)) == F.col(quoted(prediction))).cast("double")).alias("accuracy"))


def _prefix(steps: Column) -> Column:
    """Running sums of an array of doubles."""
    empty = F.array().cast("array<double>")
    return F.aggregate(steps, empty, lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + x)))


def staged_regression(df: DataFrame, label: str, first: float | Column, steps: Sequence[Column]) -> DataFrame:
    """(stage, mse, r2) after each of the steps that add to a first prediction; one pass over the rows."""
    y = F.col(quoted(label)).cast("double")
    start = F.lit(first) if isinstance(first, (int, float)) else first
    rows = df.select(y.alias("y"), start.alias("f"), F.array(*steps).alias("s"))
    mean = F.broadcast(rows.agg(F.avg("y").alias("m")))
    each = rows.crossJoin(mean).select("y", "m", F.posexplode(F.transform(_prefix(F.col("s")), lambda x: x + F.col("f"))).alias("k", "p"))
    out = each.groupBy((F.col("k") + 1).alias("stage")).agg(F.avg((F.col("y") - F.col("p")) ** 2).alias("mse"), F.sum((F.col("y") - F.col("p")) ** 2).alias("_r"), F.sum((F.col("y") - F.col("m")) ** 2).alias("_t"))
    return out.select("stage", "mse", (1 - F.col("_r") / F.nullif("_t", F.lit(0.0))).alias("r2")).orderBy("stage")


def staged_accuracy(df: DataFrame, label: str, first: Sequence[float], steps: Sequence[Sequence[Column]], labels: Sequence[float]) -> DataFrame:
    """(stage, accuracy): steps holds for each class its columns by stage; the class of the greatest running sum is predicted."""
    y = F.col(quoted(label)).cast("double")
    def sums(start: float, class_steps: Sequence[Column]) -> Column:
        return F.transform(_prefix(F.array(*class_steps)), lambda x: x + F.lit(float(start)))

    rows = df.select(y.alias("y"), *(sums(f, s).alias(f"s{k}") for k, (f, s) in enumerate(zip(first, steps, strict=True))))
    each = rows.select("y", F.posexplode(F.arrays_zip(*(f"s{k}" for k in range(len(first))))).alias("k", "z"))
    scores = F.array(*(F.col("z")[f"s{k}"] for k in range(len(first))))
    index = F.array_position(scores, F.array_max(scores)).cast("int")
    chosen = F.element_at(F.array(*(F.lit(float(x)) for x in labels)), index)
    return each.groupBy((F.col("k") + 1).alias("stage")).agg(F.avg((chosen == F.col("y")).cast("double")).alias("accuracy")).orderBy("stage")


def importance(nodes: DataFrame) -> DataFrame:
    """(feature, importance): the share, in %, of the impurity decrease that a node table's splits bring.

    nodes: tree, node, left, right, feature, n, impurity.
    """
    child = nodes.select("tree", F.col("node").alias("_c"), (F.col("n") * F.col("impurity")).alias("_w"))
    left = child.select(F.col("tree").alias("_t1"), F.col("_c").alias("_l"), F.col("_w").alias("_wl"))
    right = child.select(F.col("tree").alias("_t2"), F.col("_c").alias("_r"), F.col("_w").alias("_wr"))
    inner = nodes.where("feature IS NOT NULL").join(left, (F.col("tree") == F.col("_t1")) & (F.col("left") == F.col("_l"))).join(right, (F.col("tree") == F.col("_t2")) & (F.col("right") == F.col("_r")))
    gain = inner.select("tree", "feature", ((F.col("n") * F.col("impurity") - F.col("_wl") - F.col("_wr"))).alias("g"))
    by_feature = gain.groupBy("feature").agg(F.sum("g").alias("g"))
    total = F.broadcast(gain.agg(F.sum("g").alias("_all")))
    return by_feature.crossJoin(total).select("feature", F.coalesce(100 * F.col("g") / F.nullif("_all", F.lit(0.0)), F.lit(0.0)).alias("importance"))


def top_features(shares: dict[str, float], k: int = 5) -> list[str]:
    return sorted(shares, key=lambda c: (-shares[c], c))[:k]


def grid(df: DataFrame, feature: str, points: int = 50, low: float = 0.05, high: float = 0.95) -> list[float]:
    """The distinct values of a feature if they are fewer than points, else points equal steps between two percentiles."""
    x = F.col(quoted(feature)).cast("double")
    found = sorted(r[0] for r in df.where(x.isNotNull()).select(x.alias("x")).distinct().limit(points).collect())
    if len(found) < points:
        return found
    a, b = df.agg(F.percentile(x, F.array(F.lit(low), F.lit(high))).alias("p")).first()[0]
    return [a + (b - a) * i / (points - 1) for i in range(points)]


def partial_dependence(df: DataFrame, model: dict, feature: str, values: Sequence[float]) -> DataFrame:
    """(value, prediction): the mean score with the feature set to each value in turn, in one pass.

    The values (a bounded grid) become an array of scores of each row, so rows aren't multiplied before
    the score; what is exploded is pre-aggregated in the same stage.
    """
    others = [c for c in df.columns if c != feature]
    scores = []
    for v in values:
        inner = to_sql(_fixed(model, feature, v), others + [feature])
        scores.append(F.expr(f"CAST({inner} AS DOUBLE)"))
    rows = df.select(F.posexplode(F.array(*scores)).alias("k", "p"))
    out = rows.groupBy("k").agg(F.avg("p").alias("prediction"))
    value = F.element_at(F.array(*(F.lit(float(v)) for v in values)), F.col("k") + 1)
    return out.select(value.alias("value"), "prediction").orderBy("value")


def _fixed(model: dict, feature: str, value: float) -> dict:
    names = {f"input.var{feature}", f"input.{feature}"}

    def change(node: Any) -> Any:
        if isinstance(node, str):
            return {"double": value} if node in names else node
        if isinstance(node, list):
            return [change(x) for x in node]
        return {k: change(v) for k, v in node.items()} if isinstance(node, dict) else node

    return {**model, "action": change(model["action"])}
