"""What all methods share: build, to_pfa, get_info, and the parts of PFA documents."""

from __future__ import annotations

from abc import ABC, abstractmethod
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.compile import to_sql
from quern.types import quoted


class Estimator(ABC):
    """Trained by DataFrame operations; afterwards a PFA document."""

    target: str
    features: list[str]

    @abstractmethod
    def build(self, df: DataFrame, target: int | str) -> Estimator:
        """Fits the target on all other columns."""

    @abstractmethod
    def to_pfa(self) -> dict:
        """The model as a document over var<column> fields."""

    @abstractmethod
    def get_info(self, df: DataFrame) -> dict[str, Any]:
        """Quality of the model on a dataset."""

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, F.expr(f"CAST({to_sql(self.to_pfa(), df.columns)} AS DOUBLE)"))

    def _start(self, df: DataFrame, target: int | str) -> DataFrame:
        """Features and target as doubles; rows without target can't be learned from."""
        self.target = str(target)
        self.features = [c for c in df.columns if c != self.target]
        columns = [F.col(quoted(c)).cast("double").alias(c) for c in df.columns]
        return df.select(*columns).where(F.col(quoted(self.target)).isNotNull())


def record(features: list[str]) -> dict:
    return {"type": "record", "name": "Input", "fields": [{"name": f"var{c}", "type": "double"} for c in features]}


def document(features: list[str], action: Any, output: Any = "double") -> dict:
    return {"input": record(features), "output": {"name": "prediction", "type": output}, "action": action}


VECTOR = {"type": "array", "items": "double"}
MATRIX = {"type": "array", "items": VECTOR}


def new(items: list, kind: dict = VECTOR) -> dict:
    return {"type": kind, "new": items}


def ref(column: str) -> str:
    return f"input.var{column}"
