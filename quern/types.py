"""Vocabulary and metadata records of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum
from typing import Any


class _Text(str, Enum):
    """Members compare equal to their plain strings, also after a JSON round trip."""

    def __str__(self) -> str:
        return self.value


class Format(_Text):
    numerical = "numerical"
    character = "character"


class Type(_Text):
    continuous = "continuous"
    categorical = "categorical"
    binary = "binary"


class DatasetFormat(_Text):
    json = "json"
    csv = "csv"


class CodeTarget(_Text):
    python = "python"
    c = "c"
    sql = "sql"


class Method(_Text):
    linear = "stepwise_linear_regression"
    logit = "logit"
    tree_regression = "CART_regression"
    tree_classification = "CART_classification"
    boosted_regression = "TN_regression"
    boosted_classification = "TN_classification"


@dataclass
class VirtualColumn:
    """A one-hot indicator: its column, and the value of the source column that it stands for."""

    label: str
    value: Any


@dataclass
class ColumnInfo:
    """What is known of a column: id (its physical name), original name, and profile."""

    id: int | str
    name: str
    data_format: Format | str | None = None
    data_type: Type | str | None = None
    statistics: dict[str, Any] = field(default_factory=dict)
    virtual_columns: list[VirtualColumn] = field(default_factory=list)

    @property
    def missing(self) -> int:
        return int(self.statistics.get("missing_values_count") or 0)

    @property
    def uniques(self) -> list[tuple[Any, int]]:
        """(value, count) pairs in the stored order; accepts a mapping or a list of pairs."""
        found = self.statistics.get("uniques_stats") or []
        return list(found.items()) if isinstance(found, dict) else [tuple(x) for x in found]


def quoted(name: int | str) -> str:
    """A column's name for Spark SQL."""
    return "`" + str(name).replace("`", "``") + "`"
