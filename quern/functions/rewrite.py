"""Rewrites of PFA documents: from prepared features back to the raw columns.

A model is trained on one-hot indicators and filled values; these rewrites express it over the source
columns, missing values included. Documents are never changed in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from quern.types import VirtualColumn

FILL = 9e30  # the sentinel that stands for a missing value


def replace_references(node: Any, change: Callable[[str], Any]) -> Any:
    """A copy with every string value that begins with ``input.`` replaced; keys stay."""
    if isinstance(node, str):
        return change(node) if node.startswith("input.") else node
    if isinstance(node, list):
        return [replace_references(x, change) for x in node]
    if isinstance(node, dict):
        return {k: replace_references(v, change) for k, v in node.items()}
    return node


def _rewritten(doc: dict, change_field: Callable[[dict], dict], change: Callable[[str], Any]) -> dict:
    fields: dict[str, dict] = {}
    for f in doc["input"]["fields"]:
        new = change_field(dict(f))
        fields.setdefault(new["name"], new)
    return {**doc, "input": {**doc["input"], "fields": list(fields.values())}, "action": replace_references(doc["action"], change)}


def decode_one_hot(doc: dict, virtual: Mapping[int | str, list[VirtualColumn]]) -> dict:
    """Indicators become ``if source == value then 1 else 0``; their fields become the source's."""
    source = {f"var{v.label}": (f"var{column}", v.value) for column, labels in virtual.items() for v in labels}

    def change(text: str) -> Any:
        name = text.removeprefix("input.")
        if name not in source:
            return text
        column, value = source[name]
        return {"if": {"==": [f"input.{column}", value]}, "then": {"double": 1.0}, "else": {"double": 0.0}}

    return _rewritten(doc, lambda f: {**f, "name": source.get(f["name"], (f["name"],))[0]}, change)


def decode_missing(doc: dict, fills: Mapping[int | str, float]) -> dict:
    """Fields of filled columns become nullable; each reference takes the fill when it is missing."""
    filled = {f"var{column}": value for column, value in fills.items()}

    def change(text: str) -> Any:
        value = filled.get(text.removeprefix("input."))
        return text if value is None else {"ifnotnull": {text: text}, "then": text, "else": value}

    return _rewritten(doc, lambda f: {**f, "type": ["double", "null"]} if f["name"] in filled else f, change)


def decode(doc: dict, virtual: Mapping[int | str, list[VirtualColumn]], fills: Mapping[int | str, float]) -> dict:
    """Both rewrites in the order that composes: indicators first, then missing values."""
    return decode_missing(decode_one_hot(doc, virtual), fills)
