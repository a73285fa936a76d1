"""PFA documents: validation, syntax tree, and a plain-Python interpreter.

Expressions over doubles, vectors and matrices of doubles. Arrays occur only as ``new`` forms, so every
shape is known from the document, and array operators can be resolved to scalar expressions when a
document is compiled (see ``compile``). The interpreter defines the semantics: all numbers are doubles,
a missing value (None or NaN) makes arithmetic missing, comparisons with it are false, and division
follows IEEE 754.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

# Names of the expression language.
BINARY = ("+", "-", "*", "/", "<", ">", "<=", ">=", "==", "!=")
COMPARISONS = ("<", ">", "<=", ">=", "==", "!=")
PRIMITIVES = ("boolean", "integer", "int", "long", "float", "double", "string", "null", "base64")
CALLS = ("m.exp", "m.kernel.linear", "m.link.logit", "a.sum", "a.argmax", "a.zipmap", "la.add", "la.dot", "la.transpose")


class PFAError(ValueError):
    """A document that isn't valid, or uses what isn't supported."""


@dataclass(frozen=True)
class Num:
    value: float


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Ref:
    """A field of the input record, or a name bound by ifnotnull or a function's parameter."""

    name: str


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: Any
    other: Any


@dataclass(frozen=True)
class IfNotNull:
    bound: tuple[tuple[str, Any], ...]
    then: Any
    other: Any


@dataclass(frozen=True)
class New:
    items: tuple


@dataclass(frozen=True)
class Call:
    name: str
    args: tuple


@dataclass(frozen=True)
class Function:
    params: tuple[str, ...]
    body: Any


@dataclass
class Document:
    fields: list[tuple[str, bool]]  # name, nullable
    output: str | None
    action: Any

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]


def _is_nullable(kind: Any) -> bool:
    return isinstance(kind, list) and sorted(map(str, kind)) == ["double", "null"]


def parse_document(doc: dict, *, doubles_only: bool = False) -> Document:
    """Checks a document and parses its action."""
    if not isinstance(doc, dict) or any(k not in doc for k in ("input", "output", "action")):
        raise PFAError("a document needs input, output and action")
    record = doc["input"]
    if not isinstance(record, dict) or record.get("type") != "record":
        raise PFAError("only record input is supported")
    fields = []
    for f in record.get("fields", []):
        if doubles_only and f["type"] != "double" and not _is_nullable(f["type"]):
            raise PFAError(f"field {f['name']} must be double or nullable double, not {f['type']}")
        fields.append((str(f["name"]), _is_nullable(f["type"])))
    out = doc["output"]
    name = out.get("name") if isinstance(out, dict) else None
    action = doc["action"]
    if isinstance(action, list):
        if len(action) != 1:
            raise PFAError("an action is one expression")
        action = action[0]
    return Document(fields, None if name is None else str(name), parse(action))


def parse(node: Any) -> Any:
    """JSON expression -> syntax tree."""
    if isinstance(node, bool):
        return Num(float(node))
    if isinstance(node, (int, float)):
        return Num(float(node))
    if node is None:
        return Num(math.nan)
    if isinstance(node, str):
        return Ref(node.removeprefix("input."))
    if isinstance(node, list):
        if len(node) == 1 and isinstance(node[0], str):
            return Text(node[0])
        raise PFAError(f"not an expression: {node!r}")
    if not isinstance(node, dict):
        raise PFAError(f"not an expression: {node!r}")
    if "if" in node:
        return If(parse(node["if"]), parse(node["then"]), parse(node["else"]))
    if "ifnotnull" in node:
        bound = tuple((k.removeprefix("input."), parse(v)) for k, v in node["ifnotnull"].items())
        return IfNotNull(bound, parse(node["then"]), parse(node["else"]))
    if "new" in node:
        return New(tuple(parse(x) for x in node["new"]))
    if "params" in node and "do" in node:
        names = tuple(next(iter(p)) for p in node["params"])
        return Function(names, parse(node["do"][0] if isinstance(node["do"], list) else node["do"]))
    if "value" in node and "type" in node:
        return _typed(node["type"], node["value"])
    if len(node) != 1:
        raise PFAError(f"unknown form with keys {sorted(node)}")
    key, arg = next(iter(node.items()))
    if key in PRIMITIVES:
        return _typed(key, arg)
    if key in BINARY:
        if not isinstance(arg, list) or len(arg) != 2:
            raise PFAError(f"{key} takes two operands")
        return Binary(key, parse(arg[0]), parse(arg[1]))
    if key in CALLS:
        return Call(key, tuple(parse(x) for x in arg) if isinstance(arg, list) else (parse(arg),))
    raise PFAError(f"{key} cannot be translated")


def _typed(kind: Any, value: Any) -> Any:
    if isinstance(value, (dict, list)) or kind not in PRIMITIVES:
        return parse(value)
    if kind == "string":
        return Text(str(value))
    if kind == "null" or value is None:
        return Num(math.nan)
    if isinstance(value, str):
        if value.startswith("input."):
            return parse(value)
        if kind == "boolean":
            return Num(float(value.strip().lower() == "true"))
        try:
            number = float(value)
        except ValueError:
            return Num(math.nan)
        return Num(float(math.trunc(number)) if kind in ("integer", "int", "long") else number)
    return Num(float(value))


def resolve(name: str, names: list[str] | dict) -> str:
    """A field by its name, with or without the var prefix."""
    for candidate in (name, f"var{name}", name.removeprefix("var")):
        if candidate in names:
            return candidate
    raise PFAError(f"unknown name {name}")


def missing(x: Any) -> bool:
    return x is None or (isinstance(x, float) and math.isnan(x))


def divide(a: float, b: float) -> float:
    if b != 0:
        return a / b
    return math.nan if a == 0 or math.isnan(a) else math.copysign(math.inf, a) * math.copysign(1, b)


def _binary(op: str, a: Any, b: Any) -> Any:
    if op in COMPARISONS:
        if missing(a) or missing(b):
            return op == "!=" and not (a is None or b is None)
        return {"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b, "==": a == b, "!=": a != b}[op]
    if a is None or b is None:
        return None
    return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: divide(a, b)}[op]()


def _map(f, *xs: Any) -> Any:
    return [_map(f, *parts) for parts in zip(*xs, strict=True)] if isinstance(xs[0], list) else f(*xs)


def _matrix(x: list) -> list[list]:
    return x if x and isinstance(x[0], list) else [[v] for v in x]


def _exp(x: float | None) -> float | None:
    return None if x is None else math.inf if x > 709.78 else math.exp(x)


def _sigmoid(x: float | None) -> float | None:
    return None if x is None else divide(1.0, 1.0 + _exp(-x))


def _total(xs: list) -> float | None:
    return None if any(x is None for x in xs) else math.fsum(xs) if all(map(math.isfinite, xs)) else sum(xs)


def evaluate(node: Any, row: dict[str, Any]) -> Any:
    """The value of an expression for a row; arrays are lists."""
    ev = lambda n: evaluate(n, row)
    match node:
        case Num(v) | Text(v):
            return v
        case Ref(name):
            v = row[resolve(name, row)]
            return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
        case Binary(op, a, b):
            return _binary(op, ev(a), ev(b))
        case If(test, then, other):
            return ev(then) if ev(test) is True or ev(test) == 1.0 else ev(other)
        case IfNotNull(bound, then, other):
            values = {k: ev(v) for k, v in bound}
            return ev(other) if any(missing(v) for v in values.values()) else evaluate(then, row | values)
        case New(items):
            return [ev(x) for x in items]
        case Call("m.exp", (x,)):
            v = ev(x)
            return _exp(v[0] if isinstance(v, list) else v)
        case Call("m.kernel.linear", (a, b)):
            return _total([_binary("*", x, y) for x, y in zip(ev(a), ev(b), strict=True)])
        case Call("m.link.logit", (x,)):
            return _map(_sigmoid, ev(x))
        case Call("a.sum", (x,)):
            return _total(ev(x))
        case Call("a.argmax", (x,)):
            v = [y[0] if isinstance(y, list) else y for y in ev(x)]
            return None if any(missing(y) for y in v) else float(v.index(max(v)))
        case Call("a.zipmap", (*arrays, Function(params, body))):
            return [evaluate(body, row | dict(zip(params, vs, strict=True))) for vs in zip(*map(ev, arrays), strict=True)]
        case Call("la.add", (a, b)):
            x, y = ev(a), ev(b)
            if isinstance(x[0], list) != isinstance(y[0], list):
                x, y = _matrix(x), _matrix(y)
            if isinstance(x[0], list) and (len(x), len(x[0])) != (len(y), len(y[0])):
                y = [list(r) for r in zip(*y, strict=True)]
            return _map(lambda p, q: _binary("+", p, q), x, y)
        case Call("la.dot", (a, b)):
            x, y = ev(a), ev(b)
            columns = list(zip(*_matrix(y), strict=True))
            rows = x if isinstance(x[0], list) else [x]
            out = [[_total([_binary("*", p, q) for p, q in zip(r, c, strict=True)]) for c in columns] for r in rows]
            return out if y and isinstance(y[0], list) else [r[0] for r in out]
        case Call("la.transpose", (x,)):
            return [list(r) for r in zip(*ev(x), strict=True)]
    raise PFAError(f"cannot be evaluated: {node!r}")
