"""Compiles PFA expressions to text: Spark SQL, DuckDB SQL, Python or C.

A compiler walks the tree once. Scalars become text; vectors and matrices are lists of texts, since all
shapes are known, so array operators unroll and whole-stage code generation sees plain arithmetic.
"""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import pfa


class Dialect:
    """How a target writes scalars; the methods of Spark SQL, which DuckDB shares for the most part."""

    null = "CAST(NULL AS DOUBLE)"

    def number(self, x: float) -> str:
        if math.isnan(x):
            return self.null
        if math.isinf(x):
            return f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)"
        return f"CAST({x!r} AS DOUBLE)"

    def text(self, x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def field(self, name: str) -> str:
        return f"CAST(`{name.replace('`', '``')}` AS DOUBLE)"

    def arithmetic(self, op: str, a: str, b: str) -> str:
        return f"({a} {op} {b})"

    def divide(self, a: str, b: str, b_constant: float | None) -> str:
        if b_constant:
            return f"({a} / {b})"
        return (
            f"CASE WHEN {b} <> 0 THEN {a} / {b} WHEN {a} IS NULL OR {b} IS NULL THEN {self.null} WHEN {a} = 0 OR isnan({a}) THEN CAST('NaN' AS DOUBLE) "
            f"WHEN {a} > 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST('-Infinity' AS DOUBLE) END"
        )

    def compare(self, op: str, a: str, b: str, a_constant: bool, b_constant: bool) -> str:
        """NaN is the largest value in SQL; guards are added where that shows."""
        out = f"{a} {'=' if op == '==' else '<>' if op == '!=' else op} {b}"
        guard = {">": [(a, a_constant)], ">=": [(a, a_constant)], "<": [(b, b_constant)], "<=": [(b, b_constant)], "==": [(a, a_constant or b_constant)], "!=": []}[op]
        return "(" + " AND ".join([out, *(f"NOT isnan({x})" for x, constant in guard if not constant)]) + ")"

    def choose(self, test: str, then: str, other: str) -> str:
        return f"CASE WHEN {test} THEN {then} ELSE {other} END"

    def present(self, x: str) -> str:
        return f"({x} IS NOT NULL AND NOT isnan({x}))"

    def all_of(self, tests: list[str]) -> str:
        return "(" + " AND ".join(tests) + ")"

    def truth(self, x: str) -> str:
        return f"({x} = 1)"

    def as_number(self, test: str) -> str:
        return f"CASE WHEN {test} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"

    def exp(self, x: str) -> str:
        return f"exp({x})"

    def sum(self, xs: list[str]) -> str:
        """Balanced, so that the sum of many trees stays flat for the parser."""
        if len(xs) == 1:
            return xs[0]
        return f"({self.sum(xs[: len(xs) // 2])} + {self.sum(xs[len(xs) // 2 :])})"

    def argmax(self, xs: list[str]) -> str:
        return f"element_at(transform(array(array({', '.join(xs)})), a -> CASE WHEN exists(a, v -> v IS NULL OR isnan(v)) THEN NULL ELSE CAST(array_position(a, array_max(a)) - 1 AS DOUBLE) END), 1)"


class SparkSql(Dialect):
    pass


class DuckSql(Dialect):
    def field(self, name: str) -> str:
        return 'CAST("' + name.replace('"', '""') + '" AS DOUBLE)'

    def argmax(self, xs: list[str]) -> str:
        return f"list_transform([[{', '.join(xs)}]], lambda a: CASE WHEN len(list_filter(a, lambda v: v IS NULL OR isnan(v))) > 0 THEN NULL ELSE CAST(list_position(a, list_max(a)) - 1 AS DOUBLE) END)[1]"


class PythonCode(Dialect):
    """Expressions over the record r and the helpers of the scorer's head; missing is NaN."""

    null = "math.nan"

    def number(self, x: float) -> str:
        return "math.nan" if math.isnan(x) else ("-" if x < 0 else "") + "math.inf" if math.isinf(x) else repr(x)

    def text(self, x: str) -> str:
        return repr(x)

    def field(self, name: str) -> str:
        return f"r[{name!r}]"

    def divide(self, a: str, b: str, b_constant: float | None) -> str:
        return f"({a} / {b})" if b_constant else f"divide({a}, {b})"

    def compare(self, op: str, a: str, b: str, a_constant: bool, b_constant: bool) -> str:
        return f"({a} {op} {b})"

    def choose(self, test: str, then: str, other: str) -> str:
        return f"({then} if {test} else {other})"

    def present(self, x: str) -> str:
        return f"(not math.isnan({x}))"

    def all_of(self, tests: list[str]) -> str:
        return "(" + " and ".join(tests) + ")"

    def truth(self, x: str) -> str:
        return f"({x} == 1)"

    def as_number(self, test: str) -> str:
        return f"float({test})"

    def exp(self, x: str) -> str:
        return f"exp({x})"

    def argmax(self, xs: list[str]) -> str:
        return f"argmax([{', '.join(xs)}])"


class CCode(PythonCode):
    """Expressions over the struct pointer r in double precision."""

    null = "NAN"

    def number(self, x: float) -> str:
        return "NAN" if math.isnan(x) else ("-" if x < 0 else "") + "INFINITY" if math.isinf(x) else repr(x)

    def text(self, x: str) -> str:
        return '"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"'

    def field(self, name: str) -> str:
        return f"r->{c_name(name)}"

    def divide(self, a: str, b: str, b_constant: float | None) -> str:
        return f"({a} / {b})"

    def choose(self, test: str, then: str, other: str) -> str:
        return f"({test} ? {then} : {other})"

    def present(self, x: str) -> str:
        return f"(!isnan({x}))"

    def all_of(self, tests: list[str]) -> str:
        return "(" + " && ".join(tests) + ")"

    def as_number(self, test: str) -> str:
        return f"({test} ? 1.0 : 0.0)"

    def argmax(self, xs: list[str]) -> str:
        return f"argmax({len(xs)}, (double[]){{{', '.join(xs)}}})"


def c_name(name: str) -> str:
    clean = "".join(c if c.isalnum() and c.isascii() else "_" for c in name)
    return clean if clean[:1].isalpha() else f"f_{clean}"


class Compiler:
    """names: for each field of the document what the target calls it."""

    def __init__(self, dialect: Dialect, names: dict[str, str]):
        self.d, self.names = dialect, names

    def scalar(self, node: Any, env: dict[str, Any]) -> str:
        out = self.value(node, env)
        while isinstance(out, list) and len(out) == 1:
            out = out[0]
        if isinstance(out, list):
            raise pfa.PFAError("a number was expected, not an array")
        return out

    def test(self, node: Any, env: dict[str, Any]) -> str:
        if isinstance(node, pfa.Binary) and node.op in pfa.COMPARISONS:
            return self.comparison(node, env)
        return self.d.truth(self.scalar(node, env))

    def comparison(self, node: pfa.Binary, env: dict[str, Any]) -> str:
        constant = [isinstance(x, (pfa.Num, pfa.Text)) and not pfa.missing(x.value) for x in (node.left, node.right)]
        return self.d.compare(node.op, self.scalar(node.left, env), self.scalar(node.right, env), *constant)

    def vector(self, node: Any, env: dict[str, Any]) -> list:
        out = self.value(node, env)
        if not isinstance(out, list):
            raise pfa.PFAError("an array was expected, not a number")
        return out

    def product(self, xs: list, ys: list) -> str:
        if len(xs) != len(ys):
            raise pfa.PFAError(f"arrays of {len(xs)} and {len(ys)} don't fit")
        return self.d.sum([self.d.arithmetic("*", x, y) for x, y in zip(xs, ys, strict=True)])

    def value(self, node: Any, env: dict[str, Any]) -> Any:
        d = self.d
        match node:
            case pfa.Num(v):
                return d.number(v)
            case pfa.Text(v):
                return d.text(v)
            case pfa.Ref(name):
                return env[name] if name in env else d.field(self.names[pfa.resolve(name, self.names)])
            case pfa.Binary(op, a, b):
                if op in pfa.COMPARISONS:
                    return d.as_number(self.comparison(node, env))
                x, y = self.scalar(a, env), self.scalar(b, env)
                return d.divide(x, y, b.value if isinstance(b, pfa.Num) and not pfa.missing(b.value) else None) if op == "/" else d.arithmetic(op, x, y)
            case pfa.If(test, then, other):
                return self.branch(self.test(test, env), self.value(then, env), self.value(other, env))
            case pfa.IfNotNull(bound, then, other):
                values = {k: self.scalar(v, env) for k, v in bound}
                return self.branch(d.all_of([d.present(v) for v in values.values()]), self.value(then, env | values), self.value(other, env))
            case pfa.New(items):
                return [self.value(x, env) for x in items]
            case pfa.Call("m.exp", (x,)):
                v = self.value(x, env)
                return d.exp(v[0] if isinstance(v, list) else v)
            case pfa.Call("m.kernel.linear", (a, b)):
                return self.product(self.vector(a, env), self.vector(b, env))
            case pfa.Call("m.link.logit", (x,)):
                return pfa._map(lambda v: d.divide(d.number(1.0), d.arithmetic("+", d.number(1.0), d.exp(d.arithmetic("-", d.number(0.0), v))), 1.0), self.value(x, env))
            case pfa.Call("a.sum", (x,)):
                return d.sum(self.vector(x, env))
            case pfa.Call("a.argmax", (x,)):
                return d.argmax([v[0] if isinstance(v, list) else v for v in self.vector(x, env)])
            case pfa.Call("a.zipmap", (*arrays, pfa.Function(params, body))):
                return [self.value(body, env | dict(zip(params, vs, strict=True))) for vs in zip(*(self.vector(a, env) for a in arrays), strict=True)]
            case pfa.Call("la.add", (a, b)):
                x, y = self.vector(a, env), self.vector(b, env)
                if isinstance(x[0], list) != isinstance(y[0], list):
                    x, y = pfa._matrix(x), pfa._matrix(y)
                if isinstance(x[0], list) and (len(x), len(x[0])) != (len(y), len(y[0])):
                    y = [list(r) for r in zip(*y, strict=True)]
                if len(x) != len(y):
                    raise pfa.PFAError("arrays of different length can't be added")
                return pfa._map(lambda p, q: d.arithmetic("+", p, q), x, y)
            case pfa.Call("la.dot", (a, b)):
                x, y = self.vector(a, env), self.vector(b, env)
                columns = [list(c) for c in zip(*pfa._matrix(y), strict=True)]
                out = [[self.product(r, c) for c in columns] for r in (x if isinstance(x[0], list) else [x])]
                return out if isinstance(y[0], list) else [r[0] for r in out]
            case pfa.Call("la.transpose", (x,)):
                return [list(r) for r in zip(*self.vector(x, env), strict=True)]
        raise pfa.PFAError(f"cannot be translated: {node!r}")

    def branch(self, test: str, then: Any, other: Any) -> Any:
        if isinstance(then, list) and isinstance(other, list):
            return [self.branch(test, a, b) for a, b in zip(then, other, strict=True)]
        return self.d.choose(test, then, other)


def column_names(document: pfa.Document, columns: list[str]) -> dict[str, str]:
    """For each field of a document the column of a table, with or without the var prefix."""
    return {f: pfa.resolve(f, columns) for f in document.names}


def _compile(doc: dict, columns: list[str] | None, dialect: Dialect) -> Any:
    document = doc if isinstance(doc, pfa.Document) else pfa.parse_document(doc)
    names = {f: f for f in document.names} if columns is None else column_names(document, columns)
    return Compiler(dialect, names).value(document.action, {})


def to_sql(doc: dict, columns: list[str] | None = None, dialect: str = "spark") -> str:
    """The action as an SQL expression; arrays become SQL arrays."""
    d = DuckSql() if dialect == "duckdb" else SparkSql()

    def render(x: Any) -> str:
        if not isinstance(x, list):
            return x
        inner = ", ".join(map(render, x))
        return f"[{inner}]" if dialect == "duckdb" else f"array({inner})"

    return render(_compile(doc, columns, d))


def to_column(doc: dict, columns: list[str]) -> Column:
    """The action as a Spark column over the named columns."""
    return F.expr(to_sql(doc, columns))
