"""The expression compiler: interpreter = Spark = generated Python = generated C, on every form."""

import math
import shutil
import subprocess
import sys

import duckdb
import pytest

from quern.functions import pfa
from quern.functions.codegen import export, to_c, to_python
from quern.functions.compile import to_column, to_sql
from quern.functions.rewrite import FILL, decode_missing, decode_one_hot
from quern.operators.transform import apply
from quern.types import VirtualColumn

VECTOR = {"type": "array", "items": "double"}


def new(*xs):
    return {"type": VECTOR, "new": list(xs)}


def doc(action, fields=("a", "b", "c"), name="out"):
    return {"input": {"type": "record", "fields": [{"name": f, "type": "double"} for f in fields]}, "output": {"name": name, "type": "double"}, "action": action}


A, B, C = "input.a", "input.b", "input.c"
FORMS = {
    "arith": {"-": [{"*": [A, B]}, {"+": [C, 2]}]},
    "divide": {"/": [A, B]},
    "divide_ints": {"/": [1, 2]},
    "compare": {"+": [{"<": [A, B]}, {"*": [2, {">=": [A, C]}]}]},
    "not_equal": {"!=": [A, B]},
    "if": {"if": {"<=": [A, 1]}, "then": B, "else": {"if": {">": [{"/": [A, B]}, 0.5]}, "then": C, "else": -7}},
    "ifnotnull": {"ifnotnull": {"x": A, "y": B}, "then": {"+": ["x", "y"]}, "else": 9},
    "typed": {"+": [{"double": 1.5}, {"type": "int", "value": "3.9"}]},
    "typed_expression": {"double": {"ifnotnull": {A: A}, "then": A, "else": 4}},
    "sum": {"a.sum": new(A, B, C, 4)},
    "argmax": {"a.argmax": new(A, B, C)},
    "argmax_negative": {"a.argmax": new(-3, -1, -2)},
    "linear": {"m.kernel.linear": [new(1, 2, 3), new(A, B, C)]},
    "logit": {"a.sum": {"m.link.logit": new(A, B)}},
    "exp": {"m.exp": [A]},
    "la_add": {"a.argmax": {"la.add": [new(new(A), new(B)), new(new(C, 1))]}},
    "la_dot": {"a.argmax": {"m.link.logit": {"la.add": [{"la.dot": [new(new(1, 2), new(3, -4)), new(new(A), new(B))]}, new(new(0.5), new(C))]}}},
    "transpose": {"a.sum": {"la.dot": [{"la.transpose": new(new(A, 1), new(B, 2))}, new(3, 5)]}},
    "zipmap": {"a.sum": {"a.zipmap": [new(A, B), new(C, 3), {"params": [{"x": "double"}, {"y": "double"}], "ret": "double", "do": {"*": ["x", "y"]}}]}},
}
ROWS = [(1.0, 2.0, 3.0), (0.0, 0.0, 1.0), (-1.5, 0.0, 2.0), (4.0, -2.0, 0.5), (2.0, 2.0, 2.0), (None, 1.0, 1.0), (3.0, None, None)]


def same(x, y):
    x, y = (math.nan if v is None else float(v) for v in (x, y))
    return (math.isnan(x) and math.isnan(y)) or x == y or math.isclose(x, y, rel_tol=1e-9)


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "i int, a double, b double, c double")
    out = df.select("i", *(to_column(doc(f), df.columns).alias(k) for k, f in FORMS.items())).orderBy("i").collect()
    return {k: [r[k] for r in out] for k in FORMS}


@pytest.mark.parametrize("form", FORMS)
def test_interpreter_equals_spark(scored, form):
    tree = pfa.parse(FORMS[form])
    for row, got in zip(ROWS, scored[form], strict=True):
        assert same(pfa.evaluate(tree, dict(zip("abc", row, strict=True))), got), row


@pytest.mark.parametrize("form", FORMS)
def test_duckdb_equals_interpreter(form):
    tree, con = pfa.parse(FORMS[form]), duckdb.connect()
    con.execute("CREATE TABLE t (i INT, a DOUBLE, b DOUBLE, c DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", [(i, *r) for i, r in enumerate(ROWS)])
    got = con.execute(f"SELECT {to_sql(doc(FORMS[form]), None, 'duckdb')} FROM t ORDER BY i").fetchall()
    for row, (value,) in zip(ROWS, got, strict=True):
        assert same(pfa.evaluate(tree, dict(zip("abc", row, strict=True))), value), row


@pytest.mark.parametrize("target", ["python", "c"])
def test_generated_programs(tmp_path, target):
    if target == "c":
        (tmp_path / "probe.c").write_text("int main(void) { return 0; }\n")
        if not shutil.which("gcc") or subprocess.run(["gcc", "probe.c", "-o", "probe"], cwd=tmp_path, capture_output=True).returncode:
            pytest.skip("no working C compiler")
    data = tmp_path / "in.csv"
    data.write_text("a,b,c\n" + "".join(",".join("" if v is None else repr(v) for v in r) + "\n" for r in ROWS))
    for name, form in FORMS.items():
        source = tmp_path / f"{name}.{'py' if target == 'python' else 'c'}"
        source.write_text(export(doc(form), target))
        command = [sys.executable, str(source), str(data)]
        if target == "c":
            subprocess.run(["gcc", "-std=c99", "-O1", str(source), "-o", str(tmp_path / name), "-lm"], check=True)
            command = [str(tmp_path / name), str(data)]
        got = subprocess.run(command, check=True, capture_output=True, text=True).stdout.split()
        tree = pfa.parse(form)
        for row, value in zip(ROWS, got, strict=True):
            expected = pfa.evaluate(tree, dict(zip("abc", (math.nan if v is None else v for v in row), strict=True)))
            assert same(expected, value.replace("True", "1").replace("False", "0")), (name, row)


@pytest.mark.parametrize(
    "broken",
    [{"input": {}, "action": 1}, doc({"frobnicate": 1}), doc({"+": [1, 2, 3]}), doc({"+": [1, new(1, 2)]}), doc({"+": ["input.zz", 1]}), {**doc(1), "input": {"type": "array"}}],
)
def test_invalid_documents(broken):
    with pytest.raises(pfa.PFAError):
        to_sql(broken)


def test_var_prefix_both_ways(spark):
    df = spark.createDataFrame([(2.0,)], "`7` double")
    assert df.select(to_column(doc({"*": [2, "input.var7"]}, ["var7"]), df.columns)).first()[0] == 4.0


def test_transformations_chain_and_skip(spark):
    years = [1900.0, 1910.0, 1920.0, 1930.0, 2000.0, 2020.0]
    df = spark.createDataFrame([(y,) for y in years], "BIRTH_YEAR float")
    docs = [doc({"-": [2016, "input.varBIRTH_YEAR"]}, ["varBIRTH_YEAR"], "AGE"), None, doc({"-": [18, "input.varAGE"]}, ["varAGE"], "DIFFERENT")]
    out = apply(df, docs)
    assert [tuple(r)[1:] for r in out.collect()] == [(116.0, -98.0), (106.0, -88.0), (96.0, -78.0), (86.0, -68.0), (16.0, 2.0), (-4.0, 22.0)]
    assert dict(out.dtypes)["AGE"] == "float"


def test_transformation_type_checks(spark):
    df = spark.createDataFrame([("x", 1)], "s string, n int")
    with pytest.raises(ValueError):
        apply(df, [doc({"+": ["input.s", 1]}, ["s"])])
    wrong = doc({"+": ["input.n", 1]}, ["n"])
    wrong["input"]["fields"][0]["type"] = "integer"
    with pytest.raises(ValueError):
        apply(df, [wrong])


def test_negative_output_name(spark):
    df = spark.createDataFrame([(18.0, 2.31), (0.0, 7.07)], "ZN double, INDUS double")
    action = {"if": {">": ["input.INDUS", 0]}, "then": {"/": ["input.ZN", "input.INDUS"]}, "else": 0.0}
    assert [round(r["-1"], 4) for r in apply(df, [doc(action, ["ZN", "INDUS"], -1)]).collect()] == [7.7922, 0.0]


def test_one_hot_decoder():
    action = {"if": {"<=": ["input.var1__2", 0.5]}, "then": {"double": 1.0}, "else": {"double": "input.var2__0"}}
    before = doc(action, ["var0", "var1__0", "var1__2", "var2__0", "var3"])
    after = decode_one_hot(before, {1: [VirtualColumn("1__0", 1.0), VirtualColumn("1__2", 100.0)], 2: [VirtualColumn("2__0", 0.0)]})
    assert [f["name"] for f in after["input"]["fields"]] == ["var0", "var1", "var2", "var3"]
    assert after["action"]["if"]["<="][0] == {"if": {"==": ["input.var1", 100.0]}, "then": {"double": 1.0}, "else": {"double": 0.0}}
    assert before["action"] is action and action["if"]["<="][0] == "input.var1__2"


def test_missing_decoder(spark):
    action = {"if": {"<=": ["input.var2", 1.5]}, "then": {"double": "input.var3"}, "else": {"double": 2.0}}
    after = decode_missing(doc(action, ["var2", "var3"]), {"3": FILL})
    assert after["input"]["fields"][1]["type"] == ["double", "null"]
    assert after["action"]["then"] == {"double": {"ifnotnull": {"input.var3": "input.var3"}, "then": "input.var3", "else": FILL}}
    df = spark.createDataFrame([(1.0, None), (1.0, 5.0), (2.0, None)], "`2` double, `3` double")
    assert [r[0] for r in df.select(to_column(after, df.columns)).collect()] == [FILL, 5.0, 2.0]


def test_large_ensemble_stays_flat(spark):
    tree = lambda k: {"if": {"<=": [A, k]}, "then": {"double": 1.0}, "else": {"double": 0.5}}
    d = doc({"a.sum": new(*(tree(k) for k in range(300)))})
    df = spark.createDataFrame([(10.0,)], "a double")
    d["input"]["fields"] = d["input"]["fields"][:1]
    assert df.select(to_column(d, df.columns)).first()[0] == 290 + 0.5 * 10
    assert "def score" in to_python(d) and "double score" in to_c(d)
