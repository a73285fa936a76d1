"""The query catalogue: every operator of the engine as a named query over the test tables, with its SQL.

The SQL is written by hand, except for the scores of tree ensembles, which come from the compiler's
DuckDB dialect. Sums and exponentials are rounded, as their last digits follow the order of addition.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.compile import to_column, to_sql
from quern.functions.rewrite import decode_missing, decode_one_hot
from quern.operators import metrics, models
from quern.operators.durable import scratch
from quern.operators.models.linear import gram
from quern.operators.models.trees import best_splits
from quern.operators.preprocess import OneHotEncoder, fill_missing, split, split_key
from quern.operators.profile import detect_format, histogram, profile, value_counts
from quern.operators.transform import apply
from quern.plans.catalog import MemoryCatalog
from quern.plans.workflows import Engine, limited
from quern.sources.reader import encode_categories, null_tokens, read, to_float
from quern.sources.sinks import get_text, records, write_dataset
from quern.streaming.scoring import read_stream, score_stream, windowed_profile
from quern.types import ColumnInfo, VirtualColumn

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc(fields: list[str], action, name: str = "out", nullable: tuple[str, ...] = ()) -> dict:
    kinds = [{"name": f, "type": ["double", "null"] if f in nullable else "double"} for f in fields]
    return {"input": {"type": "record", "fields": kinds}, "output": {"name": name, "type": "double"}, "action": action}


# --- profiles -----------------------------------------------------------------------------------------


def _profile_sql(relation: str, numbers: list[str], texts: list[str], order: list[str]) -> str:
    parts = []
    for c in order:
        if c in numbers:
            x = f"CAST({c} AS FLOAT)"
            parts.append(
                f"SELECT '{c}' AS \"column\", count(*) - count({x}) AS missing_values_count, 'numerical' AS format, CASE WHEN count(DISTINCT {x}) >= 1000 THEN 'continuous' ELSE 'categorical' END AS type, "
                f"CASE WHEN count(DISTINCT {x}) < 1000 THEN count(DISTINCT {x}) END AS uniques_count, CAST(min({x}) AS DOUBLE) AS num_min, CAST(max({x}) AS DOUBLE) AS num_max, "
                f"round(sum(CAST({x} AS DOUBLE)), 2) AS num_sum, CAST(NULL AS INTEGER) AS min_len, CAST(NULL AS INTEGER) AS max_len FROM {relation}"
            )
        elif c in texts:
            x = f"CAST({c} AS VARCHAR)"
            parts.append(
                f"SELECT '{c}' AS \"column\", count(*) - count({x}) AS missing_values_count, 'character' AS format, CASE WHEN count(DISTINCT {x}) >= 1000 THEN 'continuous' ELSE 'categorical' END AS type, "
                f"CASE WHEN count(DISTINCT {x}) < 1000 THEN count(DISTINCT {x}) END AS uniques_count, CAST(NULL AS DOUBLE) AS num_min, CAST(NULL AS DOUBLE) AS num_max, CAST(NULL AS DOUBLE) AS num_sum, "
                f"CAST(min(length({x})) AS INTEGER) AS min_len, CAST(max(length({x})) AS INTEGER) AS max_len FROM {relation}"
            )
    return " UNION ALL ".join(parts)


def _flat(df: DataFrame) -> DataFrame:
    return profile(df).drop("uniques_stats").withColumn("num_sum", F.round("num_sum", 2))


_LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE = [*_LINE_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"]


@query(_profile_sql("lineitem", _LINE_NUMBERS, ["l_returnflag", "l_linestatus", "l_shipdate"], _LINE))
def profile_dataset(spark, d):
    return _flat(table(spark, d, "lineitem"))


@query(_profile_sql("events", ["value", "user_id"], ["event_type"], ["value", "user_id", "event_type"]))
def profile_numeric(spark, d):
    return _flat(table(spark, d, "events").select("value", "user_id", "event_type"))


@query(_profile_sql("customer", [], ["c_name", "c_mktsegment"], ["c_name", "c_mktsegment"]))
def profile_text(spark, d):
    return _flat(table(spark, d, "customer").select("c_name", "c_mktsegment"))


@query(_profile_sql("(SELECT nullif(l_discount, 0) AS l_discount, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem)", ["l_discount"], ["l_returnflag"], ["l_discount", "l_returnflag"]))
def profile_missing(spark, d):
    return _flat(table(spark, d, "lineitem").select(F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag")))


@query("SELECT k AS \"column\", v AS value, count(*) AS count FROM (SELECT 'l_returnflag' AS k, l_returnflag AS v FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem) GROUP BY k, v")
def value_counts_text(spark, d):
    return value_counts(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus"))


@query("SELECT event_type AS value, count(*) AS count, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS place FROM events GROUP BY event_type")
def uniques_sorted(spark, d):
    found = profile(table(spark, d, "events").select("event_type"))
    return found.select(F.posexplode("uniques_stats").alias("place", "u")).select("u.value", "u.count", "place")


_TYPES = ["l_extendedprice", "l_quantity", "l_discount", "l_returnflag"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) >= 1000 THEN 'continuous' ELSE 'categorical' END AS type FROM lineitem" for c in _TYPES))
def profile_types(spark, d):
    return profile(table(spark, d, "lineitem").select(*_TYPES)).select("column", "type")


@query(
    "SELECT CASE WHEN bool_and(regexp_full_match(p, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')) THEN 'numerical' ELSE 'character' END AS price, "
    "CASE WHEN bool_and(regexp_full_match(s, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')) THEN 'numerical' ELSE 'character' END AS mixed "
    "FROM (SELECT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS p, CASE WHEN l_linenumber = 7 THEN 'n7' ELSE CAST(l_linenumber AS VARCHAR) END AS s FROM lineitem)"
)
def format_detect(spark, d):
    texts = table(spark, d, "lineitem").select(F.col("l_quantity").cast("int").cast("string").alias("p"), F.when(F.col("l_linenumber") == 7, "n7").otherwise(F.col("l_linenumber").cast("string")).alias("s"))
    return texts.agg(detect_format(F.col("p")).alias("price"), detect_format(F.col("s")).alias("mixed"))


def _histogram_sql(relation: str, x: str, name: str) -> str:
    return f"""
    WITH v AS (SELECT CAST(CAST({x} AS FLOAT) AS DOUBLE) AS x FROM {relation}), r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    c AS (SELECT least(CAST(floor((x - lo) / ((hi - lo) / 19)) AS INTEGER), 18) AS bin, count(*) AS n FROM v, r GROUP BY 1)
    SELECT '{name}' AS "column", CAST(b AS INTEGER) AS bin, round(lo + (hi - lo) * b / 19, 6) AS lo, round(lo + (hi - lo) * (b + 1) / 19, 6) AS hi, coalesce(n, 0) AS count
    FROM range(19) t(b) CROSS JOIN r LEFT JOIN c ON c.bin = b"""


@query(_histogram_sql("lineitem", "l_extendedprice", "l_extendedprice"))
def histogram_continuous(spark, d):
    return histogram(table(spark, d, "lineitem"), ["l_extendedprice"]).withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


@query(_histogram_sql("events", "value", "value"))
def histogram_events(spark, d):
    return histogram(table(spark, d, "events"), ["value"]).withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


# --- scans, sinks, projection, limit ------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS SMALLINT) AS code FROM lineitem")
def categories_unify(spark, d):
    rows = table(spark, d, "lineitem")
    listed = profile(rows.select("l_returnflag")).first()["uniques_stats"]
    return rows.select("l_orderkey", "l_linenumber", encode_categories(F.col("l_returnflag"), [u["value"] for u in listed]).alias("code"))


@query("SELECT CAST(o_orderkey AS FLOAT) AS \"0\", CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE -1 END AS SMALLINT) AS \"1\", CAST(o_totalprice AS FLOAT) AS \"2\" FROM orders")
def typed_scan_project(spark, d):
    path = scratch(spark, "orders", ".csv")
    table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority").write.csv(path, header=True)
    status = {"uniques_stats": [("F", 1), ("O", 1), ("P", 1)]}
    infos = [ColumnInfo(0, "o_orderkey", "numerical"), ColumnInfo(1, "o_orderstatus", "character", "categorical", status), ColumnInfo(2, "o_totalprice", "numerical"), ColumnInfo(3, "o_orderpriority", "other")]
    return read(spark, path, infos)


@query("SELECT nullif(CASE WHEN l_linenumber = 1 THEN 'NA' WHEN l_linenumber = 2 THEN 'null' ELSE l_returnflag END, 'NA') AS flag FROM lineitem WHERE l_linenumber <> 2 UNION ALL SELECT NULL FROM lineitem WHERE l_linenumber = 2")
def untyped_scan_tokens(spark, d):
    path = scratch(spark, "tokens", ".csv")
    table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") == 1, "NA").when(F.col("l_linenumber") == 2, "null").otherwise(F.col("l_returnflag")).alias("flag"), F.lit("x").alias("other")).write.csv(path, header=True)
    return read(spark, path).select("flag")


@query("SELECT '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS record FROM nation")
def export_json(spark, d):
    path = scratch(spark, "nation")
    write_dataset(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), path)
    return spark.read.text(path).withColumnRenamed("value", "record")


@query("SELECT r_regionkey, r_name FROM region")
def export_csv(spark, d):
    path = scratch(spark, "region")
    write_dataset(table(spark, d, "region").select("r_regionkey", "r_name"), path, "csv")
    return spark.read.csv(path, header=True, schema="r_regionkey int, r_name string")


@query("SELECT '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}' AS record FROM region")
def records_json(spark, d):
    return records(table(spark, d, "region").select("r_regionkey", "r_name"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50")
def limit_sorted(spark, d):
    return limited(table(spark, d, "orders"), columns=["o_orderkey", "o_totalprice"], limit=50, order_by=["o_orderkey"])


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 100")
def offset_sorted(spark, d):
    return limited(table(spark, d, "orders"), columns=["o_orderkey", "o_orderstatus"], offset=100, limit=20, order_by=["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def topk(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("SELECT count(*) AS present FROM lineitem WHERE nullif(l_discount, 0) IS NOT NULL")
def filter_not_null(spark, d):
    return table(spark, d, "lineitem").where(F.nullif("l_discount", F.lit(0.0)).isNotNull()).agg(F.count("*").alias("present"))


@query("SELECT CAST(CASE WHEN regexp_full_match(s, '\\d+') THEN CAST(s AS FLOAT) END AS FLOAT) AS x, count(*) AS n FROM (SELECT CASE WHEN l_linenumber = 3 THEN 'three' ELSE CAST(l_linenumber AS VARCHAR) END AS s FROM lineitem) GROUP BY 1")
def cast_numbers(spark, d):
    s = F.when(F.col("l_linenumber") == 3, "three").otherwise(F.col("l_linenumber").cast("string"))
    return table(spark, d, "lineitem").select(to_float(null_tokens(s)).alias("x")).groupBy("x").agg(F.count("*").alias("n"))


# --- preparation --------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0), 9e30) AS l_discount FROM lineitem")
def missing_fill(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"))
    return fill_missing(rows, [ColumnInfo("l_discount", "l_discount", "numerical", statistics={"missing_values_count": 1})])[0]


@query('SELECT l_orderkey, l_linenumber, CAST(l_returnflag = \'A\' AS SMALLINT) AS "flag__0", CAST(l_returnflag = \'N\' AS SMALLINT) AS "flag__1", CAST(l_returnflag = \'R\' AS SMALLINT) AS "flag__2" FROM lineitem')
def one_hot_text(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", encode_categories(F.col("l_returnflag"), ["A", "N", "R"]).alias("flag"))
    info = ColumnInfo("flag", "flag", "character", "categorical", {"uniques_stats": [("A", 1), ("N", 1), ("R", 1)]})
    return OneHotEncoder(["flag"], [info]).update(rows, [info])[0]


_TAXES = [0.0, 0.02, 0.05]


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(f'CAST(coalesce(nullif(l_tax, 0.02) = {v}, false) AS SMALLINT) AS "tax__{k}"' for k, v in enumerate(_TAXES)) + " FROM lineitem")
def one_hot_numeric(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_tax", F.lit(0.02)).alias("tax"))
    info = ColumnInfo("tax", "tax", "numerical", "categorical", {"uniques_stats": [(v, 1) for v in _TAXES]})
    return OneHotEncoder(["tax"], [info]).update(rows, [info])[0]


_MD5 = "CAST(('0x' || substr(md5(o_orderkey || '|' || '7'), 1, 8)) AS UBIGINT)"


@query(f"SELECT count(*) FILTER ({_MD5} >= 1717986918) AS train, count(*) FILTER ({_MD5} < 1717986918) AS test, CAST(sum(CASE WHEN {_MD5} < 1717986918 THEN o_orderkey END) AS BIGINT) AS test_keys FROM orders")
def split_counts(spark, d):
    train, test = split(table(spark, d, "orders"), 0.4, key=["o_orderkey"], seed=7)
    return train.agg(F.count("*").alias("train")).crossJoin(test.agg(F.count("*").alias("test"), F.sum("o_orderkey").alias("test_keys")))


@query(f"SELECT o_orderkey, CAST({_MD5} AS BIGINT) AS k FROM orders")
def split_keys(spark, d):
    return table(spark, d, "orders").select("o_orderkey", split_key(["o_orderkey"], 7).alias("k"))


# --- PFA expressions ----------------------------------------------------------------------------------

_Q, _P, _D, _T = "input.l_quantity", "input.l_extendedprice", "input.l_discount", "input.l_tax"
_ALL = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pfa(name: str, action, sql: str, digits: int = 6, fields: list[str] = _ALL) -> None:
    document = doc(fields, action)

    def run(spark, d):
        rows = table(spark, d, "lineitem").withColumn("gap", F.nullif("l_discount", F.lit(0.0)))
        return rows.select("l_orderkey", "l_linenumber", F.round(to_column(document, rows.columns), digits).alias("out"))

    run.__name__ = name
    query(f"SELECT l_orderkey, l_linenumber, round(CAST({sql} AS DOUBLE), {digits}) AS out FROM (SELECT *, nullif(l_discount, 0) AS gap FROM lineitem)")(run)


_new = lambda *xs: {"type": {"type": "array", "items": "double"}, "new": list(xs)}
_pfa("pfa_arith", {"-": [{"*": [_P, {"-": [1, _D]}]}, {"/": [_Q, 4]}]}, "l_extendedprice * (1 - l_discount) - l_quantity / 4.0")
_pfa("pfa_divide_zero", {"if": {">": [{"/": [_Q, _D]}, 1e300]}, "then": -1, "else": {"/": [_Q, {"+": [_D, 1]}]}}, "CASE WHEN l_discount = 0 THEN -1 ELSE l_quantity / (l_discount + 1) END")
_pfa("pfa_compare", {"+": [{"+": [{"<": [_Q, 25]}, {"*": [2, {">=": [_D, 0.05]}]}]}, {"+": [{"*": [4, {"==": [_T, 0.02]}]}, {"*": [8, {"!=": [_T, 0.02]}]}]}]}, "(l_quantity < 25)::INT + 2 * (l_discount >= 0.05)::INT + 4 * (l_tax = 0.02)::INT + 8 * (l_tax <> 0.02)::INT")
_pfa("pfa_if", {"if": {"<=": [_Q, 10]}, "then": _P, "else": {"if": {">": [_D, 0.05]}, "then": 0, "else": 1}}, "CASE WHEN l_quantity <= 10 THEN l_extendedprice WHEN l_discount > 0.05 THEN 0 ELSE 1 END")
_pfa("pfa_ifnotnull", {"ifnotnull": {"x": "input.gap", "y": _Q}, "then": {"*": ["x", "y"]}, "else": -1}, "coalesce(gap * l_quantity, -1)", fields=[*_ALL, "gap"])
_pfa("pfa_literal", {"+": [{"double": 1.5}, {"+": [{"type": "int", "value": 2}, {"*": [True, _Q]}]}]}, "1.5 + 2 + l_quantity")
_pfa("pfa_array_sum", {"a.sum": _new(_Q, _P, {"*": [_D, 100]}, 7)}, "l_quantity + l_extendedprice + l_discount * 100 + 7")
_pfa("pfa_argmax", {"a.argmax": _new({"*": [_D, 100]}, {"*": [_T, 100]}, {"/": [_Q, 5]})}, "list_position([l_discount * 100, l_tax * 100, l_quantity / 5], greatest(l_discount * 100, l_tax * 100, l_quantity / 5)) - 1")
_pfa("pfa_linear", {"+": [{"m.kernel.linear": [_new(0.5, 0.001, -3, 2), _new(_Q, _P, _D, _T)]}, 1]}, "0.5 * l_quantity + 0.001 * l_extendedprice - 3 * l_discount + 2 * l_tax + 1")
_pfa("pfa_logit", {"a.sum": {"m.link.logit": _new({"-": [_D, 0.05]}, {"/": [_Q, 50]})}}, "1 / (1 + exp(-(l_discount - 0.05))) + 1 / (1 + exp(-l_quantity / 50))")
_pfa("pfa_exp", {"m.exp": [{"*": [_D, 2]}]}, "exp(l_discount * 2)")
_pfa("pfa_la_add", {"a.sum": {"la.add": [_new(_Q, _P), _new(1, {"*": [2, _D]})]}}, "l_quantity + 1 + l_extendedprice + 2 * l_discount")
_pfa("pfa_la_add_transposed", {"a.argmax": {"la.add": [_new(_new(_D), _new(_T)), _new(_new(0.01, 0.0))]}}, "CASE WHEN l_discount + 0.01 >= l_tax THEN 0 ELSE 1 END")
_pfa("pfa_la_dot", {"a.sum": {"la.dot": [_new(_new(1, 2, 3), _new(_Q, _D, _T)), _new(4, _Q, _P)]}}, "4 + 2 * l_quantity + 3 * l_extendedprice + l_quantity * 4 + l_discount * l_quantity + l_tax * l_extendedprice")
_pfa("pfa_transpose", {"a.sum": {"la.dot": [{"la.transpose": _new(_new(_Q, 1), _new(_D, 2))}, _new(3, 5)]}}, "3 * l_quantity + 5 * l_discount + 3 + 10")
_pfa("pfa_zipmap", {"a.sum": {"a.zipmap": [_new(_Q, _D), _new(2, 3), {"params": [{"x": "double"}, {"y": "double"}], "ret": "double", "do": {"*": ["x", "y"]}}]}}, "l_quantity * 2 + l_discount * 3")


@query("SELECT l_orderkey, l_linenumber, CAST(2016 - l_quantity AS FLOAT) AS age, CAST(18 - CAST(2016 - l_quantity AS FLOAT) AS FLOAT) AS different FROM lineitem")
def pfa_chain(spark, d):
    docs = [doc(["l_quantity"], {"-": [2016, _Q]}, "age"), None, doc(["age"], {"-": [18, "input.age"]}, "different")]
    return apply(table(spark, d, "lineitem"), docs).select("l_orderkey", "l_linenumber", "age", "different")


# --- model scores -------------------------------------------------------------------------------------


def _tree(x: str, a: float, y: str, b: float, values: tuple[float, float, float]) -> dict:
    return {"if": {"<=": [f"input.{x}", a]}, "then": {"if": {"<=": [f"input.{y}", b]}, "then": {"double": values[0]}, "else": {"double": values[1]}}, "else": {"double": values[2]}}


_TREES = [_tree("l_quantity", 8.5 + k, "l_discount", 0.015 + 0.002 * k, (k - 2.5, 1.5 * k, 4.0 - k)) for k in range(20)]
_MODELS = {
    "score_tree": doc(_ALL, _TREES[3]),
    "score_gbm_regressor": doc(_ALL, {"+": [22.5, {"*": [0.01, {"a.sum": _new(*_TREES)}]}]}),
    "score_gbm_classifier": doc(_ALL, {"a.argmax": _new(*({"a.sum": _new(1 / 3, *_TREES[k::3])} for k in range(3)))}),
    "score_logit": doc(_ALL, {"a.argmax": {"m.link.logit": {"la.add": [{"la.dot": [_new(_new(0.1, 0, -3, 1), _new(-0.1, 0, 5, 1), _new(0, 0, 2, 2)), _new(*(_new(f"input.{c}") for c in _ALL))]}, _new(_new(-2.0), _new(3.0), _new(0.5))]}}}),
    "pfa_onehot_decoded": decode_one_hot(doc(["var1__0", "var1__1", "varl_discount"], {"+": [{"*": [10, "input.var1__0"]}, {"+": [{"*": [20, "input.var1__1"]}, "input.varl_discount"]}]}), {1: [VirtualColumn("1__0", 1.0), VirtualColumn("1__1", 2.0)]}),
    "pfa_missing_decoded": decode_missing(doc(["vargap"], {"if": {"<=": ["input.vargap", 0.05]}, "then": {"double": "input.vargap"}, "else": {"double": 7.0}}), {"gap": 9e30}),
}
_HAND = {
    "score_tree": "CASE WHEN l_quantity <= 11.5 THEN CASE WHEN l_discount <= 0.021 THEN 0.5 ELSE 4.5 END ELSE 1.0 END",
    "pfa_onehot_decoded": "CASE WHEN l_linenumber = 1 THEN 10 WHEN l_linenumber = 2 THEN 20 ELSE 0 END + l_discount",
    "pfa_missing_decoded": "CASE WHEN gap <= 0.05 THEN gap ELSE 7 END",
}
for _name, _doc in _MODELS.items():

    def _score(spark, d, document=_doc):
        rows = table(spark, d, "lineitem").select("*", F.col("l_linenumber").alias("var1"), F.nullif("l_discount", F.lit(0.0)).alias("gap"))
        return rows.select("l_orderkey", "l_linenumber", F.round(to_column(document, rows.columns), 6).alias("score"))

    _score.__name__ = _name
    _sql = _HAND.get(_name) or to_sql(_doc, _ALL, "duckdb")
    query(f"SELECT l_orderkey, l_linenumber, round(CAST({_sql} AS DOUBLE), 6) AS score FROM (SELECT *, nullif(l_discount, 0) AS gap FROM lineitem)")(_score)


# --- learning and evaluation --------------------------------------------------------------------------


@query("SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem")
def ols_simple(spark, d):
    m = models.create("stepwise_linear_regression").build(table(spark, d, "lineitem").select("l_quantity", "l_extendedprice"), "l_extendedprice")
    return spark.createDataFrame([(round(float(m.coefficients[0]), 5), round(m.intercept, 3))], "slope double, intercept double")


@query("SELECT round(covar_pop(l_quantity, l_extendedprice) * count(*) / 1e6, 4) AS s01, round(var_pop(l_quantity) * count(*) / 1e6, 6) AS s00, count(*) AS n FROM lineitem")
def ols_gram(spark, d):
    n, _, g = gram(table(spark, d, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    return spark.createDataFrame([(round(float(g[0, 1]) / 1e6, 4), round(float(g[0, 0]) / 1e6, 6), n)], "s01 double, s00 double, n long")


def _split_sql(stats: list[str]) -> str:
    sums = ", ".join(f"sum({s}) AS s{i}" for i, s in enumerate(stats))
    runs = ", ".join(f"sum(s{i}) OVER w AS l{i}, sum(s{i}) OVER (PARTITION BY feature) AS t{i}" for i in range(len(stats)))
    gain = " + ".join(f"(l{i} * l{i} / l + (t{i} - l{i}) * (t{i} - l{i}) / (t - l) - t{i} * t{i} / t)" for i in range(len(stats)))
    feats = " UNION ALL ".join(f"SELECT '{f}' AS feature, {k} AS o, CAST({f} AS DOUBLE) AS x, * FROM lineitem" for k, f in enumerate(("l_quantity", "l_discount", "l_tax")))
    return f"""
    WITH c AS (SELECT feature, o, x, count(*) AS n, {sums} FROM ({feats}) GROUP BY feature, o, x),
    r AS (SELECT *, lead(x) OVER (PARTITION BY feature ORDER BY x) AS nx, sum(n) OVER w AS l, sum(n) OVER (PARTITION BY feature) AS t, {runs} FROM c WINDOW w AS (PARTITION BY feature ORDER BY x)),
    g AS (SELECT feature, o, x, (x + nx) / 2 AS threshold, round({gain}, 9) AS gain, l FROM r WHERE nx IS NOT NULL)
    SELECT feature, round(threshold, 9) AS threshold, round(gain, 3) AS gain, CAST(l AS BIGINT) AS n_left FROM g ORDER BY g.gain DESC, o, x LIMIT 1"""


_SPLIT = ["l_quantity", "l_discount", "l_tax"]


@query(_split_sql(["l_linenumber * 1.0::DOUBLE"]))
def cart_best_split_regression(spark, d):
    rows = table(spark, d, "lineitem").select(*_SPLIT, F.col("l_linenumber").cast("double").alias("y"))
    return best_splits(rows, F.lit(0), _SPLIT, ["y"]).select("feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 3).alias("gain"), "n_left")


@query(_split_sql([f"(l_returnflag = '{f}')::INT::DOUBLE" for f in "ANR"]))
def cart_best_split_gini(spark, d):
    rows = table(spark, d, "lineitem").select(*_SPLIT, *((F.col("l_returnflag") == f).cast("double").alias(f"y{f}") for f in "ANR"))
    return best_splits(rows, F.lit(0), _SPLIT, ["yA", "yN", "yR"]).select("feature", F.round("threshold", 9).alias("threshold"), F.round("gain", 3).alias("gain"), "n_left")


@query("SELECT round(avg(l_extendedprice), 4) AS init, round(sum(abs(l_extendedprice - m)) / 1e6, 4) AS residual FROM lineitem, (SELECT avg(l_extendedprice) AS m FROM lineitem)")
def gbm_init_residual(spark, d):
    rows = table(spark, d, "lineitem").select("l_extendedprice")
    mean = F.broadcast(rows.agg(F.avg("l_extendedprice").alias("m")))
    return rows.crossJoin(mean).agg(F.round(F.avg("l_extendedprice"), 4).alias("init"), F.round(F.sum(F.abs(F.col("l_extendedprice") - F.col("m"))) / 1e6, 4).alias("residual"))


@query("SELECT round(avg((y - p) * (y - p)), 4) AS mse, round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 8) AS r2 FROM (SELECT l_quantity AS y, l_linenumber * 7.0::DOUBLE AS p, avg(l_quantity) OVER () AS m FROM lineitem)")
def mse_r2(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_quantity").alias("y"), (F.col("l_linenumber") * 7.0).alias("p"))
    return metrics.regression(rows, "y", "p").select(F.round("mse", 4).alias("mse"), F.round("r2", 8).alias("r2"))


@query("SELECT round(avg((l_linenumber = CASE WHEN l_quantity > 25 THEN 1 ELSE 2 END)::INT), 10) AS accuracy FROM lineitem")
def accuracy(spark, d):
    rows = table(spark, d, "lineitem").select("l_linenumber", F.when(F.col("l_quantity") > 25, 1).otherwise(2).alias("p"))
    return metrics.accuracy(rows, "l_linenumber", "p").select(F.round("accuracy", 10).alias("accuracy"))


@query("""
WITH v AS (SELECT l_extendedprice AS y, 30000.0::DOUBLE + 10 * l_quantity AS p1, 30000.0::DOUBLE + 10 * l_quantity + 100 * l_tax AS p2, avg(l_extendedprice) OVER () AS m FROM lineitem)
SELECT CAST(1 AS INTEGER) AS stage, round(avg((y - p1) * (y - p1)) / 1e6, 4) AS mse, round(1 - sum((y - p1) * (y - p1)) / sum((y - m) * (y - m)), 8) AS r2 FROM v
UNION ALL SELECT 2, round(avg((y - p2) * (y - p2)) / 1e6, 4), round(1 - sum((y - p2) * (y - p2)) / sum((y - m) * (y - m)), 8) FROM v""")
def staged_metrics(spark, d):
    rows = table(spark, d, "lineitem")
    out = metrics.staged_regression(rows, "l_extendedprice", 30000.0, [F.col("l_quantity") * 10, F.col("l_tax") * 100])
    return out.select("stage", F.round(F.col("mse") / 1e6, 4).alias("mse"), F.round("r2", 8).alias("r2"))


@query("""
WITH v AS (SELECT (l_linenumber > 3)::INT AS y, l_quantity - 25 AS a1, 0.1 AS b1, l_quantity - 25 + 100 * l_discount AS a2, 0.1 + 100 * l_tax AS b2 FROM lineitem)
SELECT CAST(1 AS INTEGER) AS stage, round(avg((y = CASE WHEN a1 >= b1 THEN 0 ELSE 1 END)::INT), 9) AS accuracy FROM v UNION ALL SELECT 2, round(avg((y = CASE WHEN a2 >= b2 THEN 0 ELSE 1 END)::INT), 9) FROM v""")
def staged_accuracy(spark, d):
    rows = table(spark, d, "lineitem").withColumn("y", (F.col("l_linenumber") > 3).cast("double"))
    steps = [[F.col("l_quantity") - 25, F.col("l_discount") * 100], [F.lit(0.1), F.col("l_tax") * 100]]
    return metrics.staged_accuracy(rows, "y", [0.0, 0.0], steps, [0.0, 1.0]).select("stage", F.round("accuracy", 9).alias("accuracy"))


_NODES = "(VALUES (0, 0, 1, 2, 'a', 100, 0.5), (0, 1, 3, 4, 'b', 60, 0.4), (0, 2, NULL, NULL, NULL, 40, 0.1), (0, 3, NULL, NULL, NULL, 30, 0.2), (0, 4, NULL, NULL, NULL, 30, 0.0))"


@query(f"""
WITH n AS (SELECT * FROM {_NODES} t(tree, node, "left", "right", feature, n, impurity)),
g AS (SELECT p.feature, p.n * p.impurity - l.n * l.impurity - r.n * r.impurity AS g FROM n p JOIN n l ON p."left" = l.node JOIN n r ON p."right" = r.node)
SELECT feature, CAST(round(100 * sum(g) / (SELECT sum(g) FROM g), 6) AS DOUBLE) AS importance FROM g GROUP BY feature""")
def importance_from_nodes(spark, d):
    rows = [(0, 0, 1, 2, "a", 100, 0.5), (0, 1, 3, 4, "b", 60, 0.4), (0, 2, None, None, None, 40, 0.1), (0, 3, None, None, None, 30, 0.2), (0, 4, None, None, None, 30, 0.0)]
    nodes = spark.createDataFrame(rows, "tree int, node int, left int, right int, feature string, n long, impurity double")
    return metrics.importance(nodes).select("feature", F.round("importance", 6).alias("importance"))


@query("SELECT v AS value, round(avg(v * 2 + CASE WHEN l_discount <= 0.05 THEN l_tax ELSE v END), 6) AS prediction FROM lineitem, (SELECT unnest([1.0::DOUBLE, 5.0, 20.0]) AS v) GROUP BY v")
def pdp_bruteforce(spark, d):
    model = doc(_ALL, {"+": [{"*": [_Q, 2]}, {"if": {"<=": [_D, 0.05]}, "then": _T, "else": _Q}]})
    out = metrics.partial_dependence(table(spark, d, "lineitem").select(*_ALL), model, "l_quantity", [1.0, 5.0, 20.0])
    return out.select("value", F.round("prediction", 6).alias("prediction"))


def _training(spark, d) -> DataFrame:
    label = F.array_position(F.array(*map(F.lit, "ANR")), F.col("l_returnflag")).cast("double") - 1
    return table(spark, d, "lineitem").select(*_ALL, F.col("l_linenumber").cast("double").alias("line"), label.alias("flag"))


def _trained(name: str, method: str, target: str, features: list[str], **parameters) -> None:
    def run(spark, d):
        rows = _training(spark, d).select(*features, target)
        return models.create(method, **parameters).build(rows, target).predict(rows).select(target, F.round("prediction", 6).alias("prediction"))

    run.__name__ = name
    query()(run)


_trained("train_linear", "stepwise_linear_regression", "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
_trained("train_logit", "logit", "flag", ["l_quantity", "l_discount", "l_tax", "line"])
_trained("train_cart", "CART_regression", "l_extendedprice", ["l_quantity", "l_discount", "l_tax"], max_depth=3)
# Grown to the end, a leaf holds the rows of equal features.
_trained("train_cart_full", "CART_regression", "l_extendedprice", ["l_quantity", "l_discount", "l_tax"], min_samples_split=2)
ORACLE_SQL["train_cart_full"] = "SELECT l_extendedprice, round(avg(l_extendedprice) OVER (PARTITION BY l_quantity, l_discount, l_tax), 6) AS prediction FROM lineitem"
_trained("train_cart_default", "CART_regression", "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "line"])
_trained("train_cart_clf", "CART_classification", "flag", ["l_quantity", "l_discount", "line"], max_depth=3)
_trained("train_gbm_reg", "TN_regression", "l_extendedprice", ["l_quantity", "l_discount", "l_tax"], n_estimators=3, max_leaf_nodes=8, learning_rate=0.1)
_trained("train_gbm_clf", "TN_classification", "flag", ["l_quantity", "l_discount", "line"], n_estimators=2, max_leaf_nodes=4, learning_rate=0.1)


@query()
def pipeline_models(spark, d):
    """The pipeline workflow over the whole table: a linear model and a tree for each of two targets, with their quality on both parts."""
    path = scratch(spark, "lineitem", ".csv")
    table(spark, d, "lineitem").select(*_ALL, "l_extendedprice", "l_returnflag").write.csv(path, header=True)
    engine = Engine(spark, MemoryCatalog(), scratch(spark, "models"))
    engine.extract_dataset_info(path, "lineitem")
    options = {
        "target_column_ids": [3, 0], "features": {k: {"type": "static"} for k in (0, 1, 2, 3, 4)}, "categorical_column_ids": [4],
        "predictive_analysis_options": {"stepwise_linear_regression": {}, "CART_regression": {"max_depth": 3}},
    }
    keys = engine.build_predictive_pipeline("all", path, "lineitem", options)
    rows = []
    for key in keys:
        info = json.loads(get_text(spark, f"{engine.folder}/models/{key}.info.json"))
        rows += [(key, part, round(info[part]["MSE"], 4), round(info[part]["R_squared"], 6)) for part in ("learn", "test")]
    return spark.createDataFrame(rows, "model string, part string, mse double, r_squared double")


# --- Spark-native extras: the same expressions on streams ---------------------------------------------

_EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _drain(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there and returns what it wrote."""
    path, checkpoint = scratch(spark, "stream"), scratch(spark, "stream-checkpoint")
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("SELECT event_id, CAST(value * 2 + 1 AS FLOAT) AS out FROM events")
def stream_score(spark, d):
    stream = read_stream(spark, f"{d}/events.parque*", _EVENTS)
    return _drain(spark, score_stream(stream, [doc(["value"], {"+": [{"*": ["input.value", 2]}, 1]})]).select("event_id", "out"))


@query("""
SELECT time_bucket(INTERVAL 1 day, ts) AS start, count(*) AS rows, round(sum(value), 4) AS sum FROM events
GROUP BY 1 HAVING time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day <= (SELECT max(ts) FROM events) - INTERVAL 10 minutes""")
def stream_windows(spark, d):
    stream = windowed_profile(read_stream(spark, f"{d}/events.parque*", _EVENTS), "ts", "value", window="1 day")
    return _drain(spark, stream.select(F.col("window.start").alias("start"), "rows", "sum")).select("start", "rows", F.round("sum", 4).alias("sum"))

