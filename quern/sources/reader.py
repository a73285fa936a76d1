"""Delimited-file scans: raw (all text) and typed by stored column metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.types import ColumnInfo, Format, Type, quoted

# Cell texts that mean "missing".
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# A number as both SQL dialects and C agree on it.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def null_tokens(column: Column) -> Column:
    """Missing-value tokens become NULL."""
    return F.when(column.isin(*NA_TOKENS), None).otherwise(column)


def to_float(column: Column) -> Column:
    """Text to float; NULL where the text isn't a number."""
    return F.when(column.rlike(NUMBER), F.trim(column).try_cast("float"))


def _check(path: str) -> None:
    if not path.lower().rstrip("/").endswith(".csv"):
        raise NotImplementedError(f"only .csv is supported: {path}")


def _scan(spark: SparkSession, path: str, columns: int) -> DataFrame:
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(columns)])
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True, escape='"', multiLine=False)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text under its header name, missing-value tokens as NULL."""
    _check(path)
    df = spark.read.csv(path, header=True, inferSchema=False, escape='"')
    return df.select(*(null_tokens(F.col(quoted(c))).alias(c) for c in df.columns))


def encode_categories(values: Column, categories: Sequence, *, strict: bool = False) -> Column:
    """A value's place in the stored list of categories as short; -1 where it is missing.

    A value that isn't listed is -1 too, or an error with ``strict``.
    """
    if not len(categories):
        code = F.lit(-1)
    else:
        code = F.coalesce(F.array_position(F.array(*(F.lit(c) for c in categories)), values) - 1, F.lit(-1))
    if strict:
        unseen = F.raise_error(F.concat(F.lit("not a category: "), values.cast("string"))).cast("int")
        code = F.when(values.isNotNull() & (code == -1), unseen).otherwise(code)
    return code.cast("short")


def read_typed(spark: SparkSession, path: str, columns: Sequence[ColumnInfo], *, strict: bool = False) -> DataFrame:
    """The stored schema: ids as names, numbers as float, category and binary text as codes, other text as text.

    Columns whose format is neither numerical nor character aren't read at all.
    """
    _check(path)
    df = _scan(spark, path, len(columns))
    out = []
    for i, c in enumerate(columns):
        value = null_tokens(F.col(f"c{i}"))
        if c.data_format == Format.numerical:
            out.append(to_float(value).alias(str(c.id)))
        elif c.data_format == Format.character and c.data_type in (Type.categorical, Type.binary):
            out.append(encode_categories(value, [v for v, _ in c.uniques], strict=strict).alias(str(c.id)))
        elif c.data_format == Format.character:
            out.append(value.alias(str(c.id)))
    return df.select(*out)


def read(spark: SparkSession, path: str, columns: Sequence[ColumnInfo] | None = None, *, strict: bool = False) -> DataFrame:
    """Raw without metadata, typed with it."""
    return read_raw(spark, path) if columns is None else read_typed(spark, path, columns, strict=strict)
