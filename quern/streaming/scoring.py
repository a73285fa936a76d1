"""Structured Streaming over the same documents: transformations are stateless, so a stream takes them unchanged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators.transform import apply
from quern.types import quoted


def read_stream(spark: SparkSession, path: str, schema: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def score_stream(stream: DataFrame, documents: Sequence[dict]) -> DataFrame:
    return apply(stream, documents)


def windowed_profile(stream: DataFrame, time: str, value: str, *, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Count, missing, min, max and sum of a column by event-time window; rows later than the watermark are left out."""
    x = F.col(quoted(value)).cast("double")
    bounded = stream.withWatermark(time, late).groupBy(F.window(F.col(quoted(time)), window))
    return bounded.agg(F.count("*").alias("rows"), F.count(F.when(x.isNull(), 1)).alias("missing"), F.min(x).alias("min"), F.max(x).alias("max"), F.sum(x).alias("sum"))


def write_stream(stream: DataFrame, path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Appends to Parquet with a checkpoint, so that a restart goes on where it stopped."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
