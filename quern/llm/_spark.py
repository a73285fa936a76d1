"""What the operators share on the Spark side: tables, durable intermediates, bucket counts, components."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of stored input behind one bucket of a blob exchange.
BUCKET_BYTES = 12 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Without one a session of one machine uses a folder of its own; any other must name it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{tempfile.gettempdir()}/quern-checkpoints"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends there, and a lost executor costs nothing.

    The files go when the driver's JVM ends, or earlier by ``discard``; the shuffle files behind them when they are written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    files, at = _file_system(spark, path)
    files.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored DataFrame that nothing reads any more."""
    files, at = _file_system(df.sparkSession, df._stored_at)
    files.delete(at, True)


def input_bytes(df: DataFrame) -> int:
    """Bytes behind df: what the optimiser knows of its leaves, which for a file scan is the size of its files, whatever is projected."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size if size < 1 << 60 else 1 << 30 for size in sizes)


def buckets_for(df: DataFrame, per_bucket: int = BUCKET_BYTES) -> int:
    """Buckets of a blob exchange: in proportion to the input without bound, so that a bucket keeps its size."""
    return max(8, math.ceil(input_bytes(df) / per_bucket))


def clashes(df: DataFrame) -> DataFrame | None:
    """Values of a that stand with several values of b; a and b are independent 64-bit hashes of one content. None where there are none."""
    found = stored(df.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high").select(F.col("a").alias("_clash")), "clashes")
    return None if found.isEmpty() else found


def with_node(df: DataFrame, found: DataFrame | None) -> DataFrame:
    """df with node in place of a and b: a, or where different contents share an a, a hash of both."""
    if found is None:
        return df.withColumnRenamed("a", "node").drop("b")
    joined = df.join(found, df["a"] == found["_clash"], "left")
    return joined.withColumn("node", F.when(F.col("_clash").isNull(), F.col("a")).otherwise(F.xxhash64("a", "b"))).drop("a", "b", "_clash")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32(doc_id as text) mod `of`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, component) for every node with an edge; component is its smallest node.

    Alternates large-star and small-star contraction; every round is written out. No node's
    neighbours are ever gathered: a hub costs one partial minimum per task. Self loops and nulls are ignored.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    seen = before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        if before is not None:
            discard(before)
        before = edges
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == now:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
