"""The corpus pipeline: five of the operators of quern.llm, one after another, over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again for the next. The last stage returns doc_id, ids, n_tokens, n_bytes; the others the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, line_dedup, ngram_join, quality, sentencepiece_codec
from quern.llm._spark import remainder, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Learns from the folds that op7 learns from."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(remainder(F.col("doc_id"), 4) != 2))
    return quality.keep_good(docs, model)


def _rest(docs: DataFrame, cut) -> DataFrame:
    """docs as `cut` leaves them, without those of which nothing is left, with n_chars renewed."""
    had = next(name for name in ("_had" + "_" * k for k in range(len(docs.columns) + 1)) if name not in docs.columns)
    kept = cut(docs.withColumn(had, F.length("text") > 0))
    kept = kept.where(~F.coalesce(F.col(had), F.lit(False)) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, and with them the documents of which nothing else is left.

    Long lines of few documents wait for the next stage: here near copies would lose all but their short lines, and not be found there.
    """
    return _rest(docs, lambda x: line_dedup.drop_recurring_lines(x, long_docs=None))


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays; of the rest, long lines stay in their first document only."""
    return _rest(stored(ngram_join.keep_representatives(docs), "representatives"), line_dedup.drop_long_repeats)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become SentencePiece ids."""
    coded = sentencepiece_codec.encode(docs.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes")))
    return coded.select("doc_id", "ids", "n_tokens", "n_bytes")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", ngram_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("SentencePiece encoding and decoding", encode_stage),
]

#: The classifier's learned tables and the encoder's Viterbi can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
    return docs
