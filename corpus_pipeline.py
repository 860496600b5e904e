"""A training corpus from raw documents: toxicity, near-duplicates, benchmark leaks, personal data, piece ids.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns the documents that stay, with their columns. The
last one adds the encoding. `run` writes each stage's result to the shared folder and reads it again for the next.

Every stage hands its tasks `BATCH_ROWS` documents at a time, so that a task holds a few megabytes of text besides its tables.

Defined cases: a null or empty text is not toxic, links with nothing, holds no item and no personal data, and is encoded as no ids; equal
rows are copies of each other; rows without doc_id are judged by their text alone; an empty table stays empty; other columns are
kept, and n_chars follows the text where there is such a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from salescube.llm import decontamination, near_dedup, pii, piece_codec, toxicity
from salescube.sources.scratch import stage

BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Fewer rows per batch that Spark hands to Python, if the session asks for more."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that compression distance does not call toxic; learnt from all labels."""
    small_batches(spark)
    return toxicity.clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    small_batches(spark)
    return near_dedup.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    small_batches(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    small_batches(spark)
    clean = pii.redacted(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with n_tokens, token_ids and round_trip."""
    small_batches(spark)
    return piece_codec.encoded(docs, piece_codec.load())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", redact),
    ("sentencepiece", encode),
]

#: Compression lengths, components and merges are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
