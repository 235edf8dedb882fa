"""The training-data pipeline: documents in, packed sequences out, each stage written as Parquet and read by the next.

Every stage but the last takes and returns the columns of documents; what a stage decides shows in its rows: texts
without a language go, of near copies one stays, secrets are masked, sources are repeated or cut to their share of the
mix, and the last stage says where in which sequence every piece of every document lies.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import copies, langid, mixing, packing, secrets, simhash
from tidelog.llm.queries import tokenizer_path
from tidelog.sources.scratch import materialise

#: Share of a text's words that its language must label: any, as the top one of several languages labels few.
LEAST_SHARE = 0.0
#: Bytes of a batch that is sent to Python, and rows of one that is read from Parquet. With Spark's own 64 MB and 4,096 rows
#: a task holds most of its texts at once and several times: in columns, in Arrow buffers on both sides, in Python.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "512"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with BATCHES set for the session, as what it returns runs when it is written. Batches change no result."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return run


def _row(docs: DataFrame) -> Column:
    """All columns as one, so that no name of theirs meets one of an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


@in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the label column stays as it came."""
    taught = docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id")))
    found = langid.identify(docs, langid.learn(taught), [_row(docs)])
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


@in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8): the one of the smallest doc_id."""
    return simhash.deduplicated(docs, copies.near_copies(docs))


@in_small_batches
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked and n_chars counted anew where one was."""
    found = secrets.scan(docs, secrets.network(), [_row(docs)])
    masked, kind = F.size("spans") > 0, docs.schema["n_chars"].dataType
    new = {"text": F.col("clean"), "n_chars": F.when(masked, F.char_length("clean").cast(kind)).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes."""
    return mixing.mixed_documents(docs).select(*[F.col("row")[c].alias(c) for c in docs.columns])


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their sequence and offset."""
    return packing.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL has no language model, character network or tokenizer; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
