"""Corpus pipeline: STAGES applied one after the other to the table documents.

Every stage reads what its predecessor wrote, works on all of it and takes effect: toxic documents go, one document of each
group of near-duplicates stays (that of the least doc_id), benchmark passages are cut out (documents that consist
mostly of them go), secrets are masked, and the last stage encodes the texts and checks that they decode to the same bytes.
Null and empty texts pass every stage; rows of one doc_id are one document and stay or go together; rows without a doc_id
are documents of their own.  SQL can't express the trained stages, so there is no oracle; tests hold them against brute force.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import bpe, decontaminate, ngramjoin, secretscan, toxicity
from tickframe.llm.queries import vocabulary
from tickframe.llm.shared import bounded
from tickframe.session import checkpoint_dir

ORACLE_SQL = None
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _recounted(docs: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The changed documents, n_chars less what was cut; documents that stay as they were keep their n_chars."""
    size = F.coalesce(F.length("text"), F.lit(0))
    after = change(docs.withColumn("_before", size))
    return after.withColumn("n_chars", (F.col("n_chars") + size - F.col("_before")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _short_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch: texts are long, and the JVM and the Python workers of an executor each hold batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep_text=True).where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    groups = ngramjoin.link_components(docs)
    others = groups.where("doc_id <> component_id").select("doc_id").distinct().checkpoint()
    return docs.join(bounded(others), "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    return _recounted(docs, lambda d: decontaminate.clean(d, _table(spark, sf_dir, "benchmark")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(docs, secretscan.redact)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _short_batches(spark)
    return bpe.encode(docs, vocabulary()).drop("text", "token_ends")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_duplicates), ("decontamination", decontaminated),
    ("secret_scan", without_secrets), ("byte_bpe", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what stands between two stages is a Parquet table in the shared folder."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}_{name}")
            docs = spark.read.parquet(f"{folder}/{k}_{name}")
    return docs
