"""Corpus pipeline: ordered stages over ``documents``, each built on one operator of ``dockflow.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet into the shared folder and reread as the next stage's ``docs``. All
stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import decontaminate as DC
from dockflow.llm import ngram_join as NJ
from dockflow.llm import quality_rules as QR
from dockflow.llm import sentencepiece_scan as SP
from dockflow.llm.frames import materialize, small_batches, table
from dockflow.plans.catalog import prepare


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: drop the documents that the base rule or the learned list rejects."""
    small_batches(spark)
    return QR.keep_good(docs, QR.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of documents linked by similar shingle sets the smallest id stays."""
    small_batches(spark)
    return NJ.one_per_component(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: drop the documents that hold a benchmark item."""
    small_batches(spark)
    return DC.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the training view of the kept documents: their ids, checked to decode to the text.

    The ids are written before they are decoded: in one stage each core would hold two Python workers, one with the
    encoder's tables and one that decodes."""
    small_batches(spark)
    ids = SP.encode(docs.select("doc_id", "lang", "source", "text", SP.plain_digest("text").alias("_plain")))
    back = SP.decode(materialize(ids.drop("text"), "token_ids"))
    return back.select("doc_id", "lang", "source", F.size("_ids").cast("long").alias("n_tokens"),
                       F.col("_ids").alias("ids"), (SP.plain_digest("_decoded") == F.col("_plain")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("sentencepiece", token_stage),
]

#: The learned list and the similarity joins are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
