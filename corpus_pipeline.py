"""The training-data pipeline over ``documents``: five stages, each one operator of ``wardline.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
The last returns them with the ids of the sampled pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import read, written
from wardline.llm.line_dedup import dedup_lines
from wardline.llm.mixing import mix_documents
from wardline.llm.order_minhash import drop_near_duplicates
from wardline.llm.piece_sampling import encode_documents
from wardline.llm.toxicity import drop_toxic
from wardline.session import apply_runtime_conf


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    apply_runtime_conf(spark)
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are deleted; n_chars follows the text."""
    apply_runtime_conf(spark)
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    apply_runtime_conf(spark)
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, kept or left out so that the sources meet their targets."""
    apply_runtime_conf(spark)
    return mix_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as sampled pieces (piece_ids); equal rows get equal ids."""
    apply_runtime_conf(spark)
    return encode_documents(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("minhash_near_dedup", near_dedup), ("mixing", mixing), ("sentencepiece", pieces)]

#: no SQL: the first stage is a fitted model, the third and fifth are no SQL either (tests/llm has their brute force)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
