"""Documents to training data: reject low quality, drop repeated lines, keep one of each group of
near copies, mix the sources to their weights, encode to pieces.

Every stage takes what the one before kept, written as Parquet and read again; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from carelens.llm.common import documents
from carelens.llm.op01_mixing import mix_documents
from carelens.llm.op04_classifier import reject_low
from carelens.llm.op05_lines import dedup_lines
from carelens.llm.op08_near import keep_first
from carelens.llm.op10_pieces import encoded
from carelens.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_low(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return mix_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mixing", mixing), ("pieces", encoding)]
#: Hashing, the trained classifier and the tokenizer have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what passes between two is a Parquet table in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
