"""From raw documents to packed training sequences: five stages, each on all that its predecessor kept.

1. ``language_id``: documents in which no language can be recognised go.
2. ``near_duplicates``: one document of each group of near copies stays.
3. ``decontamination``: documents that hold a benchmark item go.
4. ``secrets``: every secret is replaced in the text; all documents stay.
5. ``packing``: documents become the pieces of training sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from labelloom import scale
from labelloom.llm import bagminhash, decontam, langid, packing, secret_scan


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packed)]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scale.shared_folder(spark)}/labelloom/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
