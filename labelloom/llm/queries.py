"""Registered queries of this subpackage, each over its whole table, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import (bagminhash, decontam, flat_graph, html_extract, langid, lattice_lm, licenses, packing,
                           lexical_search, secret_scan, sharding, token_alignment, warc)
from labelloom.llm.inputs import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents", "doc_id")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages", "page_id")


@query
def op1_license_scan(spark, folder):
    return licenses.scan(documents(spark, folder)).withColumn("dice", F.round("dice", 6))


TWINS["op1_license_scan"] = licenses.sql()


@query
def op2_lattice_lm(spark, folder):
    return lattice_lm.score(documents(spark, folder))


@query
def op3_secret_scan(spark, folder):
    return secret_scan.scan_documents(documents(spark, folder))


@query
def op4_warc(spark, folder):
    return warc.round_trip(pages(spark, folder))


@query
def op5_decontamination(spark, folder):
    return decontam.leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query
def op6_html_extraction(spark, folder):
    return html_extract.main_text(pages(spark, folder))


@query
def op7_language_id(spark, folder):
    return langid.identify(documents(spark, folder))


@query
def op8_embedding_dedup(spark, folder):
    return flat_graph.near_duplicates(table(spark, folder, "embeddings", "vec_id"))


@query
def op9_minhash_dedup(spark, folder):
    return bagminhash.classes(documents(spark, folder))


@query
def op10_packing(spark, folder):
    return packing.pack(documents(spark, folder))


@query
def op11_sharding(spark, folder):
    return sharding.assign(documents(spark, folder))


@query
def op13_lexical_search(spark, folder):
    return lexical_search.search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


TWINS["op13_lexical_search"] = lexical_search.sql()


@query
def op12_token_alignment(spark, folder):
    return token_alignment.align(documents(spark, folder))
