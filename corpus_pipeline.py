"""The corpus pipeline: five operators in a row, each on what its predecessor kept.

Toxic documents, exact copies (the largest ``doc_id`` stays), near copies (the smallest ``doc_id`` of a
component stays) and documents with benchmark passages go; what is left is encoded and decoded.
Rows leave by ``doc_id``: rows that share an id leave together, and a row with a null id can't be named and stays, but
as an exact copy: of equal texts a named row stays rather than one without a name. Null and empty texts are texts like
any other, very long ones are read whole, other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import round_trip
from tidemark.llm.common import materialise, table
from tidemark.llm.decontam import find_contamination
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.toxicity import score_toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rejected = score_toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 1")
    return docs.join(rejected.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs, keep="largest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = near_duplicates(docs).where("doc_id <> component_id")
    return docs.join(others.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hit = find_contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    return docs.join(hit.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_exact_copies),
    ("simhash", without_near_copies),
    ("decontaminate", without_benchmark),
    ("byte_bpe", encoded),
]

#: No SQL trains the classifier or encodes BPE; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
