"""A corpus made ready for training: five stages, each written and read again before the next.

Near-duplicate decisions take shingles of five words and a similarity of 0.8 or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from actionwise.llm import decontaminate, jaccard, mixing, quality
from actionwise.llm.catalog import scan, tokenizer_path
from actionwise.llm.tokens import written_report
from actionwise.sources.tables import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the given table's labels, doesn't reject."""
    return quality.keep_good(docs, scan(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates."""
    return jaccard.keep_one_of_each(docs, size=5, percent=80)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, scan(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document drawn twice stands there twice."""
    return mixing.mixed_documents(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what reading them back shows: doc_id, start, n_tokens, ids_crc32."""
    return written_report(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", clean_of_benchmark),
    ("mixing", mix),
    ("tokens", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


# the classifier and the tokenizer can't be said in SQL: tests hold the stages against plain versions
ORACLE_SQL = None
