"""Queries over the given tables, and their expected results as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import scan as scan_table
from . import chains, decontaminate, jaccard, lines, middle, mixing, neighbours, packing, pages, periods, quality, suffixes, tokens
from .common import small_batches


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return scan_table(spark, sf_dir, name)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(scan(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.repeated_passages(scan(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(scan(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.without_repeats(scan(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.written_report(scan(spark, sf_dir, "documents"), tokenizer_path())


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document and how many of them go; the digest is that of what is left."""
    left = lines.without_repeats(scan(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(scan(spark, sf_dir, "documents"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(scan(spark, sf_dir, "documents"), size=4, percent=85)


def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.report(scan(spark, sf_dir, "documents"))


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(scan(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(scan(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracles() -> dict[str, str]:
    return {"op4_decontaminate": decontaminate.matches_sql(), "op9_mix": mixing.mix_sql(), "op11_middle": middle.report_sql()}
