"""The contract's queries over the training-data operators: each takes (spark, sf_dir) and returns the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, filter_audit, html_text, lines, mixing, quality, simhash, substring, suffix, topk, toxicity, warc
from .common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), bits=4, width=4)


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeated_substrings(table(spark, sf_dir, "documents"), window=20, start=5).drop("kept")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeated_bytes(table(spark, sf_dir, "documents"), length=50).drop("kept")


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, one_in=20).drop("items", "spans", "clean")


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(table(spark, sf_dir, "pages"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_topk": op1_topk,
        "op2_simhash": op2_simhash,
        "op3_substring": op3_substring,
        "op4_html": op4_html,
        "op5_quality": op5_quality,
        "op6_toxicity": op6_toxicity,
        "op7_lines": op7_lines,
        "op8_mixing": op8_mixing,
        "op9_suffix": op9_suffix,
        "op10_decontam": op10_decontam,
        "op11_audit": op11_audit,
        "op12_warc": op12_warc,
        "op13_divergence": op13_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": topk.ORACLE,
        "op3_substring": substring.ORACLE,
        "op7_lines": lines.ORACLE,
        "op8_mixing": mixing.oracle(),
        "op9_suffix": suffix.ORACLE,
        "op10_decontam": decontam.oracle(),
        "op11_audit": filter_audit.ORACLE,
        "op12_warc": warc.ORACLE,
        "op13_divergence": divergence.ORACLE,
    }
