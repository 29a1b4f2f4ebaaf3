"""A training corpus from ``documents``: five stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns the mix as (doc_id, domain, lang, source,
n_tokens, copies). Null texts are empty texts, empty tables give empty results,
and other columns of docs travel along unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairnflow.llm import decontam, lines, mixing, simhash, toxicity
from cairnflow.llm.common import Scratch, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores at 0.5 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 40 code points in at least 5 documents stay only in the largest doc_id; n_chars follows the text."""
    return lines.drop_common_lines(docs, min_chars=40, min_docs=5, length_col="n_chars")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of documents linked by a five-word shingle similarity of 0.8 or more the one with the smallest doc_id stays."""
    return simhash.one_of_each(docs, width=5, similarity=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one word in twenty inside benchmark windows go; the others stay as they are."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=13, one_in=20)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how often each document is read."""
    return mixing.mix_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]

#: The trained toxicity stage has no SQL form; tests/llm/test_pipeline.py holds the others against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
