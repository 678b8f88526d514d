"""The training-data pipeline: five stages from raw documents to token files.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's `docs`. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vantage.llm.common import materialize, table
from vantage.llm.op1_language import keep_identified
from vantage.llm.op2_token_files import token_index
from vantage.llm.op3_decontaminate import remove_leaks
from vantage.llm.op4_mixing import mix
from vantage.llm.op10_order_minhash import keep_representatives
from vantage.llm.queries import MIX_WEIGHTS, mix_domain


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that no language codes clearly best, go."""
    return keep_identified(docs, min_score=0.5, sample_docs=400)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest doc_id."""
    return keep_representatives(docs, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window similar to a benchmark item go."""
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"), threshold=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A share of 0.8 of the tokens, by the target weights; a document is taken once at most."""
    return mix(docs, mix_domain(), MIX_WEIGHTS, budget_share=0.8, max_epochs=1, seed=11).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; the result is their index, read back."""
    return token_index(docs)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]

#: Language models, alignments and tokenizers are beyond SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
