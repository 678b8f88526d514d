"""Registered queries of the operators: (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.common import table
from vantage.llm.op1_language import identify
from vantage.llm.op10_order_minhash import classes as near_duplicate_classes
from vantage.llm.op11_hard_negatives import mine
from vantage.llm.op11_hard_negatives import oracle as negatives_oracle
from vantage.llm.op12_periodic_runs import digests as run_digests
from vantage.llm.op12_periodic_runs import periodic_runs, with_planted_period
from vantage.llm.op13_byte_bpe import Vocabulary, round_trip
from vantage.llm.op13_byte_bpe import digests as id_digests
from vantage.llm.op2_token_files import token_index
from vantage.llm.op3_decontaminate import find_leaks
from vantage.llm.op4_mixing import mix
from vantage.llm.op4_mixing import oracle as mixing_oracle
from vantage.llm.op5_suffix_dedup import remove_repeats
from vantage.llm.op6_sharding import shard_documents
from vantage.llm.op7_vantage_point import nearest
from vantage.llm.op8_licenses import oracle as license_oracle
from vantage.llm.op8_licenses import scan
from vantage.llm.op9_sentence_spans import remove_spans


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), sample_docs=400)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8)


# The mixing run's tree: the first source is the web crawl, the others are reference works or forums by number.
MIX_WEIGHTS = {"domain": {"web": 4, "reference": 5, "forum": 3}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}


def mix_domain() -> Column:
    number = F.regexp_extract("source", "^src([0-9]+)$", 1)
    return (F.when(F.col("source") == "src0", "web").when(number == "", "other")
            .when(F.substring(number, -1, 1).isin("1", "3", "5", "7", "9"), "reference").otherwise("forum"))


MIX_DOMAIN_SQL = """CASE WHEN source = 'src0' THEN 'web' WHEN regexp_extract(source, '^src([0-9]+)$', 1) = '' THEN 'other'
                       WHEN right(source, 1) IN ('1', '3', '5', '7', '9') THEN 'reference' ELSE 'forum' END"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), mix_domain(), MIX_WEIGHTS, budget_share=0.5, max_epochs=2, seed=11)
    return mixed.select("doc_id", F.col("_epoch").alias("epoch"), F.col("_domain").alias("domain"), "lang", "source",
                        F.col("_tokens").alias("n_tokens"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=8, seed=17)


def op7_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=1.0)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), threshold=0.8)


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_spans(table(spark, sf_dir, "documents"), run=3, min_words=12, piece=16, cuts="content")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), threshold=0.8)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    planted = docs.select("doc_id", with_planted_period(F.col("text"), F.col("doc_id")).alias("text"))
    return run_digests(periodic_runs(planted, ["doc_id"]))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return id_digests(round_trip(table(spark, sf_dir, "documents"), vocabulary))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it builds on this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_token_files": op2_token_files,
    "op3_decontaminate": op3_decontaminate,
    "op4_mixing": op4_mixing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sharding": op6_sharding,
    "op7_vantage_point": op7_vantage_point,
    "op8_licenses": op8_licenses,
    "op9_sentence_spans": op9_sentence_spans,
    "op10_order_minhash": op10_order_minhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_byte_bpe": op13_byte_bpe,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op4_mixing": mixing_oracle(MIX_DOMAIN_SQL, MIX_WEIGHTS, 0.5, 2, 11),
    "op8_licenses": license_oracle(),
    "op11_hard_negatives": negatives_oracle(),
}
