"""The dealt operators as registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spotframe.llm import brown
from spotframe.llm.attribution import token_counts
from spotframe.llm.common import documents
from spotframe.llm.contamination import OP12_SQL, decontaminate
from spotframe.llm.encoding import vocabulary
from spotframe.llm.exact_dedup import OP8_SQL, exact_dedup
from spotframe.llm.jaccard import jaccard_components
from spotframe.llm.langid import identify
from spotframe.llm.mixing import mix_sources
from spotframe.llm.multiset import fingerprints
from spotframe.llm.packing import pack_documents
from spotframe.llm.resampling import OP11_SQL, resample
from spotframe.llm.suffixes import remove_repeats
from spotframe.llm.token_files import token_files
from spotframe.llm.turn_trie import OP13_SQL, conversation_trie


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), width=50)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), words=4, percent=85)


def op4_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=1)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def op7_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), keep="largest")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=5, least_words=20)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), group=20, most=4)


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_suffix_dedup, op3_ngram_jaccard, op4_multiset_fingerprint, op5_token_files, op6_mix_sources, op7_brown_classes, op8_exact_dedup, op9_language_id, op10_token_counts, op11_importance_resampling, op12_decontamination, op13_conversation_trie)}
ORACLES = {"op8_exact_dedup": OP8_SQL, "op11_importance_resampling": OP11_SQL, "op12_decontamination": OP12_SQL, "op13_conversation_trie": OP13_SQL}
