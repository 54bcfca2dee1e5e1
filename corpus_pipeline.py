"""Corpus pipeline: language, exact copies, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents; decisions take effect: rows that
a stage rejects are gone, and rows that the mix repeats are there several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spotframe.llm.common import documents, shared_path
from spotframe.llm.encoding import vocabulary
from spotframe.llm.exact_dedup import exact_dedup
from spotframe.llm.jaccard import jaccard_components
from spotframe.llm.langid import identify
from spotframe.llm.mixing import mix_sources
from spotframe.llm.packing import pack_documents

#: Below this posterior probability no language is certain enough to keep a document.
LEAST_SCORE = 0.5


def _chosen(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of docs whose id, null included, is in decisions (doc_id). Rows repeating an id share its decision."""
    wanted = decisions.select(F.col("doc_id").alias("_chosen"))
    return docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_chosen")), "left_semi").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a recognised language stay: rejected are null texts, texts without a letter, and uncertain ones."""
    found = identify(docs, vocabulary("piece_bpe_32k.model"), keep_columns=True, prefix="_found_")
    return found.where((F.col("_found_lang_pred") != "und") & (F.col("_found_score") >= LEAST_SCORE)).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to the case of A-Z) the row with the smallest id stays."""
    return _chosen(docs, exact_dedup(docs, keep="smallest").where("kept").select("doc_id"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more the smallest id stays."""
    groups = jaccard_components(docs, words=5, percent=80)
    return _chosen(docs, groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, twice or three times. Rows repeating an id are taken alike."""
    copies = mix_sources(docs).where("copies > 0").groupBy(F.col("doc_id").alias("_taken")).agg(F.max("copies").alias("_copies"))
    taken = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("_taken")))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of each document go: sequences of 2048 ids."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("source_mix", source_mix),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; what lies between is written to the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The token stages have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
