"""Corpus pipeline: five operators of weblake.llm in a row over the ``documents`` table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's
rows as Parquet in the shared folder and reads them back for the next. All stages but the
last return the columns of ``documents``. Each stage learns and decides on all rows that
its predecessor kept; nulls, repeated rows and empty tables are handled by the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblake.llm import decontaminate, mixing, ngram_join, queries, token_files, toxicity
from weblake.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity score is below the cut (operator 4)."""
    labels = queries.table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, Jaccard 0.75 (operator 9)."""
    return ngram_join.one_per_component(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages, by 13-word windows (operator 3)."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their fitted rates until quality domains meet their weights; all are kept (operator 7)."""
    return mixing.mixed(docs, mixing.fit(docs, queries.quality_domains(spark, sf_dir), queries.MIX, least=1.0))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id shards of all documents, found again through the index and read back (operator 8)."""
    return token_files.token_files(docs, queries.bpe_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_to_weights),
    ("token_files", write_token_files),
]

ORACLE_SQL = None   # trained models, fitted rates and BPE ids have no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
