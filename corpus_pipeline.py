"""The training-data pipeline: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitespark.llm import exact_dedup, jaccard_join, langid, mixing, queries
from sitespark.llm.common import Work


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels teach; those without a letter go."""
    found = langid.keep_identified(docs, langid.fit_languages(docs.filter(langid.learns("doc_id", 3, 1))))
    return found.select(docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard 0.8 or more (op3_jaccard_join's contract has 3 and 90)."""
    return jaccard_join.keep_one_of_each(docs, width=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.bpe_digests(docs, known=120_000)  # workers also hold what the stages before have left


STAGES = [("language_id", language_stage), ("exact_dedup", exact_stage), ("jaccard_join", near_stage), ("mix", mix_stage), ("bpe", bpe_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read by the next."""
    work = Work(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        mark = len(Work.made)
        docs = work.save(name, stage(spark, docs, sf_dir))
        Work.remove_since(mark)  # the stage's own tables; its result is written
        if before:
            work.drop(before)
        before = name
    return docs


#: Suffix automata, shingle components and byte-pair merges are not SQL; tests/llm/test_pipeline_brute.py has the brute-force version.
ORACLE_SQL = None
