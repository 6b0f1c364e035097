"""Corpus pipeline: language, exact copies, near copies, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.llm import decontaminate, exact_dedup, langid, packing, simhash
from obsledger.llm.common import drop_staged, scratch, stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those of language ``und`` are rejected: null or empty texts and texts
    without a letter. All others stay, whatever the language, since the pipeline takes all that the corpus names.

    Profiles are learned from the rows of ``docs`` that name a language; where none does, letters alone decide.
    Null ids, repeated rows and further columns pass as they are; no rows give none.
    """
    profiles = langid.fit_profiles(docs)
    if not profiles:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, profiles, names=("_stage_lang", "_stage_score"))
    return found.where(F.col("_stage_lang") != langid.UNKNOWN).drop("_stage_lang", "_stage_score")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest as written, then the least id (null last), then the least
    hash of all columns. Null text counts as empty; no rows give none."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the least id, null last.
    Rows alike in id and text stay or go together; no rows give none."""
    return simhash.drop_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found. Null and empty texts hold none; repeated rows stay or go
    together; an empty benchmark takes nothing."""
    return decontaminate.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in token-budget batches, by doc_id; an empty text keeps one sequence without tokens; ties in the
    order are settled by id, piece and size."""
    return packing.pack(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", leaks), ("pack", pack)]

#: Language profiles and near-copy components are beyond SQL; ``tests/llm/test_pipeline.py`` holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        with scratch() as keep:
            before, docs = docs, keep(stage(step(spark, docs, sf_dir), f"pipeline-{name}"))
        drop_staged(before)  # written on: nothing reads it again
    return STAGES[-1][1](spark, docs, sf_dir)
