"""A training-data pipeline over `documents`: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontam, jaccard, mixing, quality, token_file
from corpusmill.llm.common import read, written
from corpusmill.llm.registry import tokenizer_path

#: Shares of the tokens that the mixed corpus aims at.
WEIGHTS = {"clean": 0.87, "low": 0.03, "toxic": 0.10}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the compression classifier rejects."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents by their fitted rates; the token budget is the tokens there are."""
    return mixing.remix(docs, read(spark, sf_dir, "labels"), WEIGHTS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token file and return its digest, a row for each document."""
    return token_file.token_file(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_file", token_stage),
]

#: No stage but the join is expressible in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each result written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
