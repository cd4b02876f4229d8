"""From raw documents to packed training sequences, in five stages.

Every stage takes the documents its predecessor kept, as a table, and returns them with the same
columns; the last one returns the packed pieces. A stage is written as Parquet and read again
before the next, so a lost executor costs at most the stage that runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stakeline.llm import decontamination, packing, quality_model, secret_scan, simhash
from stakeline.llm.common import prepare, read
from stakeline.sources.sinks import keep, stage_table, staging


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    It learns from the labels of the documents at hand. A row is judged by its own text, so rows
    that share an id are kept or dropped each for itself.
    """
    model = quality_model.train(docs, read(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Of repeated rows with that id one stays. A group of null ids only keeps one as well.
    """
    prepare(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their text replaced by its kind.

    ``n_chars`` follows the text where it changes.
    """
    prepare(spark)
    return secret_scan.redact_secrets(docs, length="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# SQL has neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    What a stage stages goes when it ends, what it returns when all have; the result is kept
    outside the folder of staged tables.
    """
    docs = read(spark, sf_dir, "documents")
    with staging(spark) as stages:
        for i, (_, stage) in enumerate(STAGES[:-1]):
            with staging(spark):
                docs = stage_table(stage(spark, docs, sf_dir), f"stage-{i}", stages)
        return keep(STAGES[-1][1](spark, docs, sf_dir), "packed")
