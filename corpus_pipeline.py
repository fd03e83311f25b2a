"""Corpus pipeline: five stages over `documents`, each written as Parquet and reread as the next one's input.

What a stage stages on its way is removed when its result is written, and a stage's result when the next one's is written.

Defined cases, for all stages: a null text is an empty one, a null doc_id is an id like others, repeated rows are judged one by one
(near_dedup keeps one of them), other columns stay to the last stage but one, and an empty table gives no rows.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from steadycare.llm import decontaminate, icws, length_buckets, quality, toxicity
from steadycare.sources.staging import remove_folder, shared_folder, stage, staging_run

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity classifier does not reject."""
    return toxicity.keep_civil(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return icws.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark window."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their length buckets and batches."""
    return length_buckets.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: Fitted trees and weighted sampling are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages for the documents of a folder."""
    docs = _table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, function in STAGES:
        with staging_run(spark):
            docs = stage(function(spark, docs, sf_dir), name, folder)
        if before:
            remove_folder(spark, f"{folder}/{before}")
        before = name
    return docs
