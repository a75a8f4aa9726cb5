"""The corpus pipeline: five stages from raw documents to packed token sequences.

Each stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.llm.contract import KEEP, WORD, table
from panelmill.llm.ordinal import keep_best
from panelmill.llm.packing import pack
from panelmill.llm.paragraphs import without_repeats
from panelmill.llm.quality import keep_good
from panelmill.llm.shared import discard, folders_made, new_folder
from panelmill.llm.simhash import keep_one

#: Tables that the last stage left in the shared folder; its result is written when the next one begins.
_left: list[str] = []


def stage(function):
    """A stage that first deletes what the one before needed only for itself."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _left)
        _left.clear()
        before = len(folders_made())
        try:
            return function(spark, docs, sf_dir)
        finally:
            _left.extend(folders_made()[before:])

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the learned thresholds keep."""
    return keep_good(docs)


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier fitted on all rated documents keeps."""
    return keep_best(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), KEEP)


@stage
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose four-word fingerprints are linked by at most four differing bits."""
    return keep_one(docs, radius=4, shingle=4)


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages, lines or runs of words, that an earlier one holds; n_chars follows the text."""
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return pack(docs, WORD)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

#: Hashing, fitted weights and tokens are beyond SQL; the tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for number, (_, function) in enumerate(STAGES):
        path = f"{folder}/{number}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
