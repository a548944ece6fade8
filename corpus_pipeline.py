"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what it keeps.  Every stage's
result is written to the shared folder and read back as the next stage's documents, so a lost executor never costs
more than one stage.  All stages but the last return the columns of ``documents``.

Defined cases: each operator's docstring; empty tables pass through as empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from podium.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from podium.llm.shared import Scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field rates as good."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return near_dedup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages that make up a twentieth of their words."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", decontaminate_stage),
    ("packing", packing_stage),
]

#: The classifier, the groups and the packing are beyond SQL; tests/llm holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    tmp = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        last = docs
        with Scratch.passing(spark):  # a stage's own tables go when its result is written
            docs = tmp.write(stage(spark, docs, sf_dir))
        if k:
            tmp.drop(last)
    return docs
