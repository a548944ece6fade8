"""Labelled samples for the classifiers: held-out rule and a bounded sample of documents with their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``."""
    return F.crc32(id_col.cast("string").cast("binary")) % mod


def sample(docs: DataFrame, labels: DataFrame, target: str, mod: int, held_out: int, limit: int) -> DataFrame:
    """(label, text) of at most ``limit`` labelled documents that are not held out, chosen by a hash of their id.

    Rows with a null id or label are left out; a document labelled twice takes the larger label.  ``limit`` rows of an
    id and a label are the proven bound of the broadcast."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
              .where(remainder(F.col("doc_id"), mod) != held_out)
              .groupBy("doc_id").agg(F.max(target).cast("double").alias("label"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(target)), "doc_id").limit(limit))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("label", "text")
