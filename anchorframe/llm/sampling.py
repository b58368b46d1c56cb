"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(doc_id: str, parts: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.crc32(F.col(doc_id).cast("string")) % parts == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most `rows` labelled documents outside the held-out fold.

    The ids with the smallest hashes are taken, so the sample does not depend on the order or partitions of the input.
    Its ids are bounded by `rows`, hence the broadcast.  Ids that are null, or labelled both ways, are left out.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~in_fold("doc_id", parts, held_out))
             .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("y_max")).filter("y = y_max"))
    taken = known.select("doc_id", F.col("y").cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
