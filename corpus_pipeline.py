"""A training-corpus pipeline over the documents table.

Each stage takes all that the one before kept, is written as Parquet in the shared folder, and is read again by the next:
a lost executor costs at most the stage that runs.

Defined cases, in every stage: an empty table gives an empty table; texts of any length are taken whole; all but the last
stage return the columns they were given and look at doc_id and text only (n_chars follows a changed text).  What each does with
null texts, null and repeated ids is stated with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorframe.llm import bpe, decontam, pii, quality, simhash
from anchorframe.llm.common import table, written
from anchorframe.llm.queries import tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier scores under 0.3.

    A null text is scored as an empty one; null and repeated ids change nothing, each row is scored by its text.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (4-word SimHash, at most 4 bits) the smallest doc_id stays.

    Null texts are empty, and empty texts are one group.  Rows with a null doc_id stay.  Rows with one doc_id and different
    texts belong to the groups of their texts, each of which keeps a row; of rows equal in id and text one stays.
    """
    return simhash.one_of_each_group(docs, k=4, max_bits=4)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item (0.8 of its five-word shingles).

    Null and empty texts hold nothing.  Rows with a null doc_id cannot be named, and stay; rows that share an id go together.
    """
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts.  A null text stays null; every row stays, whatever its id."""
    return pii.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian, unsigned, 32 bits) of every text, with digests of them and of the decoded text.

    Null and empty texts have no ids; rows with a null or repeated doc_id each give a row.
    """
    coded = bpe.encode_decode(docs, tokenizer_file())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("simhash", one_of_each),
    ("decontamination", uncontaminated),
    ("pii", without_personal_data),
    ("bpe", encoded),
]

#: The classifier and the tokenizer cannot be written in SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
