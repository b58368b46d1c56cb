"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorframe.llm import bpe, decontam, licenses, negatives, pages, pii, prefixes, quality, resample, simhash, suffix, topk, toxicity
from anchorframe.llm.common import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op3_topk": topk.SQL, "op9_decontamination": decontam.SQL, "op11_resampling": resample.SQL, "op12_hard_negatives": negatives.SQL}


def tokenizer_file() -> str:
    """The public byte-level vocabulary; another file can be named in CORPUS_TOKENIZER."""
    if "CORPUS_TOKENIZER" in os.environ:
        return os.environ["CORPUS_TOKENIZER"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_file() -> str:
    """The public ranks for many languages; another file can be named in CORPUS_RANKS."""
    if "CORPUS_RANKS" in os.environ:
        return os.environ["CORPUS_RANKS"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, max_bits=4)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = found.withColumn("base", F.filter("spans", lambda s: s["base"]))
    kinds = F.col("base")["kind"]
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return base.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


@query
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = written(topk.quantised(table(spark, sf_dir, "embeddings")), "vectors")  # read for the shards, the blocks and their counts
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@query
def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


@query
def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.without_repeats(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = prefixes.encode_decode(table(spark, sf_dir, "documents"), ranks_file())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.usable(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)
