"""Fixtures of the corpus tests; a conftest of their own would hide that of the other tests."""

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """docs([(doc_id, text), ...]): a documents table, with columns whose names the operators use themselves."""

    def make(rows, parts=3):
        full = [(i, t, "en", None, None if t is None else len(t), "clash", -1.0, "x") for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", fp string, score double, label string").repartition(parts)

    return make


@pytest.fixture()
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def sf(spark, name, scale="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{scale}/{name}.parquet")
