import random
from math import floor, isfinite

import numpy as np
import pytest
from compare import differences, duck
from llm_data import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from anchorframe.llm import negatives as ng

ROWS = "vec_id long, embedding array<float>, label int, v string, score long, anchor_id string"


@pytest.fixture()
def vectors(spark):
    """vectors([(vec_id, embedding, label)]), with columns whose names the operator uses itself."""
    return lambda rows: spark.createDataFrame([(*r, "clash", -1, "x") for r in rows], ROWS).repartition(3)


def brute(rows, every=3, positives=5, negatives=5, low=80, high=100):
    kept = {}
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and isfinite(x) for x in v):
            whole = [floor(256 * float(np.float32(x))) for x in v]
            kept[i] = min(kept.get(i, (label, whole)), (label, whole))
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        dot = {i: max(-2**63, min(2**63 - 1, sum(p * q for p, q in zip(v, w)))) for i, (_, w) in kept.items() if i != a}
        order = sorted(dot, key=lambda i: (-dot[i], i))
        for p in [i for i in order if kept[i][0] == label][:positives]:
            inside = [i for i in order if kept[i][0] != label and low * dot[p] <= 100 * dot[i] <= high * dot[p]]
            out += [(a, p, r, i, dot[p], dot[i]) for r, i in enumerate(inside[:negatives], 1)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def run(vectors, rows, codes=None, **settings):
    return got(ng.hard_negatives(ng.usable(vectors(rows), F.col("label")), F.col("vec_id") % 3 == 0, codes=codes, **settings))


@pytest.mark.parametrize("codes, first", [(1, 8), (4, 1), (9, 2)])
def test_against_brute_force(monkeypatch, vectors, codes, first):
    monkeypatch.setattr(ng, "FIRST_CELLS", first)
    monkeypatch.setattr(ng, "BLOCK_ROWS", 20)
    monkeypatch.setattr(ng, "PACK_ANCHORS", 7)
    rng = np.random.default_rng(codes)
    middle = rng.normal(0, 1, (6, 8))
    rows = [(i, (middle[i % 6] + rng.normal(0, 0.3, 8)).tolist(), int(rng.integers(0, 4))) for i in range(150)]
    assert run(vectors, rows, codes) == brute(rows)


def test_defined_cases(vectors):
    rng = random.Random(4)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, 1.0]) for _ in range(rng.choice([3, 4]))], rng.choice([0, 1])) for i in range(60)]  # ties, short vectors
    rows += [(200 + i, [1.0, 1.0, 0.5, 0.0], i % 2) for i in range(30)]  # copies
    rows += [(300, None, 1), (301, [1.0, None], 1), (302, [nan, 1.0], 1), (303, [inf, 1.0], 0), (304, [1.0, 1.0], None), (None, [1.0, 1.0], 0), (306, [], 1)]
    rows += [(3, rows[3][1], rows[3][2]), (6, [9.0, 9.0], 1), (6, [8.0, 8.0], 0)]  # repeated ids
    assert run(vectors, rows, 3) == brute(rows)
    assert run(vectors, rows, 3, positives=2, negatives=50, low=-50, high=250) == brute(rows, positives=2, negatives=50, low=-50, high=250)


def test_large_components(vectors):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1.0, -3e7, 2.5e9, 1e15, 3e38, -3e38, 1e-30]) * rng.choice([1, 0.37]) for _ in range(4)], i % 2) for i in range(40)]
    assert run(vectors, rows) == brute(rows)


def test_no_rows_and_nobody_to_ask(vectors):
    assert run(vectors, []) == []
    assert run(vectors, [(3, [1.0, 2.0], 0)]) == []
    assert run(vectors, [(i, [1.0 + i, 2.0], 0) for i in range(10)]) == []  # one label only
    assert run(vectors, [(i, [1.0 + i, 2.0], i) for i in range(10)]) == []  # no positives


def test_cells_are_left_out(spark, vectors):
    """Where groups lie apart, bounds rule out most cells, and nothing is lost by it."""
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 8, (12, 6))
    rows = [(i, (middle[i % 12] + rng.normal(0, 0.05, 6)).tolist(), i % 5) for i in range(600)]
    held = ng.written(ng.usable(vectors(rows), F.col("label")), "test")
    index, cells, width = ng.indexed(held, 12)
    shared = spark.sparkContext.broadcast((index.centres, index.cells, index.half))
    nothing = F.array().cast("array<long>")
    anchors = held.filter("vec_id % 3 = 0").select(F.col("vec_id").alias("anchor_id"), "label", "v", F.lit(None).cast("long").alias("need"), nothing.alias("lows"), nothing.alias("highs"))
    own = ng.search(anchors.drop("need"), index, cells, width, 5, True)
    need = own.filter("rank = 5").select("anchor_id", F.col("score").alias("need"))
    asks = ng.asked(anchors.drop("need").join(need, "anchor_id").select("anchor_id", "label", "v", "need", "lows", "highs"), shared, width, 0, 10**6)
    import pyarrow as pa

    visits = sum(b.num_rows for r in asks.filter("block >= 0").collect() for b in pa.ipc.open_stream(r.anchors))
    assert visits < 0.3 * 200 * len(index.cells)


def test_query_is_the_sql(spark):
    df = entry_points.queries()["op12_hard_negatives"](spark, SF_DIR)
    assert differences(df, duck(SF_DIR), entry_points.oracle_sql()["op12_hard_negatives"]) is None and df.count()
