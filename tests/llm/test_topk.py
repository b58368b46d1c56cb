import math
import random

from anchorframe.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score double, v string"


def brute(rows, k=20):
    ok = {(i, tuple(math.floor(64 * x) for x in e)) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = set()
    for q in {i for i, _ in ok if i % 20 == 0}:
        best = {}
        for _, a in (r for r in ok if r[0] == q):
            for i, b in ok:
                if i != q:
                    best[i] = max(best.get(i, -(2**63)), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out |= {(q, n + 1, i, s) for n, (i, s) in enumerate(ranked)}
    return out


def check(spark, rows, k=20):
    df = spark.createDataFrame([(i, e, 1, 0.5, "x") for i, e in rows], SCHEMA)
    vectors = topk.quantised(df)
    got = [tuple(r) for r in topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k).select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, k)


def single(rng, d=6):
    return [float(x) for x in (rng.gauss(0, 0.4) for _ in range(d))]


def as_float(rows):
    import numpy as np

    return [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "PAGE", 8)
    monkeypatch.setattr(topk, "SHARD_ROWS", 150)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 10)
    rng = random.Random(5)
    same = single(rng)
    rows = [(i, single(rng)) for i in range(400)] + [(i, same) for i in range(400, 500)] + [(i, [0.0] * 6) for i in range(500, 520)]
    rows += [(520, None), (521, [1.0, None]), (522, [float("nan")] * 6), (523, [float("inf")] * 6), (None, same), (40, rows[40][1]), (60, single(rng)), (524, []), (540, [0.5, -0.5]), (600, single(rng, 9))]
    check(spark, as_float(rows))
    check(spark, as_float(rows[:7]), k=20)


def test_large_components(spark, monkeypatch):
    """Beyond what doubles multiply exactly, and beyond what a long holds."""
    monkeypatch.setattr(topk, "PAGE", 4)
    rng = random.Random(3)
    rows = [(i, single(rng)) for i in range(60)] + [(60, [3e7] + single(rng, 5)), (61, [-3e7] + single(rng, 5)), (62, [3e38] * 6), (80, [-3e38, 1e25, 1.0, 0.3, 0.0, 2.5e9]), (64, [1e17 / 3] * 6)]
    check(spark, as_float(rows))


def test_none(spark):
    check(spark, [])
    check(spark, [(1, [0.5])])
    check(spark, [(20, [0.5])])


def test_tree_agrees_with_products():
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(3000, 8)) * np.r_[20, 10, 5, 1, 1, 1, 1, 1])
    tree, ids = topk.MTree(x), np.arange(3000)
    for q in range(0, 3000, 100):
        rows, scores = tree.search(x[q], 20, ids, q)
        products = x @ x[q]
        order = [i for i in np.lexsort((ids, -products)) if i != q][:20]
        assert rows.tolist() == order and scores.tolist() == products[order].tolist()
