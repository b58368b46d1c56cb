"""Histogram boosting against plain Python, and its scores against SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorframe.operators import boost as bo
from anchorframe.operators import models as md


def table(spark, n=400, seed=3, parts=3):
    rng = np.random.default_rng(seed)
    a, b, c = np.round(rng.normal(size=n), 2), rng.integers(0, 5, n).astype(float), rng.random(n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 * a + (b == 3))))).astype(float)
    v = 3 * a + np.where(b == 3, 5.0, 0.0) + rng.normal(scale=0.2, size=n)
    rows = [(i, None if rng.random() < 0.1 else float(a[i]), float("nan") if rng.random() < 0.1 else float(b[i]), float(c[i]), float(y[i]), float(v[i]), i % 3) for i in range(n)]
    schema = "id long, `a b` double, b double, c double, y double, v double, fold int"
    return rows, spark.createDataFrame(rows, schema).repartition(parts)


def plain(x, g, h, columns, depth, l2=1.0, min_child=1.0):
    """Greedy tree on bytes: [(column, cut, missing_left)] by node, and leaf weights."""
    nodes, leaves = {}, {}

    def part(rows, node, level):
        total = g[rows].sum(), h[rows].sum()
        if level == depth:
            leaves[node - 2**depth] = -total[0] / (total[1] + l2)
            return
        best = (bo.LEAST_GAIN, None)
        weight = lambda s: s[0] ** 2 / (s[1] + l2)
        for c in columns:
            for left_missing in (False, True):
                for cut in range(bo.MISSING - 1):
                    left = rows[(x[c][rows] <= cut) | (left_missing & (x[c][rows] == bo.MISSING))]
                    s = g[left].sum(), h[left].sum()
                    r = total[0] - s[0], total[1] - s[1]
                    gain = weight(s) + weight(r) - weight(total)
                    if s[1] >= min_child and r[1] >= min_child and gain > best[0] + 1e-12:
                        best = (gain, (c, cut, left_missing), left)
        nodes[node - 1] = best[1]
        left = rows if best[1] is None else best[2]
        part(left, 2 * node, level + 1)
        part(np.setdiff1d(rows, left), 2 * node + 1, level + 1)

    part(np.arange(len(g)), 1, 0)
    return nodes, leaves


@pytest.mark.parametrize("binary", [True, False])
def test_first_trees_are_the_greedy_ones(spark, binary):
    rows, df = table(spark, 150)
    target = "y" if binary else "v"
    s = bo.Boosting(rounds=1, depth=3, rate=0.3, row_share=1.0, column_share=1.0)
    grown = bo.grow(df, ["a b", "b", "c"], target, "id", binary, s, folds=3, block_rows=40)
    x = np.stack([bo.binned(np.array([np.nan if r[i] is None else r[i] for r in rows]), cut) for i, cut in zip((1, 2, 3), grown.cuts)])
    y = np.array([r[4 if binary else 5] for r in rows])
    fold = np.array([r[6] for r in rows])
    for m in range(4):
        kept = fold != m
        scores = np.full(kept.sum(), grown.start[m])
        g, h = bo.gradients(scores, (y[kept] - grown.middle) / grown.scale, binary)
        g, h = np.rint(g * bo.UNIT) / bo.UNIT, np.rint(h * bo.UNIT) / bo.UNIT
        nodes, leaves = plain(x[:, kept], g, h, [0, 1, 2], 3)
        t = grown.trees
        for node, split in nodes.items():
            got = None if t.column[0, m, node] < 0 else (t.column[0, m, node], t.cut[0, m, node], bool(t.missing_left[0, m, node]))
            assert got == split, (m, node)
        np.testing.assert_allclose(t.leaf[0, m], [0.3 * leaves[i] for i in range(8)], atol=1e-12)


def test_partitions_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(bo, "SHIPPED_ROUNDS", 3)
    monkeypatch.setattr(bo, "REMEMBERED", 1)  # most scores are made again from the trees
    _, df = table(spark, 300)
    s = bo.Boosting(rounds=8, depth=3, rate=0.2)
    one = bo.grow(df.coalesce(1), ["a b", "b", "c"], "y", "id", True, s, 3)  # a block, its models apart
    many = bo.grow(df.repartition(7), ["a b", "b", "c"], "y", "id", True, s, 3, block_rows=17)
    for p, q in zip(one.trees.parts(), many.trees.parts()):
        np.testing.assert_array_equal(p, q)


def test_a_fold_model_does_not_see_its_fold(spark):
    _, df = table(spark, 300)
    s = bo.Boosting(rounds=4, depth=2, rate=0.2)
    wild = df.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    a, b = (bo.grow(d, ["a b", "c"], "y", "id", True, s, 3).trees for d in (df, wild))
    np.testing.assert_array_equal(a.leaf[:, 1], b.leaf[:, 1])
    assert (a.leaf[:, 0] != b.leaf[:, 0]).any()


def test_predictions_and_importances(spark):
    rows, df = table(spark, 500)
    grown = bo.grow(df, ["a b", "b", "c"], "v", "id", False, bo.Boosting(rounds=60, depth=3, rate=0.2), 3)
    seen = {r["key"]: r for r in grown.predictions().collect()}
    assert {i: (r["fold"], r["label"]) for i, r in seen.items()} == {r[0]: (r[6], r[5]) for r in rows}
    for r in grown.predict(df).collect():
        assert r["prediction"] == pytest.approx(seen[r["id"]]["prediction"], abs=1e-9)
    known = [r for r in rows if r[1] is not None and r[2] == r[2]]
    miss = np.mean([abs(seen[r[0]]["prediction"] - r[5]) for r in known])
    held = np.mean([abs(seen[r[0]]["cv_prediction"] - r[5]) for r in known])
    assert miss < held < 1.0
    names = grown.importances()
    assert {n for n, _ in names} == {"a b", "b", "c"} and sum(v for _, v in names) == pytest.approx(1) and names[-1][0] == "c"


def test_scores_are_those_of_sql(spark):
    _, df = table(spark, 600)
    small = bo.Boosting(rounds=6, depth=3, rate=0.3)
    clf, reg = md.boosted_classifier(df, ["a b", "b"], "y", "id", small, 4), md.boosted_regressor(df, ["a b", "b"], "v", "id", small, 4)
    p, q = clf.predictions.toPandas(), reg.predictions.toPandas()  # noqa: F841
    con = duckdb.connect()
    auc = con.execute("SELECT a.fold, avg(CASE WHEN a.cv_prediction > b.cv_prediction THEN 1.0 WHEN a.cv_prediction = b.cv_prediction THEN 0.5 ELSE 0 END) "
                      "FROM p a JOIN p b ON a.fold = b.fold AND a.label = 1 AND b.label = 0 GROUP BY 1 ORDER BY 1").fetchall()
    ap = con.execute("""WITH s AS (SELECT fold, cv_prediction AS place, sum(label) AS h, count(*) AS n FROM p GROUP BY 1, 2),
      w AS (SELECT fold, h, sum(h) OVER o / sum(n) OVER o AS precise FROM s WINDOW o AS (PARTITION BY fold ORDER BY place DESC))
      SELECT fold, sum(h * precise) / sum(h) FROM w GROUP BY 1 ORDER BY 1""").fetchall()
    err = con.execute("SELECT fold, avg(abs(label - cv_prediction)), 1 - sum((label - cv_prediction) ** 2) / (var_pop(label) * count(*)) FROM q GROUP BY 1 ORDER BY 1").fetchall()
    got = {r["fold"]: r for r in clf.by_fold.collect()}
    assert len(got) == 4
    for (fold, want), (_, precision) in zip(auc, ap):
        assert got[fold]["roc_auc"] == pytest.approx(want) and got[fold]["average_precision"] == pytest.approx(precision)
    for r in reg.by_fold.collect():
        assert (r["fold"], pytest.approx(r["mae"]), pytest.approx(r["r2"])) in [tuple(e) for e in err]
    assert clf.scores["roc_auc"][0] == pytest.approx(np.mean([w for _, w in auc])) and clf.scores["roc_auc"][0] > 0.7


def test_defined_cases(spark):
    tiny = bo.Boosting(rounds=2, depth=2)
    df = spark.createDataFrame([(i, 1.0, None, float(i % 2), None if i == 3 else 1.0) for i in range(12)], "id long, flat double, none double, y double, one double")
    r = md.boosted_classifier(df, ["flat", "none"], "y", "id", tiny, 3)  # nothing to split on
    assert {(x["feature"], x["importance"]) for x in r.importances.collect()} == {("flat", 0.0), ("none", 0.0)}
    assert all(x["prediction"] == pytest.approx(0.5, abs=0.1) for x in r.predictions.collect())
    one = md.boosted_classifier(df, ["y"], "one", "id", tiny, 3)  # one class, and a row without a target
    assert one.predictions.count() == 11 and np.isnan(one.scores["roc_auc"][0])
    with pytest.raises(ValueError):
        md.boosted_classifier(df, ["y"], "id", "id", tiny, 3)
    with pytest.raises(ValueError):
        md.boosted_regressor(df.limit(0), ["y"], "one", "id", tiny, 3)


def test_sums_of_many_blocks_stay_on_executors(spark, monkeypatch):
    """Splits reach the driver, not the sums they are picked from."""
    import pickle

    from pyspark import RDD
    from pyspark.sql import functions as F

    sent, collect, reduce = [], RDD.collect, RDD.treeReduce
    monkeypatch.setattr(RDD, "collect", lambda self: [sent.append(len(pickle.dumps(r))) or r for r in collect(self)])
    monkeypatch.setattr(RDD, "treeReduce", lambda self, f, depth=2: [sent.append(len(pickle.dumps(r))) or r for r in [reduce(self, f, depth)]][0])
    df = spark.range(900).select(F.col("id").alias("k"), F.rand(1).alias("x"), F.rand(2).alias("z"), (F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 3).cast("int").alias("fold"))
    bo.grow(df, ["x", "z"], "y", "k", True, bo.Boosting(rounds=3, depth=3), 3, block_rows=40)
    assert sent and sum(sent) < 3 * 3 * 4 * 2_000


def test_models_of_more_rows_than_a_block_grow_apart(spark, monkeypatch):
    """No job a tree level for 300,000 rows, and the same trees as with one."""
    df = spark.range(300_000, numPartitions=4).select(F.col("id").alias("k"), F.rand(1).alias("x"), F.rand(2).alias("z"), (F.rand(3) < 0.3).cast("double").alias("y"), (F.col("id") % 2).cast("int").alias("fold")).checkpoint()
    s = bo.Boosting(rounds=2, depth=3, rate=0.3)
    for target, binary in (("y", True), ("x", False)):
        many = bo.grow(df, ["x", "z"], target, "k", binary, s, 2, block_rows=90_000)
        with monkeypatch.context() as patched:
            patched.setattr(bo, "_grow_together", None)
            apart = bo.grow(df, ["x", "z"], target, "k", binary, s, 2)
        assert apart.rows.count() > 1  # predictions are spread all the same
        for p, q in zip(many.trees.parts(), apart.trees.parts()):
            np.testing.assert_array_equal(p, q)
        assert apart.predictions().exceptAll(many.predictions()).count() == 0


def test_more_than_a_million_rows_grow_apart(spark, monkeypatch):
    """Without a job for every level; a task goes through its rows piece by piece, and the pieces do not matter."""
    monkeypatch.setattr(bo, "_grow_together", lambda *a: pytest.fail("a job for every level"))
    df = spark.range(0, 1_100_000, 1, 4).selectExpr("id", "cast(id % 100 as double) as x", "cast(id % 100 >= 30 as double) as y", "cast(id % 2 as int) as fold")
    g = bo.grow(df, ["x"], "y", "id", True, bo.Boosting(rounds=2, depth=1, row_share=1.0, column_share=1.0), 2)
    assert g.trees.gain.shape == (2, 3, 1) and (g.trees.gain > 0).all()
    p = g.predictions().groupBy("label").agg(F.min("prediction").alias("lo"), F.max("prediction").alias("hi")).orderBy("label").collect()
    assert p[0].hi < p[1].lo


@pytest.mark.parametrize("binary", [True, False])
def test_a_task_holds_few_bytes_a_row(spark, monkeypatch, binary):
    n, s = 150_000, bo.Boosting(rounds=1)
    df = spark.range(0, n, 1, 2).selectExpr("id", *[f"cast(pmod(xxhash64(id, {i}), 200) as double) as x{i}" for i in range(4)], "cast(id % 3 = 0 as double) as y", "cast(id % 5 as int) as fold")
    cuts = [list(map(float, range(199)))] * 4
    packed = [r["data"] for r in bo.blocks(df, [f"x{i}" for i in range(4)], "y", "id", cuts, n)[0].collect()]

    def sums():
        states = [x for p in packed for x in bo.new_states(p, np.zeros(1), 0.0, 1.0)]
        growing = tuple(p[0] for p in bo.no_trees(1, 1, s.depth).parts()[:3])
        return states, bo.block_sums(states, s, 0, [2], 4, 0, growing, np.ones((1, 4), bool), binary)

    states, whole = sums()
    arrays = lambda v: [v] if isinstance(v, np.ndarray) else [a for x in v for a in arrays(x)] if isinstance(v, list) else []
    assert sum(a.nbytes for state in states for v in state.values() for a in arrays(v)) < 60 * n
    monkeypatch.setattr(bo, "CHUNK_ROWS", 1000)
    pieces, same = sums()
    assert len(pieces) >= 150 > len(states) and (same == whole).all()
