import math

import numpy as np
import pandas as pd
import pytest

from anchorframe.functions.pvalues import chi_square_tail, normal_two_sided
from anchorframe.operators import cluster as cl
from anchorframe.operators import models as md
from anchorframe.operators import stats as st
from anchorframe.plans.analysis import model_outcomes, outcome_associations, stay_associations


def test_tails():
    # textbook 5% and 1% points
    for x, df, p in [(3.841458821, 1, 0.05), (5.991464547, 2, 0.05), (7.814727903, 3, 0.05), (9.487729037, 4, 0.05), (13.27670414, 4, 0.01), (11.07049769, 5, 0.05)]:
        assert chi_square_tail(x, df) == pytest.approx(p, rel=1e-6)
    assert chi_square_tail(0.0, 3) == 1.0 and math.isnan(chi_square_tail(float("nan"), 2))
    assert normal_two_sided(1.959963985) == pytest.approx(0.05, rel=1e-6)


def brute_kruskal(groups):
    x = np.concatenate(groups)
    order = np.sort(x)
    rank = np.array([(np.searchsorted(order, v) + np.searchsorted(order, v, "right") + 1) / 2 for v in x])
    n, parts, i = len(x), [], 0
    for g in groups:
        parts.append(rank[i : i + len(g)].sum() ** 2 / len(g))
        i += len(g)
    _, t = np.unique(x, return_counts=True)
    h = 12 / (n * (n + 1)) * sum(parts) - 3 * (n + 1)
    return h / (1 - (t**3 - t).sum() / (n**3 - n))


def test_kruskal_with_ties_and_constant_groups(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 6, 40).astype(float), rng.integers(1, 9, 30).astype(float)
    smooth = rng.normal(size=70)
    rows = [(int(i >= 40), float(v), float(smooth[i]), 1.0 if i < 40 else float(i)) for i, v in enumerate(np.concatenate([a, b]))]
    df = spark.createDataFrame(rows, "cluster int, x double, s double, flat double")
    got = {r["feature"]: r for r in st.kruskal_wallis(df, ["x", "s", "flat"], min_effect=None).collect()}
    assert set(got) == {"x", "s"}  # flat is constant in cluster 0
    assert got["x"]["H"] == pytest.approx(brute_kruskal([a, b]))
    assert got["s"]["H"] == pytest.approx(brute_kruskal([smooth[:40], smooth[40:]]))
    assert got["x"]["p"] == pytest.approx(chi_square_tail(got["x"]["H"], 1))
    assert got["x"]["eta_sq"] == pytest.approx((got["x"]["H"] - 1) / 68)


def test_multiple_testing(spark):
    df = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.5), ("e", None)], "feature string, p double")
    q = {r["feature"]: r["q"] for r in st.benjamini_hochberg(df, "p", "q").collect()}
    assert q["e"] is None
    assert {k: round(v, 6) for k, v in q.items() if v is not None} == {"a": 0.04, "b": 0.053333, "c": 0.053333, "d": 0.5}
    h = {r["feature"]: round(r["h"], 6) for r in st.holm(df.dropna().selectExpr("1 AS fam", "*"), ["fam"], "p", "h").collect()}
    assert h == {"a": 0.04, "b": 0.09, "c": 0.09, "d": 0.5}


def test_silhouette_and_blocks(spark):
    rng = np.random.default_rng(5)
    pts = np.concatenate([rng.normal(0, 1, (30, 3)), rng.normal(3, 1, (25, 3)), [[9.0, 9, 9]]])
    lab = np.array([0] * 30 + [1] * 25 + [2])
    df = spark.createDataFrame([(i, pts[i].tolist(), int(lab[i])) for i in range(len(pts))], "id long, vec array<double>, cluster int")
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))

    def expected(dist):
        out = []
        for i in range(len(pts)):
            if (lab == lab[i]).sum() == 1:
                out.append(0.0)
                continue
            a = dist[i][lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1)
            b = min(dist[i][lab == c].mean() for c in set(lab) - {lab[i]})
            out.append((b - a) / max(a, b))
        return out

    for block in (7, 2048):
        got = {r["id"]: r["silhouette"] for r in st.silhouette(df, block).collect()}
        np.testing.assert_allclose([got[i] for i in range(len(pts))], expected(d), atol=1e-9)
    got = {r["id"]: r["silhouette"] for r in st.silhouette_squared(df).collect()}
    np.testing.assert_allclose([got[i] for i in range(len(pts))], expected(d**2), atol=1e-9)


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(11)
    n = 300
    x1, x2 = rng.normal(size=n), rng.integers(0, 2, n).astype(float) * 3
    y = np.exp(0.5 + 0.4 * x1 + 0.2 * (x2 > 0) + rng.normal(size=n) * (0.2 + 0.2 * np.abs(x1))) - 1
    p = 1 / (1 + np.exp(-(0.3 + 1.2 * x1 - 0.8 * (x2 > 0))))
    z = (rng.random(n) < p).astype(float)
    rows = [(i, None if i == 0 else float(x1[i]), str(x2[i]), float(max(y[i], 0)), float(z[i])) for i in range(n)]
    return spark.createDataFrame(rows, "entity long, x1 double, x2 string, y double, z double")


def test_hc3_against_numpy(linear):
    got = {r["feature"]: r for r in stay_associations(linear, ["x1", "x2"], "y", ["x2"]).collect()}
    pdf = linear.toPandas()
    x1 = pdf.x1.fillna(pdf.x1.median()).to_numpy()
    X = np.column_stack([np.ones(len(pdf)), x1, (pdf.x2.astype(float) > 0).astype(float)])
    y = np.log1p(pdf.y.to_numpy())
    inv = np.linalg.inv(X.T @ X)
    b = inv @ X.T @ y
    h = np.einsum("ij,jk,ik->i", X, inv, X)
    e = (y - X @ b) / (1 - h)
    se = np.sqrt(np.diag(inv @ (X.T * e**2) @ X @ inv))
    for i, f in enumerate(["x1", "x2"], 1):
        assert got[f]["coef"] == pytest.approx(b[i]) and got[f]["std_err"] == pytest.approx(se[i])
        assert got[f]["p_value"] == pytest.approx(normal_two_sided(b[i] / se[i]))
        assert got[f]["approx_pct_change"] == pytest.approx((np.exp(b[i]) - 1) * 100)


def test_logistic_against_newton(linear):
    got = {r["feature"]: r for r in outcome_associations(linear, ["x1", "x2"], "z", ["x2"]).collect()}
    pdf = linear.toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.x1.fillna(pdf.x1.median()), (pdf.x2.astype(float) > 0).astype(float)])
    b = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-X @ b))
        b += np.linalg.solve((X.T * (p * (1 - p))) @ X, X.T @ (pdf.z - p))
    se = np.sqrt(np.diag(np.linalg.inv((X.T * (p * (1 - p))) @ X)))
    for i, f in enumerate(["x1", "x2"], 1):
        assert got[f]["coef"] == pytest.approx(b[i], rel=1e-5)
        assert got[f]["p_value"] == pytest.approx(normal_two_sided(b[i] / se[i]), rel=1e-3, abs=1e-9)
        assert got[f]["odds_ratio"] == pytest.approx(math.exp(b[i]), rel=1e-5)


def test_constant_feature_has_no_effect(linear):
    from pyspark.sql import functions as F

    got = {r["feature"]: r for r in outcome_associations(linear.withColumn("one", F.lit(1.0)), ["x1", "one"], "z", []).collect()}
    assert got["one"]["p_value"] is None and not got["one"]["significant"] and got["x1"]["p_value"] < 0.05


def test_prepare_xy_requires_columns(linear):
    with pytest.raises(KeyError):
        st.prepare_xy(linear, ["x1", "nope"], "y")


def test_folds_are_stratified(linear):
    f = md.assign_folds(linear, "entity", 5, "z").groupBy("z", "fold").count().toPandas()
    assert (f.groupby("z")["count"].agg(lambda c: c.max() - c.min()) <= 1).all()


def test_boosted_trees_learn(linear):
    data = st.fill_medians(st.prepare_xy(linear, ["x1", "x2"], "z", ["entity"]), ["x1", "x2"])
    r = md.boosted_classifier(data, ["x1", "x2"], "z", "entity", md.Boosting(rounds=5, rate=0.3), folds=2)
    assert r.scores["roc_auc"][0] > 0.6 and 0 < r.scores["average_precision"][0] <= 1
    assert r.importances.first()["feature"] == "x1"


def test_both_outcomes_at_once(linear):
    small = md.Boosting(rounds=2, depth=2, rate=0.5)
    r = model_outcomes(linear, ["x1", "x2"], ["x2"], "entity", "z", "y", small, small)
    assert set(r.classifier.scores) == {"roc_auc", "average_precision"} and set(r.regressor.scores) == {"mae", "r2"}
    assert r.outcome.count() == 2 and set(r.stay.columns) >= {"approx_pct_change", "q_value", "significant"}


def test_robust_scaling_and_components(spark):
    rows = [(i, float(i), 0.0 if i < 9 else 5.0, 3.0, float(i % 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "entity long, a double, sparse double, flat double, `b c` double")
    moments = cl.column_moments(df, ["a", "sparse", "flat", "b c"])
    assert cl.variance_filter(moments, 0.01) == ["a", "sparse", "b c"]
    table = cl.scaling_table(df, ["a", "sparse"])
    assert table["a"] == (4.5, 4.5) and table["sparse"] == (0.0, 1.0)  # zero range divides by one
    scaled = {r["entity"]: r["sparse"] for r in cl.robust_scale(df, ["a", "sparse"], table).collect()}
    assert scaled[9] == 5.0
    model = cl.fit_projection(df, ["a", "sparse", "flat", "b c"], 0.999)
    p = np.array([r[0].toArray() for r in cl.project(df, model).select("projected").collect()])
    np.testing.assert_allclose(p.mean(0), 0, atol=1e-9)  # centred
    s = np.array([[(r[1] - 4.5) / 4.5, r[2], (r[4] - 0.5) / 1.0] for r in rows])
    ev = np.sort(np.linalg.eigvalsh(np.cov(s.T)))[::-1]
    np.testing.assert_allclose(np.sort(p.var(0, ddof=1))[::-1], ev[: p.shape[1]], rtol=1e-8)
    assert cl.explained_components([0.5, 0.4, 0.1], 0.90) == 3 and cl.explained_components([0.95, 0.05], 0.9) == 1


def test_least_squares_with_large_offsets(spark):
    """True effects 2 and 1 per standard deviation, far from the origin; a constant and a dependent column are reported."""
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=2000), rng.normal(size=2000)
    y = 2 * a + b + rng.normal(scale=0.1, size=2000)
    rows = pd.DataFrame({"a": 1e6 + 1e4 * a, "b": 1e8 + 1e5 * b, "c": 7.0, "d": 2 * (1e6 + 1e4 * a) - 5, "y": y})
    got = {r.feature: r for r in st.linear_associations(spark.createDataFrame(rows), ["a", "b", "c", "d"], "y", log_target=False).collect()}
    assert abs(got["a"].coef * 1e4 - 2) < 0.02 and abs(got["b"].coef * 1e5 - 1) < 0.02
    assert got["c"].coef is None and got["d"].coef is None and not got["d"].significant
    x = np.c_[np.ones(2000), a, b]
    inverse = np.linalg.inv(x.T @ x)
    resid = (y - x @ (inverse @ x.T @ y)) / (1 - np.einsum("ij,jk,ik->i", x, inverse, x))
    se = np.sqrt(np.diag(inverse @ (x * resid[:, None] ** 2).T @ x @ inverse))
    np.testing.assert_allclose([got["a"].std_err * 1e4, got["b"].std_err * 1e5], se[1:], rtol=1e-6)
    with pytest.raises(ValueError):
        st.linear_associations(spark.createDataFrame(rows.assign(a=[None, *rows["a"][1:]])), ["a", "b"], "y", log_target=False)


def test_ranking_scores(spark):
    rng = np.random.default_rng(1)
    p, y = np.round(rng.random(500), 2), rng.integers(0, 2, 500).astype(float)
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(p, y)] + [("one", 0.5, 1.0), ("one", 0.7, 1.0), ("zero", 0.1, 0.0)], "g string, p double, y double")
    want = sum(y[p == s].sum() / y.sum() * y[p >= s].mean() for s in set(p))
    area = np.mean([(a > b) + (a == b) / 2 for a in p[y == 1] for b in p[y == 0]])
    got = {r["g"]: (r["roc_auc"], r["average_precision"]) for r in md.ranking_scores(df, "g", "y", "p").collect()}
    assert got["g"] == (pytest.approx(area), pytest.approx(want)) and got["one"] == got["zero"] == (None, None)


def test_tails_are_those_of_the_plain_functions(spark):
    from pyspark.sql import functions as F

    from anchorframe.functions.pvalues import chi_square_p, chi_square_tail, normal_p, normal_two_sided

    rows = [(x, k) for x in (0.0, 1e-9, 0.3, 1.0, 5.0, 17.9, 18.1, 60.0, 400.0) for k in range(1, 12)] + [(2.0, 0), (float("nan"), 2), (None, 3)]
    got = spark.createDataFrame(rows, "x double, k long").select("x", "k", chi_square_p("x", F.col("k")).alias("p"), normal_p("x").alias("z")).collect()
    for r in got:
        want, z = chi_square_tail(r.x, r.k), normal_two_sided(r.x)
        assert (r.p is None and math.isnan(want)) or r.p == pytest.approx(want, rel=1e-9, abs=1e-300), r
        assert (r.z is None and math.isnan(z)) or r.z == pytest.approx(z, rel=1e-9, abs=1e-300), r


def test_rows_that_meet_are_not_copied(spark, monkeypatch):
    """Rows are written once however many packs there are; repeated and missing ids, and rows far from the origin."""
    monkeypatch.setattr(st, "STAY_BYTES", 600)
    monkeypatch.setattr(st, "PASS_BYTES", 400)
    monkeypatch.setattr(st, "TILE", (3, 4))
    rng = np.random.default_rng(8)
    x = rng.normal(1e5, 1, (90, 2))
    ids = [None if i % 30 == 7 else i // 2 if i < 20 else i for i in range(90)]
    df = spark.createDataFrame([(ids[i], x[i].tolist(), i % 3) for i in range(90)], "id long, vec array<double>, cluster int").repartition(4)
    sums = st.distance_sums(df, df, 10)
    plan = sums._jdf.queryExecution().toString()
    assert "Generate" not in plan and "CoGroup" not in plan
    d = np.sqrt(np.square(x[:, None] - x[None]).sum(-1))
    same = np.array([[a == b and a is not None for b in ids] for a in ids])
    d[same] = 0.0
    want = {}
    for i, name in enumerate(ids):
        for c in range(3):
            was = want.get((name, c), (0.0, 0))
            want[name, c] = was[0] + d[i, c::3].sum(), was[1] + 30
    got = {(r["id"], r["cluster"]): (r["dist"], r["n"]) for r in sums.collect()}
    # ids that are missing differ from each other, and a row of these is at no distance from itself but for rounding
    assert got.keys() == want.keys()
    for k, (dist, n) in want.items():
        assert got[k][1] == n and got[k][0] == pytest.approx(dist, rel=1e-6)
