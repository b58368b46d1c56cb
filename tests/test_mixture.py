"""Mixtures against plain expectation-maximisation, and posteriors and BIC against SQL."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from anchorframe.operators import mixture as mx


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, s, (n, 2)) for m, s, n in (([0, 0], 1, 150), ([8, 0], 0.5, 100), ([0, 9], 1.5, 120))])
    rows = [(i, Vectors.dense(v)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, ["id", "projected"])


def density(model, x):
    out = []
    for w, m, c in zip(model.weights, model.means, model.covariances):
        d = x - m
        out.append(w * np.exp(-0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(c), d)) / np.sqrt((2 * math.pi) ** x.shape[1] * np.linalg.det(c)))
    return np.array(out).T


def test_sums_are_plain_steps():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2_500, 3))
    models = [mx._starts(x, k, k) for k in (2, 4)]
    first = np.array([0, 2])
    joined = [np.concatenate(c) for c in zip(*((m.weights, m.means, m.covariances) for m in models))]
    n, s1, s2, ll = mx._sums(x, joined[0], joined[1], mx.whitening(joined[2]), first)
    for i, m in enumerate(models):
        p = density(m, x)
        share = p / p.sum(axis=1, keepdims=True)
        part = slice(first[i], first[i] + m.k)
        np.testing.assert_allclose(ll[i], np.log(p.sum(axis=1)).sum())
        np.testing.assert_allclose(n[part], share.sum(axis=0))
        for c in range(m.k):
            away = x - m.means[c]
            np.testing.assert_allclose(s1[part][c], share[:, c] @ away, atol=1e-8)
            np.testing.assert_allclose(s2[part][c], (share[:, c, None] * away).T @ away, atol=1e-8)


def test_finds_the_groups(blobs):
    x, df = blobs
    found = mx.fit_mixture(df.repartition(3), ks=(2, 3, 4), starts=3, block_rows=100)
    assert found.k == 3 and set(found.bic) == {2, 3, 4}
    centres = sorted(np.round(found.model.means).tolist())
    assert centres == [[0, 0], [0, 9], [8, 0]]
    want = np.log(density(found.model, x).sum(axis=1)).sum()
    assert found.log_likelihood[3] == pytest.approx(want, rel=1e-9)


def test_bic_and_posterior_are_those_of_sql(spark, blobs):
    x, df = blobs
    found = mx.fit_mixture(df, ks=(3,), starts=2)
    m = found.model
    rows = mx.assign(df, m).toPandas()
    points = rows.assign(a=x[:, 0], b=x[:, 1])[["id", "a", "b"]]  # noqa: F841
    con = duckdb.connect()
    flat = [(m.weights[c], *m.means[c], m.covariances[c][0, 0], m.covariances[c][0, 1], m.covariances[c][1, 1]) for c in range(3)]
    comp = ", ".join(f"({c}, " + ", ".join(f"{float(v)!r}::DOUBLE" for v in row) + ")" for c, row in enumerate(flat))
    sql = f"""WITH m(c, w, ma, mb, saa, sab, sbb) AS (VALUES {comp}), d AS (SELECT id, c, w / (2 * pi() * sqrt(saa * sbb - sab * sab)) *
      exp(-0.5 * (sbb * (a - ma) ** 2 - 2 * sab * (a - ma) * (b - mb) + saa * (b - mb) ** 2) / (saa * sbb - sab * sab)) AS p FROM points, m)
      SELECT id, arg_max(c, p) AS c, max(p) / sum(p) AS share, ln(sum(p)) AS ll FROM d GROUP BY id ORDER BY id"""
    want = con.execute(sql).fetchdf()
    rows = rows.sort_values("id")
    assert (rows["cluster"].to_numpy() == want["c"].to_numpy()).all()
    np.testing.assert_allclose(rows["cluster_prob"], want["share"], rtol=1e-9)
    assert found.bic[3] == pytest.approx(-2 * want["ll"].sum() + (2 + 6 + 9) * math.log(len(x)), rel=1e-9)


def test_valid_clusters_only(blobs):
    _, df = blobs
    m = mx.fit_mixture(df, ks=(3,), starts=1).model
    free, held = (mx.assign(df, m, v).toPandas() for v in (None, [0, 2]))
    assert set(held["cluster"]) <= {0, 2}
    same = free["cluster"].isin([0, 2])
    assert (free[same]["cluster"] == held[same]["cluster"]).all() and (held["cluster_prob"] <= free["cluster_prob"] + 1e-12).all()
    assert mx.assign(df.limit(0), m).count() == 0


def test_defined_cases(spark):
    flat = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 40 + [(Vectors.dense([3.0, 3.0]),)], ["projected"])
    found = mx.fit_mixture(flat, ks=(2, 3), starts=2, max_iter=10)  # copies: the floor keeps it regular
    assert all(math.isfinite(v) for v in found.bic.values())
    arrays = spark.createDataFrame([([float(i % 2), float(i)],) for i in range(20)], "projected array<double>")
    assert mx.assign(arrays, mx.fit_mixture(arrays, ks=(2,), starts=1).model).count() == 20
    with pytest.raises(ValueError):
        mx.fit_mixture(flat.limit(0))


def test_saved_as_text(blobs):
    _, df = blobs
    m = mx.fit_mixture(df, ks=(2,), starts=1).model
    import json

    again = mx.Mixture.from_lists(json.loads(json.dumps(m.to_lists())))
    assert all((getattr(m, c) == getattr(again, c)).all() for c in ("weights", "means", "covariances"))


def test_narrow_and_far_components():
    """Sums by matrix products keep their digits where components are narrow and far apart, next to wide ones."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal([1e4, 5.0], [1e-3, 1.0], (300, 2)), rng.normal([-2e4, 0.0], [3.0, 2.0], (700, 2))])
    m = mx.Mixture(np.array([0.3, 0.4, 0.3]), np.array([[1e4, 5.0], [-2e4, 0.0], [-2e4, 1.0]]), np.array([[[1e-6, 0.0], [0.0, 1.0]], [[9.0, 0.5], [0.5, 4.0]], [[16.0, 0.0], [0.0, 4.0]]]))
    n, s1, s2, ll = mx._sums(x, m.weights, m.means, mx.whitening(m.covariances), np.array([0]))
    p = density(m, x)
    share = p / p.sum(axis=1, keepdims=True)
    np.testing.assert_allclose(ll[0], np.log(p.sum(axis=1)).sum(), rtol=1e-9)
    np.testing.assert_allclose(n, share.sum(axis=0), rtol=1e-8)
    for c in range(3):
        away = x - m.means[c]
        np.testing.assert_allclose(s2[c], (share[:, c, None] * away).T @ away, rtol=1e-5, atol=1e-7)


def test_no_row_of_differences_for_each_component():
    """A step holds a number for each row and component, not a vector: what it holds at once hardly depends on the dimensions."""
    import tracemalloc

    rng = np.random.default_rng(6)
    x = rng.normal(size=(mx.CHUNK_ROWS, 8))
    models = [mx._starts(x, 5, s) for s in range(30)]
    first = np.arange(30) * 5
    w, means, covariances = (np.concatenate(c) for c in zip(*((m.weights, m.means, m.covariances) for m in models)))
    white = mx.whitening(covariances)
    tracemalloc.start()
    mx._sums(x, w, means, white, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * 8 * mx.CHUNK_ROWS * 150
