"""Neighbour distances and density components against all pairs."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from anchorframe.operators import cluster as cl
from anchorframe.operators import neighbours as nb


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, [float(c) for c in row]) for i, row in enumerate(x)], "id long, v array<double>").repartition(parts)


def pairs(x):
    return np.sqrt(np.square(x[:, None] - x[None]).sum(2))


def brute(x, k, share, min_rows):
    d = pairs(x)
    core = np.array([np.sort(np.delete(d[i], i))[k - 1] if len(x) > k else np.inf for i in range(len(x))])
    finite = np.sort(core[np.isfinite(core)])
    eps = next((v for i, v in enumerate(finite) if (finite <= v).sum() >= share * len(finite)), -1.0)
    dense, label = core <= eps, np.full(len(x), -1)
    for i in np.flatnonzero(dense):
        if label[i] < 0:
            front = [i]
            while front:
                j = front.pop()
                if label[j] < 0:
                    label[j] = i
                    front += np.flatnonzero(dense & (d[j] <= eps) & (label < 0)).tolist()
    out = {}
    for i in range(len(x)):
        own = label == label[i]
        kept = label[i] >= 0 and own.sum() >= min_rows
        scale = np.median(core[own])
        out[i] = (core[i], int(label[i]) if kept else None, (1.0 if core[i] <= scale else scale / core[i]) if kept else 0.0)
    return out


def same(spark, x, k=5, share=0.8, min_rows=8, leaf_rows=16):
    density, out = nb.measure_density(frame(spark, x), "v", "id", k, share, min_rows, leaf_rows)
    want = brute(np.asarray(x, float), k, share, min_rows)
    got = {r["id"]: r for r in out.collect()}
    assert got.keys() == want.keys()
    for i, (core, component, strength) in want.items():
        r = got[i]
        assert (r["density_distance"] is None) == bool(np.isinf(core)) and (np.isinf(core) or r["density_distance"] == pytest.approx(core, abs=1e-12)), i
        assert r["density_component"] == component and r["density_strength"] == pytest.approx(strength), i
    return density, got


def blobs(rng, d=2, n=150, apart=12.0):
    other = np.zeros(d)
    other[-1] = apart
    return np.concatenate([rng.normal(size=(n, d)), rng.normal(size=(n, d)) + other])


@pytest.mark.parametrize("d, leaf_rows", [(1, 10), (2, 16), (3, 40), (5, 1_000)])
def test_against_all_pairs(spark, d, leaf_rows):
    rng = np.random.default_rng(d)
    _, got = same(spark, blobs(rng, d), leaf_rows=leaf_rows)
    assert len({r["density_component"] for r in got.values()} - {None}) >= 2


def test_copies_and_ties(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([np.round(rng.normal(size=(150, 2)), 1), np.tile([[0.3, -0.0]], (120, 1)), np.tile([[0.3, 0.0]], (30, 1)), rng.integers(0, 3, (60, 2))])
    same(spark, x)  # a third of all rows is one vector


def test_chains_over_many_leaves(spark):
    x = np.c_[np.arange(400) * 0.5, np.zeros(400)]
    _, got = same(spark, x, k=2, share=1.0, leaf_rows=12)
    assert {r["density_component"] for r in got.values()} == {0}


def test_one_far_row_moves_nothing(spark):
    """Two clear groups stay two, and a stray row stays out, however far it lies."""
    rng = np.random.default_rng(1)
    x = blobs(rng, 2, 300)
    base = {r["id"]: r for r in nb.measure_density(frame(spark, x), "v", "id", 10, 0.8, 50)[1].collect()}
    for far in (1e3, 1e9):
        rows = np.concatenate([x, [[far, far]]])
        got = {r["id"]: r for r in nb.measure_density(frame(spark, rows), "v", "id", 10, 0.8, 50)[1].collect()}
        assert got[600]["density_component"] is None and got[600]["density_strength"] == 0
        groups = {r["density_component"] for i, r in got.items()} - {None}
        assert len(groups) == 2
        assert sum(got[i]["density_component"] != base[i]["density_component"] for i in base) <= 3
        assert {i < 300 for i in got if got[i]["density_component"] == min(groups)} == {min(groups) < 300}


def test_groups_apart_in_a_later_component(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(500, 3)), rng.normal(size=(500, 3)) + np.array([0, 0, 10.0])
    spread = np.array([6.0, 6.0, 1.0])  # the first two explain most and do not tell the groups apart
    rows = [(i, Vectors.dense(v)) for i, v in enumerate(np.concatenate([a, b]) * spread)]
    df = spark.createDataFrame(rows, ["id", "projected"])
    out = nb.measure_density(df, "projected", "id", 8, 0.8, 20)[1].filter("density_component is not null").collect()
    sides = {}
    for r in out:
        sides.setdefault(r["density_component"], set()).add(r["id"] < 500)
    assert all(len(s) == 1 for s in sides.values()) and len(sides) >= 2


def test_doubled_rows(spark):
    """Each row twice, and twice as many neighbours wanted (the copy is one): the same groups."""
    rng = np.random.default_rng(3)
    x = blobs(rng, 2, 120)
    once = {r["id"]: r for r in nb.measure_density(frame(spark, x), "v", "id", 5, 0.8, 10)[1].collect()}
    twice = {r["id"]: r for r in nb.measure_density(frame(spark, np.concatenate([x, x])), "v", "id", 10, 0.8, 20)[1].collect()}
    for i, r in once.items():
        assert twice[i]["density_distance"] == pytest.approx(r["density_distance"]) == twice[i + 240]["density_distance"]
        assert twice[i]["density_component"] == twice[i + 240]["density_component"] == r["density_component"]
        assert twice[i]["density_strength"] == pytest.approx(r["density_strength"])


def test_few_and_no_rows(spark):
    same(spark, [[1.0, 2.0]], k=2)
    same(spark, [[1.0, 2.0], [1.0, 2.0], [5.0, 5.0]], k=2, min_rows=1)
    empty = frame(spark, np.zeros((1, 2))).limit(0)
    assert nb.measure_density(empty, "v", "id", 3)[1].count() == 0
    part = spark.createDataFrame([(i, [float(i)] if i else None, "clash") for i in range(30)], "id long, v array<double>, labels string")
    out = {r["id"]: r for r in nb.measure_density(part, "v", "id", 2, 1.0, 3)[1].collect()}
    assert out[0]["density_distance"] is None and out[0]["density_strength"] == 0 and out[5]["density_component"] == 1 and out[5]["labels"] == "clash"


def test_new_rows_are_scored_against_the_stored(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = blobs(rng, 2, 200)
    density, got = same(spark, x, k=6)
    density.save(str(tmp_path / "d"))
    density = nb.Density.load(spark, str(tmp_path / "d"))
    new = np.concatenate([x[:3], rng.normal(size=(40, 2)) * 2, rng.normal(size=(40, 2)) + [0, 12], [[1e6, 0.0]]])
    out = {r["id"]: r for r in nb.score_density(frame(spark, new), "v", "id", density).collect()}
    scale = {r["component"]: r["scale"] for r in density.components.collect()}
    label = {i: r["density_component"] for i, r in got.items()}
    dense = np.array([r["density_distance"] is not None and r["density_distance"] <= density.eps for _, r in sorted(got.items())])
    for i, v in enumerate(new):
        d = np.sqrt(np.square(x - v).sum(1))
        core, to = np.sort(d)[5], np.where(dense, d, np.inf)
        component = label[int(to.argmin())] if core <= density.eps and to.min() <= density.eps else None
        assert out[i]["density_component"] == component, i
        assert out[i]["density_strength"] == pytest.approx(0 if component is None else min(1.0, scale[component] / core)), i
    assert out[83]["density_component"] is None


def test_connected(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["root"] for r in nb.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}
    assert cl.measure_density is nb.measure_density
