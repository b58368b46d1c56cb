"""Distance sums from a tree of balls against all pairs."""

import numpy as np
import pytest

from anchorframe.operators import balls as bl
from anchorframe.operators.stats import _silhouette_from, distance_sums


def core(spark, x, cluster):
    return spark.createDataFrame([(i, [float(c) for c in v], int(k)) for i, (v, k) in enumerate(zip(x, cluster))], "id long, vec array<double>, cluster long").repartition(3)


def exact(new, x, cluster):
    d = np.sqrt(np.square(new[:, None] - x[None]).sum(2))
    return {(i, int(k)): (d[i, cluster == k].sum(), int((cluster == k).sum())) for i in range(len(new)) for k in np.unique(cluster)}


@pytest.mark.parametrize("d, leaf_rows, tolerance", [(2, 20, 3e-7), (2, 20, 1e-3), (3, 60, 1e-2), (1, 5, 0.0)])
def test_sums_are_within_the_tolerance(spark, d, leaf_rows, tolerance):
    rng = np.random.default_rng(d)
    x = np.concatenate([rng.normal(size=(400, d)), rng.normal(size=(300, d)) * 0.2 + 5, np.zeros((50, d))])
    cluster = np.repeat([4, 7, 4], [400, 300, 50])
    new = np.concatenate([rng.normal(size=(40, d)) * 3, x[:5], np.full((1, d), 1e4), np.full((1, d), -1e-3)])
    index = bl.ball_index(core(spark, x, cluster), leaf_rows)
    asked = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(new)], "id long, vec array<double>")
    got = {(r.id, r.cluster): (r.dist, r.n) for r in bl.ball_sums(asked, index, tolerance).collect()}
    want = exact(new, x, cluster)
    assert got.keys() == want.keys()
    for k, (dist, n) in want.items():
        assert got[k][1] == n and got[k][0] == pytest.approx(dist, rel=max(tolerance, 1e-12)), k


def test_far_rows_read_few_leaves(spark):
    rng = np.random.default_rng(5)
    x = rng.random((6_000, 2)) * 100
    index = bl.ball_index(core(spark, x, np.zeros(6_000)), 10)
    leaves = index.leaves.count()
    asked = rng.random((50, 2)) * 100
    sums, near = index.balls.far(index.tree, 0, asked, 1e-3)
    met = sum(len(rows) for _, rows in near)
    assert leaves > 300 and met < 0.25 * 50 * leaves  # most of the core is summed as a whole


def test_silhouette_within_a_millionth(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(200, 2)), rng.normal(size=(200, 2)) + 6])
    points = core(spark, x, np.repeat([0, 1], 200))
    new = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(60, 2)) * 5)], "id long, vec array<double>")
    own = new.selectExpr("id", "cast(vec[0] > 3 as long) as own")
    index = bl.ball_index(points, 15)
    index.save(str(tmp_path / "b"))
    index = bl.BallIndex.load(spark, str(tmp_path / "b"))
    a, b = ({r.id: r.silhouette for r in _silhouette_from(s, own, 0).collect()} for s in (bl.ball_sums(new, index), distance_sums(new, points, same_rows=False)))
    assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-6


def test_no_rows(spark):
    index = bl.ball_index(core(spark, np.zeros((3, 2)), np.array([1, 1, 2])))
    nothing = spark.createDataFrame([], "id long, vec array<double>")
    assert bl.ball_sums(nothing, index).count() == 0
    one = spark.createDataFrame([(9, [0.0, 0.0])], "id long, vec array<double>")
    assert sorted((r.cluster, r.dist, r.n) for r in bl.ball_sums(one, index).collect()) == [(1, 0.0, 2), (2, 0.0, 1)]


def test_packed_rows_meet_by_a_shuffle(spark):
    """Spark takes packed rows for small ones and would broadcast them, through the driver."""
    points = spark.createDataFrame([(i, [float(i), float(i % 7)], i % 2) for i in range(50)], "id long, vec array<double>, cluster long")
    sums = bl.ball_sums(points.select("id", "vec"), bl.ball_index(points.select("vec", "cluster"), leaf_rows=10))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [leaf" in plan and "BroadcastHashJoin [leaf" not in plan


def test_far_rows_of_the_plane_are_expanded_at_a_tight_tolerance(spark):
    """Each row reads the leaves around it, not a share of all leaves, and sums stay exact to that tolerance."""
    rng = np.random.default_rng(9)
    x, cluster = rng.uniform(-1, 10, size=(6000, 2)), rng.integers(0, 3, 6000)
    index = bl.ball_index(core(spark, x, cluster), 20)
    read = np.zeros(6000)
    for c in range(3):
        sums, near = index.balls.far(index.tree, c, x, 1e-12)
        for leaf, rows in near:
            read[rows] += 1
    assert read.mean() / 3 < 0.35 * (index.tree.leaf >= 0).sum()
    asked = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(0, 6000, 60)], "id long, vec array<double>")
    for r in bl.ball_sums(asked, index, 1e-12).collect():
        want = np.sqrt(np.square(x[cluster == r.cluster] - x[r.id]).sum(1)).sum()
        assert abs(r.dist - want) <= 1e-11 * want


def written(spark):
    from pathlib import Path

    at = spark.sparkContext.getCheckpointDir()
    return sum(f.stat().st_size for f in Path(at.removeprefix("file:")).rglob("*") if f.is_file())


def test_rows_that_meet_most_leaves_are_not_written_for_each(spark):
    """In five dimensions nearly all pairs meet: the bytes written follow the rows, not the pairs, and sums stay right."""
    rng = np.random.default_rng(11)
    x, new, cluster = rng.normal(size=(4000, 5)), rng.normal(size=(3000, 5)), rng.integers(0, 3, 4000)
    new[:50] = x[:50]
    index = bl.ball_index(core(spark, x, cluster), 20)
    asked = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(new)], "id long, vec array<double>").repartition(2)
    before = written(spark)
    got = {(r.id, r.cluster): (r.dist, r.n) for r in bl.ball_sums(asked, index).collect()}
    # 3,000 rows of 48 bytes that ask 200 leaves are 28 MB
    assert written(spark) - before < 2_000_000
    want = exact(new[:300], x, cluster)
    assert len(got) == 9000 and all(got[k][1] == n and abs(got[k][0] - d) <= 3e-7 * d for k, (d, n) in want.items())


@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e-9), (1e3, 1e-3)])
def test_near_sums_do_not_cancel(shift, scale):
    """Far from the origin, and for rows that lie on points or just beside them."""
    rng = np.random.default_rng(4)
    y = shift + scale * rng.normal(size=(200, 4))
    x = np.concatenate([y[:20], y[:20] * (1 + 1e-12), shift + scale * rng.normal(size=(50, 4)), np.full((1, 4), 1e8)])
    member = np.eye(200)
    d = np.sqrt(np.square(x[:, None] - y[None]).sum(axis=2))
    assert (np.abs(bl.near_sums(x, y, member, 3e-7) - d) <= 3e-7 * d).all()
    assert (np.abs(bl.near_sums(x, y, member, 0.0) - d) <= 1e-15 * d).all()
