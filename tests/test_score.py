"""Clustering, saving, and scoring in batch and stream."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from anchorframe.operators import cluster as cl
from anchorframe.operators.score import ClusterBundle, append_scored, score_rows
from anchorframe.plans.analysis import ClusterSettings, analyse_clusters
from anchorframe.streaming.scoring import start_scoring

SMALL = ClusterSettings(neighbours=5, dense_share=0.9, min_component_rows=10, min_strength=0.1, min_cluster_rows=15, ks=(2, 3), starts=1, max_iter=20)


@pytest.fixture(scope="module")
def found(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, (120, 3)), rng.normal(6, 1, (90, 3))
    x = np.concatenate([a, b])
    rows = [(i, *map(float, x[i]), float(i >= 120), float(i % 4)) for i in range(len(x))]
    df = spark.createDataFrame(rows, "entity long, f1 double, f2 double, f3 double, outcome double, stay_days double")
    return df, analyse_clusters(df, settings=SMALL, fills={"f1": 0.0})


def test_analysis_separates_the_blobs(found):
    df, a = found
    seen = a.core.groupBy("cluster").agg(F.count_distinct("outcome").alias("k")).collect()
    assert len(seen) >= 2 and all(r["k"] == 1 for r in seen)
    assert a.silhouette > 0.3 and a.davies_bouldin > 0
    assert a.bic and min(a.bic, key=a.bic.get) in a.bic
    assert {r["feature"] for r in a.feature_tests.collect()} == {"f1", "f2", "f3"}
    assert abs(sum(r["pct"] for r in a.distribution.collect()) - 100) < 1e-9


def test_too_few_clusters(found):
    df, _ = found
    with pytest.raises(ValueError):
        analyse_clusters(df, settings=ClusterSettings(neighbours=5, dense_share=0.9, min_component_rows=10, min_strength=0.1, min_cluster_rows=10**6, ks=(2,), starts=1, max_iter=5))


def test_save_load_score_and_stream(spark, found, tmp_path):
    df, a = found
    a.bundle.save(str(tmp_path / "model"))
    bundle = ClusterBundle.load(spark, str(tmp_path / "model"))
    new = spark.createDataFrame([(1000, 0.1, -0.2, None, 0.0, 0.0), (1001, 6.0, 6.1, 5.9, 0.0, 0.0), (1002, None, 0.0, 0.0, None, None)], df.schema)
    scored = {r["entity"]: r for r in score_rows(new, bundle).collect()}
    core = {r["outcome"]: r["cluster"] for r in a.core.select("outcome", "cluster").distinct().collect()}
    assert scored[1001]["cluster"] in bundle.valid and scored[1001]["silhouette"] > 0.3
    assert scored[1001]["cluster"] != scored[1000]["cluster"]
    assert scored[1001]["cluster_prob"] > 0.5 and 0 <= scored[1001]["density_strength"] <= 1
    assert scored[1002]["f1"] == 0.0 and scored[1002]["outcome"] == 0.0
    assert core

    # silhouette of a new row against the core, by hand
    pts = a.bundle.core.toPandas()
    x = np.stack(pts["vec"])
    v = np.array(cl.project(new.fillna(0.0), bundle.projection).filter("entity = 1001").first()["projected"].toArray())
    d = np.sqrt(((x - v) ** 2).sum(1))
    own = pts["cluster"].to_numpy() == scored[1001]["cluster"]
    near, far = d[own].mean(), min(d[pts["cluster"] == c].mean() for c in set(pts["cluster"]) - {scored[1001]["cluster"]})
    assert scored[1001]["silhouette"] == pytest.approx((far - near) / max(far, near))

    both = append_scored(a.core, score_rows(new, bundle))
    assert both.count() == a.core.count() + 3

    new.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(new.schema).parquet(str(tmp_path / "in"))
    q = start_scoring(stream, bundle, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(120)
    got = {r["entity"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {1000, 1001, 1002}
    assert got[1001]["silhouette"] == pytest.approx(scored[1001]["silhouette"])


@pytest.mark.parametrize("name", ["gmm_bic", "gmm_assign", "gbt_classifier", "gbt_regressor", "score"])
def test_queries_run_the_whole_job(monkeypatch, name):
    """Registered settings: every k with all starts and iterations; all rounds, depth and folds."""
    from inspect import signature

    from anchorframe.plans import catalogue

    class Reached(Exception):
        pass

    def reach(of):
        def stop(*args, **named):
            call = signature(of).bind(*args, **named)
            call.apply_defaults()
            raise Reached(call.arguments)
        return stop

    monkeypatch.setattr(catalogue, "durable", lambda df: df)
    monkeypatch.setattr(catalogue, "_dense", lambda spark, d: None)
    monkeypatch.setattr(catalogue.b, "complete_matrix", lambda spark, d: type("Table", (), {"drop": lambda self, *c: self})())
    monkeypatch.setattr(cl, "density_core", lambda *a: None)
    for module, f in ((cl, "fit_mixture"), (catalogue.md, "boosted_classifier"), (catalogue.md, "boosted_regressor"), (catalogue.an, "analyse_clusters")):
        monkeypatch.setattr(module, f, reach(getattr(module, f)))
    with pytest.raises(Reached) as reached:
        catalogue.QUERIES[name](None, "")
    got = reached.value.args[0]
    if name.startswith("gbt"):
        assert (got["settings"].rounds, got["settings"].depth, got["folds"]) == (500 if name == "gbt_classifier" else 800, 4, 5)
    else:
        s = got["settings"] if name == "score" else ClusterSettings(ks=got["ks"], starts=got["starts"], max_iter=got["max_iter"])
        assert (tuple(s.ks), s.starts, s.max_iter) == ((3, 4, 5, 6, 7), 10, 100)


def test_density_core_is_not_moved_by_one_far_row(spark):
    rng = np.random.default_rng(2)
    blobs = np.r_[rng.normal(0, 1, (1000, 2)), rng.normal(12, 1, (1000, 2))]

    def core(points):
        df = spark.createDataFrame([(i, Vectors.dense(p.tolist())) for i, p in enumerate(points)], ["entity", "v"])
        _, found = cl.measure_density(df, "v", "entity", 10, 0.75, 50)
        return {r.entity: r.density_component for r in found.filter("density_strength > 0").collect()}

    plain, far = core(blobs), core(np.r_[blobs, [[5000.0, -4000.0]]])
    assert len({str(c) for c in plain.values()}) == 2 == len({str(c) for c in far.values()})
    assert 2000 not in far and len(set(plain) ^ set(far)) < 50


def test_stream_scores_as_batch_does(spark):
    from conftest import SF_DIR

    from anchorframe.plans.catalogue import QUERIES

    batch, stream = ({r.entity: tuple(r) for r in QUERIES[q](spark, SF_DIR).collect()} for q in ("score", "stream_scoring"))
    assert batch.keys() == stream.keys() and len(batch) > 100
    for k, row in batch.items():
        assert stream[k][1] == row[1] and all(x == pytest.approx(y, abs=2e-6) for x, y in zip(stream[k][2:], row[2:]))


def test_stream_writes_with_the_rows_not_with_the_pairs(spark, tmp_path):
    """Micro-batches whose rows meet most of a core's leaves: what is written follows the rows."""
    from pathlib import Path

    from anchorframe.operators.balls import ball_index
    from anchorframe.operators.score import core_points

    rng = np.random.default_rng(8)
    x = rng.normal(size=(1600, 5)) + np.repeat([0, 5], 800)[:, None]
    names = [f"f{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "entity long, " + ", ".join(f"{c} double" for c in names)).checkpoint()
    projection = cl.fit_projection(df, names, explained=1.0)
    projected = cl.project(df, projection).checkpoint()
    density, _ = cl.measure_density(projected, "projected", "entity", 5, 0.9, 10)
    model = cl.fit_mixture(projected, "projected", (2,), 1, 1, 20).model
    points = core_points(cl.assign(projected, model), "entity").checkpoint()
    bundle = ClusterBundle(projection, model, points, density, [0, 1], balls=ball_index(points, 16))
    size = lambda: sum(f.stat().st_size for f in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).rglob("*") if f.is_file())

    df.coalesce(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    before = size()
    assert start_scoring(stream, bundle, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True).awaitTermination(120)
    # packs of rows for each of 100 leaves took 4.7 MB
    assert size() - before < 2_000_000
    got = {r["entity"]: r["silhouette"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["entity"]: r["silhouette"] for r in score_rows(df, bundle, tolerance=None).collect()}
    assert got.keys() == want.keys() and len(got) == 1600 and max(abs(got[i] - want[i]) for i in got) < 1e-6
