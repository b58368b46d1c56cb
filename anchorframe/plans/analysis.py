"""Cluster analysis and outcome models as whole jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.operators import cluster as cl
from anchorframe.operators import models as md
from anchorframe.operators import stats as st
from anchorframe.operators.score import ClusterBundle, core_points
from anchorframe.session import ensure_checkpoint_dir


@dataclass
class ClusterAnalysis:
    core: DataFrame
    bic: dict[int, float]
    silhouette: float | None
    davies_bouldin: float | None
    feature_tests: DataFrame
    distribution: DataFrame
    rates: DataFrame
    bundle: ClusterBundle


@dataclass(frozen=True)
class ClusterSettings:
    variance_threshold: float = 0.01
    explained: float = 0.90
    neighbours: int = 15
    dense_share: float = 0.75
    min_component_rows: int = 50
    min_strength: float = 0.848
    min_cluster_rows: int = 70
    ks: tuple[int, ...] = (3, 4, 5, 6, 7)
    starts: int = 10
    seed: int = 42
    max_iter: int = 100
    min_effect: float = 0.01
    squared_silhouette: bool = True


def analyse_clusters(
    df: DataFrame,
    key: str = "entity",
    outcome: str = "outcome",
    stay: str = "stay_days",
    settings: ClusterSettings = ClusterSettings(),
    fills: Mapping[str, float] | None = None,
) -> ClusterAnalysis:
    """Select the dense core, cluster it, describe the clusters and test every feature between them."""
    ensure_checkpoint_dir(df.sparkSession)
    s = settings
    features = [c for c in df.columns if c not in (key, outcome, stay)]
    projection = cl.fit_projection(df, features, s.explained, s.variance_threshold)
    # every later step reads the projected rows several times
    projected = cl.project(df, projection).checkpoint()
    density, measured = cl.measure_density(projected, "projected", key, s.neighbours, s.dense_share, s.min_component_rows)
    dense = cl.density_core(measured, s.min_strength).drop("density_distance").checkpoint()

    choice = cl.fit_mixture(dense, "projected", s.ks, s.starts, s.seed, s.max_iter)
    assigned = cl.assign(dense, choice.model).drop("density_component")
    core = st.keep_large_clusters(assigned, s.min_cluster_rows).checkpoint()
    valid = sorted(r["cluster"] for r in core.select("cluster").distinct().collect())
    if len(valid) < 2:
        raise ValueError("fewer than two clusters reach the minimum size")

    points = core_points(core, key)
    per_row = st.silhouette_squared(points) if s.squared_silhouette else st.silhouette(points)
    scored = core.join(per_row.select(F.col("id").alias(key), "silhouette"), key, "left").checkpoint()
    mean_sil = scored.agg(F.avg("silhouette")).first()[0]
    dbi = st.davies_bouldin(points).first()[0]

    bundle = ClusterBundle(projection, choice.model, points, density, valid, fills or {}, key)
    return ClusterAnalysis(
        core=scored.drop("projected"),
        bic=choice.bic,
        silhouette=mean_sil,
        davies_bouldin=dbi,
        feature_tests=st.kruskal_wallis(scored, features, min_effect=s.min_effect),
        distribution=st.cluster_sizes(scored),
        rates=st.outcome_rates(scored, outcome, stay),
        bundle=bundle,
    )


def outcome_associations(df, features, target, binary: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Logistic associations after binarising the listed features and filling medians."""
    data = st.fill_medians(st.binarise(st.prepare_xy(df, features, target), binary), features)
    return md.logistic_associations(data, features, target, alpha)


def stay_associations(df, features, target, binary: Sequence[str], alpha: float = 0.05, log_target: bool = True) -> DataFrame:
    data = st.fill_medians(st.binarise(st.prepare_xy(df, features, target), binary), features)
    return st.linear_associations(data, features, target, alpha, log_target)


@dataclass
class OutcomeModels:
    classifier: md.ModelReport
    regressor: md.ModelReport
    outcome: DataFrame
    stay: DataFrame


def model_outcomes(
    df: DataFrame,
    features: Sequence[str],
    binary: Sequence[str],
    key: str = "entity",
    outcome: str = "outcome",
    stay: str = "stay_days",
    classifier: md.Boosting = md.Boosting(),
    regressor: md.Boosting = md.Boosting(rounds=800),
) -> OutcomeModels:
    """Boosted trees for both outcomes and the two association tables."""
    xy = lambda t: st.prepare_xy(df, features, t, [key])  # noqa: E731  the trees take missing values
    return OutcomeModels(
        md.boosted_classifier(xy(outcome), features, outcome, key, classifier),
        md.boosted_regressor(xy(stay), features, stay, key, regressor),
        outcome_associations(df, features, outcome, binary),
        stay_associations(df, features, stay, binary),
    )
