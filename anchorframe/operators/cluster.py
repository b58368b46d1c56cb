"""Clustering of the matrix with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorframe.operators.matrix import column_quantiles
from anchorframe.operators.mixture import MixtureChoice, assign, fit_mixture, mixture_bic  # noqa: F401  the last step of clustering
from anchorframe.operators.neighbours import Density, density_core, measure_density, score_density  # noqa: F401  the step before


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# --------------------------------------------------------------------------
# column selection and scaling


@dataclass(frozen=True)
class ColumnMoments:
    """Row count, and mean and population variance of each feature."""

    rows: int
    mean: dict[str, float]
    variance: dict[str, float]


def column_moments(df: DataFrame, features: Sequence[str]) -> ColumnMoments:
    """One pass over the table; one small row comes back."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(_q(c)).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.var_pop(_q(c)).alias(f"v{i}") for i, c in enumerate(features)],
    ).first()
    return ColumnMoments(
        row["n"], {c: row[f"m{i}"] for i, c in enumerate(features)}, {c: row[f"v{i}"] for i, c in enumerate(features)}
    )


def variance_filter(moments: ColumnMoments, threshold: float = 0.01) -> list[str]:
    """Features whose population variance exceeds the threshold."""
    return [c for c, v in moments.variance.items() if v is not None and v > threshold]


def scaling_table(
    df: DataFrame, features: Sequence[str]
) -> dict[str, tuple[float, float]]:
    """Median and interquartile range per feature; a zero range divides by one."""
    rows = column_quantiles(df, features, [0.25, 0.5, 0.75], ["lo", "mid", "hi"]).collect()
    return {r["feature"]: (r["mid"], (r["hi"] - r["lo"]) or 1.0) for r in rows}


def robust_scale(df: DataFrame, features: Sequence[str], table: dict[str, tuple[float, float]]) -> DataFrame:
    return df.select(
        *[((_q(c) - F.lit(table[c][0])) / F.lit(table[c][1])).alias(c) if c in table else _q(c) for c in df.columns]
    )


def explained_components(ratios: Sequence[float], wanted: float) -> int:
    """Smallest number of components whose cumulative share passes ``wanted``."""
    total = 0.0
    for k, r in enumerate(ratios, 1):
        total += float(r)
        if total > wanted:
            return k
    return len(ratios)


def fit_projection(
    df: DataFrame,
    features: Sequence[str],
    explained: float = 0.90,
    variance_threshold: float = 0.01,
    output: str = "projected",
) -> PipelineModel:
    """Variance filter, robust scaling, centring and principal components as one saved-and-reloadable model."""
    moments = column_moments(df, features)
    kept = variance_filter(moments, variance_threshold)
    if not kept:
        raise ValueError("no feature passes the variance threshold")
    table = scaling_table(df, kept)
    # Spark's PCA does not centre what it transforms, so the mean goes into the scaling expression.
    means = {c: (moments.mean[c] - table[c][0]) / table[c][1] for c in kept}
    scaled = [f"__s{i}" for i in range(len(kept))]
    exprs = ", ".join(
        f"(CAST(`{c}` AS DOUBLE) - {table[c][0]!r}D) / {table[c][1]!r}D - ({means[c]!r}D) AS {s}"
        for c, s in zip(kept, scaled)
    )
    affine = SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")
    assembler = VectorAssembler(inputCols=scaled, outputCol="__features", handleInvalid="error")
    prepared = assembler.transform(affine.transform(df))
    pca = PCA(k=len(kept), inputCol="__features", outputCol="__components").fit(prepared)
    k = explained_components(pca.explainedVariance.toArray(), explained)
    slicer = VectorSlicer(inputCol="__components", outputCol=output, indices=list(range(k)))
    return PipelineModel([affine, assembler, pca, slicer])


def project(df: DataFrame, model: PipelineModel) -> DataFrame:
    out = model.transform(df)
    return out.drop(*[c for c in out.columns if c.startswith("__")])
