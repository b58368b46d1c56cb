"""Predictive models with their cross-validation, and logistic associations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.operators.boost import Boosting, Grown, grow
from anchorframe.operators.skew import running, spread_row_number
from anchorframe.operators.stats import _finish_associations
from anchorframe.session import ensure_checkpoint_dir


@dataclass
class ModelReport:
    """The model, mean and deviation of each score over the folds, the scores by fold, importances, and all predictions."""

    model: Grown
    scores: dict[str, tuple[float, float]]
    by_fold: DataFrame
    importances: DataFrame
    predictions: DataFrame


def assign_folds(df: DataFrame, key: str, folds: int = 5, stratify: str | None = None, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold number per row; with ``stratify`` each class is dealt out evenly."""
    hashed = df.withColumn("__h", F.xxhash64(F.lit(seed), key))
    groups = [stratify] if stratify else []
    if not groups:
        hashed, groups = hashed.withColumn("__all", F.lit(0)), ["__all"]
    numbered = spread_row_number(hashed, groups, "__h", "__rn")
    return numbered.withColumn(name, F.pmod("__rn", F.lit(folds)).cast("int")).drop("__h", "__rn", "__all")


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    safe = df.select("*", *[F.col(f"`{f}`").cast("double").alias(f"__x{i}") for i, f in enumerate(features)])
    return VectorAssembler(inputCols=[f"__x{i}" for i in range(len(features))], outputCol="features").transform(safe)


def ranking_scores(df: DataFrame, group: str, label: str, score: str) -> DataFrame:
    """(group, roc_auc, average_precision): how well falling scores put label 1 before label 0, by group.

    Equal scores count half in the area; precision is taken once for each distinct score, and weighted by the recall
    gained there.  NULL where one of the labels is missing.  Rows are added up by distinct score first, and running
    sums carry on over pieces of a group, so a group of any size is spread.
    """
    by = df.groupBy(F.col(group).alias("g"), (-F.col(score)).alias("at")).agg(F.sum(F.col(label).cast("double")).alias("hits"), F.count("*").cast("double").alias("n"))
    ahead = running(running(by, ["g"], "at", "hits", "sum", "hits_before"), ["g"], "at", "n", "sum", "n_before")
    hits_before, n_before = F.coalesce("hits_before", F.lit(0.0)), F.coalesce("n_before", F.lit(0.0))
    misses = F.col("n") - F.col("hits")
    # each miss lies behind the hits of higher scores, and half of those of its own
    behind = misses * (hits_before + F.col("hits") / 2)
    precision = (hits_before + F.col("hits")) / (n_before + F.col("n"))
    sums = ahead.groupBy("g").agg(F.sum(behind).alias("area"), F.sum("hits").alias("h"), F.sum(misses).alias("m"), F.sum(F.col("hits") * precision).alias("p"))
    return sums.select(F.col("g").alias(group), F.try_divide("area", F.col("h") * F.col("m")).alias("roc_auc"),
                       F.when(F.col("m") > 0, F.try_divide("p", "h")).alias("average_precision"))


def value_scores(df: DataFrame, group: str, label: str, prediction: str) -> DataFrame:
    """(group, mae, r2) of predictions, by group; r2 is NULL where the label does not vary."""
    miss = F.col(label) - F.col(prediction)
    sums = df.groupBy(group).agg(F.avg(F.abs(miss)).alias("mae"), F.sum(miss * miss).alias("rest"), (F.var_pop(label) * F.count("*")).alias("all"))
    return sums.select(group, "mae", (1 - F.try_divide("rest", "all")).alias("r2"))


def _over_folds(by_fold: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and deviation over the folds; folds without a score are left out."""
    rows, names = by_fold.collect(), [c for c in by_fold.columns if c != "fold"]  # a row a fold
    kept = {c: [r[c] for r in rows if r[c] is not None] for c in names}
    return {c: (float(np.mean(v)), float(np.std(v))) if v else (float("nan"), float("nan")) for c, v in kept.items()}


def _report(df: DataFrame, features: Sequence[str], target: str, key: str, settings: Boosting, folds: int, binary: bool) -> ModelReport:
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.filter(F.col(f"`{target}`").isNotNull())
    grown = grow(assign_folds(kept, key, folds, target if binary else None).checkpoint(), features, target, key, binary, settings, folds)
    predictions = grown.predictions().checkpoint()
    by_fold = (ranking_scores if binary else value_scores)(predictions, "fold", "label", "cv_prediction").checkpoint()
    importances = df.sparkSession.createDataFrame(grown.importances(), "feature string, importance double")
    return ModelReport(grown, _over_folds(by_fold), by_fold, importances, predictions)


def boosted_classifier(
    df: DataFrame, features: Sequence[str], target: str, key: str, settings: Boosting = Boosting(), folds: int = 5
) -> ModelReport:
    """Boosted trees with stratified cross-validation (ROC-AUC, average precision) and importances from a fit on all rows."""
    return _report(df, features, target, key, settings, folds, binary=True)


def boosted_regressor(
    df: DataFrame, features: Sequence[str], target: str, key: str, settings: Boosting = Boosting(rounds=800), folds: int = 5
) -> ModelReport:
    """Boosted regression trees with cross-validated MAE and R2."""
    return _report(df, features, target, key, settings, folds, binary=False)


def logistic_associations(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.05) -> DataFrame:
    """Maximum-likelihood logistic regression: coefficient, p, odds ratio, adjusted p.

    A feature with one single value has no estimable effect: it is left out of
    the fit and reported with NULLs.
    """
    spread = df.agg(
        *[f(F.col(f"`{c}`")).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    varying = [c for i, c in enumerate(features) if spread[f"lo{i}"] != spread[f"hi{i}"]]
    rows = [(c, None, None, None) for c in features if c not in varying]
    if varying:
        data = _assemble(df, varying).select("features", F.col(f"`{target}`").cast("double").alias("label"))
        model = GeneralizedLinearRegression(family="binomial", link="logit", regParam=0.0, maxIter=100, tol=1e-8).fit(data)
        p_values = model.summary.pValues  # features first, intercept last
        rows += [(f, float(b), float(p), float(np.exp(b))) for f, b, p in zip(varying, model.coefficients.toArray(), p_values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, coef double, p_value double, odds_ratio double")
    return _finish_associations(table, alpha)
