"""Gaussian mixtures with full covariances; all candidate models advance together.

Expectation-maximisation needs sums over the rows in every step.  Rows stay in blocks, and one Spark job per step gives
the sums of every model that still moves: weights, first and second moments around the current means, and the
likelihood.  The driver holds the models only, whose size does not depend on the rows.  A model that has converged
leaves; what is left travels with the next job.

Starts come from k-means on a sample (`SAMPLE_ROWS` rows of the smallest hashes, a documented bound); all steps use all
rows.  A small multiple of the identity keeps covariances regular.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.session import configure, ensure_checkpoint_dir

SAMPLE_ROWS = 5_000
#: Rows of a task at most, and at least where there are cores for more tasks.
BLOCK_ROWS, LEAST_ROWS = 1 << 16, 1 << 10
CHUNK_ROWS = 512
FLOOR = 1e-6
#: Squared distance to the centre in a component's narrowest deviations: beyond, products around the centre lose digits.
NARROW = 1e6


@dataclass
class Mixture:
    """Weights (k), means (k, d) and covariances (k, d, d)."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    @property
    def k(self) -> int:
        return len(self.weights)

    def to_lists(self) -> dict:
        return {"weights": self.weights.tolist(), "means": self.means.tolist(), "covariances": self.covariances.tolist()}

    @classmethod
    def from_lists(cls, lists: dict) -> Mixture:
        return cls(*(np.array(lists[c]) for c in ("weights", "means", "covariances")))


@dataclass
class MixtureChoice:
    model: Mixture
    k: int
    bic: dict[int, float]
    log_likelihood: dict[int, float]
    steps: int


def mixture_bic(log_likelihood: float, n: int, k: int, d: int) -> float:
    """Bayesian information criterion of a full-covariance Gaussian mixture."""
    free = (k - 1) + k * d + k * d * (d + 1) / 2
    return -2.0 * log_likelihood + free * math.log(n)


def whitening(covariances: np.ndarray) -> np.ndarray:
    """For each covariance a matrix that turns differences into independent unit ones; lower triangular."""
    out = np.empty_like(covariances)
    unit = np.eye(covariances.shape[-1])
    for i, c in enumerate(covariances):
        extra = 0.0
        while True:
            try:
                out[i] = np.linalg.solve(np.linalg.cholesky(c + extra * unit), unit)
                break
            except np.linalg.LinAlgError:  # a singular one is widened until it is regular
                extra = max(10 * extra, FLOOR * max(1.0, float(np.trace(c))))
    return out


def _log_scale(weights: np.ndarray, white: np.ndarray) -> np.ndarray:
    """Log of weight times the density at the mean."""
    return np.log(np.maximum(weights, 1e-300)) + np.log(np.maximum(np.einsum("cii->ci", white), 1e-300)).sum(axis=1) - white.shape[2] / 2 * math.log(2 * math.pi)


def _log_weighted(away: np.ndarray, weights: np.ndarray, white: np.ndarray) -> np.ndarray:
    """(components, rows): log of weight times density, from differences (components, rows, d) to the means."""
    scale = _log_scale(weights, white)
    unit = np.matmul(away, white.transpose(0, 2, 1))
    return scale[:, None] - 0.5 * np.einsum("cnd,cnd->cn", unit, unit)


def _sums(x: np.ndarray, weights: np.ndarray, means: np.ndarray, white: np.ndarray, first: np.ndarray) -> tuple:
    """Of models side by side (model m's components begin at first[m]): rows, moments around the means, log-likelihoods.

    A log density is linear in the products of a row's numbers, and moments are sums of these, so both are matrix products.
    They are taken around a common centre; components so narrow for their distance to it that digits would go are taken
    around their own means.
    """
    c, d = means.shape
    models = [slice(a, b) for a, b in zip(first, [*first[1:], c])]
    up, over = np.triu_indices(d)
    centre = weights @ means / weights.sum()
    off = means - centre
    precision = np.matmul(white.transpose(0, 2, 1), white)
    reach = np.square(off).sum(axis=1) * np.einsum("cii->c", precision)
    own = np.flatnonzero(~(reach <= NARROW))
    pull = np.einsum("cij,cj->ci", precision, off)
    with np.errstate(invalid="ignore"):
        constant = _log_scale(weights, white) - 0.5 * np.einsum("ci,ci->c", off, pull)
        linear = np.column_stack([constant, pull, np.where(up == over, -0.5, -1.0) * precision[:, up, over]])
    linear[own] = 0.0
    ll, sums = np.zeros(len(first)), np.zeros((c, linear.shape[1]))
    own_s1, own_s2 = np.zeros((len(own), d)), np.zeros((len(own), d, d))
    for i in range(0, len(x), CHUNK_ROWS):
        y = (x[i : i + CHUNK_ROWS] - centre).T
        products = np.concatenate([np.ones((1, y.shape[1])), y, y[up] * y[over]])
        share = linear @ products
        if len(own):
            away = x[None, i : i + CHUNK_ROWS] - means[own, None]
            share[own] = _log_weighted(away, weights[own], white[own])
        top = np.empty((len(first), share.shape[1]))
        total = np.empty_like(top)
        for m, part in enumerate(models):
            np.max(share[part], axis=0, out=top[m])
            share[part] -= top[m]
        np.maximum(share, -700.0, out=share)  # below, exp is slow, and nothing to add
        np.exp(share, out=share)
        for m, part in enumerate(models):
            np.sum(share[part], axis=0, out=total[m])
            share[part] /= total[m]
        ll += (top + np.log(total)).sum(axis=1)
        sums += share @ products.T
        if len(own):
            weighed = share[own][:, :, None] * away
            own_s1 += weighed.sum(axis=1)
            own_s2 += np.matmul(weighed.transpose(0, 2, 1), away)
    n, about = sums[:, 0], sums[:, 1 : d + 1]
    square = np.empty((c, d, d))
    square[:, up, over] = square[:, over, up] = sums[:, d + 1 :]
    s1 = about - n[:, None] * off
    cross = about[:, :, None] * off[:, None, :]
    s2 = square - cross - cross.transpose(0, 2, 1) + n[:, None, None] * off[:, :, None] * off[:, None, :]
    s1[own], s2[own] = own_s1, own_s2
    return n, s1, s2, ll


def _blocks(df: DataFrame, vec: str, block_rows: int) -> tuple[DataFrame, int]:
    vectors = df.select(vector_to_array(F.col(vec)).alias("v") if df.schema[vec].dataType.typeName() != "array" else F.col(vec).alias("v"))
    vectors = vectors.checkpoint()
    rows = vectors.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            yield pa.RecordBatch.from_arrays([pa.array([len(column)], pa.int64()), pa.array([column.flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()], pa.binary())], ["n", "data"])

    cores = df.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(max(1, -(-rows // block_rows), min(cores, rows // LEAST_ROWS))).mapInArrow(run, "n long, data binary").checkpoint(), rows


def _starts(sample: np.ndarray, k: int, seed: int) -> Mixture:
    """Weights, means and covariances of a k-means of the sample."""
    rng = np.random.default_rng(seed)
    n, d = sample.shape
    centres = sample[[int(rng.integers(n))]]
    near = np.square(sample - centres[0]).sum(axis=1)
    while len(centres) < k:
        new = sample[int(rng.choice(n, p=near / near.sum())) if near.sum() > 0 else int(rng.integers(n))]
        centres = np.r_[centres, new[None]]
        near = np.minimum(near, np.square(sample - new).sum(axis=1))
    for _ in range(20):
        code = np.stack([np.square(sample - c).sum(axis=1) for c in centres]).argmin(axis=0)
        size = np.bincount(code, minlength=k)
        sums = np.zeros((k, d))
        np.add.at(sums, code, sample)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    spread = np.cov(sample.T, bias=True).reshape(d, d) if n > 1 else np.zeros((d, d))
    covariances = np.stack([np.cov(sample[code == i].T, bias=True).reshape(d, d) if size[i] > 1 else spread for i in range(k)]) + FLOOR * np.eye(d)
    return Mixture(np.maximum(size, 1) / np.maximum(size, 1).sum(), centres, covariances)


def fit_mixture(
    df: DataFrame,
    vec: str = "projected",
    ks: Sequence[int] = tuple(range(3, 8)),
    starts: int = 10,
    seed: int = 42,
    max_iter: int = 100,
    tol: float = 1e-3,
    block_rows: int = BLOCK_ROWS,
) -> MixtureChoice:
    """For each k the best of several starts; the k with the lowest BIC.

    A model is done when its mean log-likelihood changes by less than tol, and is then returned as it was when that
    likelihood was taken.  vec: vectors or arrays without missing values; a table without rows is an error.
    """
    spark = configure(df.sparkSession)
    ensure_checkpoint_dir(spark)
    held, n = _blocks(df, vec, block_rows)
    if not n:
        raise ValueError("no rows to fit a mixture to")
    array = vector_to_array(F.col(vec)) if df.schema[vec].dataType.typeName() != "array" else F.col(vec)
    # the smallest hashes of twice the sample's share of rows
    share = int(min(1.0, 2 * SAMPLE_ROWS / n) * 1_000_000)
    some = df.select(array.alias("v")).filter(F.pmod(F.xxhash64(F.lit("sample"), "v"), F.lit(1_000_000)) < share).orderBy(F.xxhash64("v"), "v").limit(SAMPLE_ROWS)
    sample = np.array([r["v"] for r in some.collect()], np.float64)
    if not len(sample):
        sample = np.array([df.select(array.alias("v")).first()["v"]], np.float64)
    d = sample.shape[1]
    live = {(k, s): _starts(sample, k, seed + s) for k in ks for s in range(starts)}
    before: dict[tuple[int, int], float] = {}
    best: dict[int, tuple[float, Mixture]] = {}
    data = held.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    parts, step = data.getNumPartitions(), 0
    try:
        while live:
            names = list(live)
            models = [live[m] for m in names]
            first = np.cumsum([0, *[m.k for m in models[:-1]]])
            weights, means, covariances = (np.concatenate(c) for c in zip(*((m.weights, m.means, m.covariances) for m in models)))
            white = whitening(covariances)

            def run(rows, weights=weights, means=means, white=white, first=first, d=d):
                total = None
                for count, packed in rows:
                    found = _sums(np.frombuffer(packed, "<f8").reshape(count, d), weights, means, white, first)
                    total = found if total is None else tuple(a + b for a, b in zip(total, found))
                return iter([] if total is None else [total])

            add = lambda a, b: tuple(x + y for x, y in zip(a, b))
            each = data.mapPartitions(run)
            if parts <= 16:
                found = each.collect()
                sums = found[0]
                for more in found[1:]:
                    sums = add(sums, more)
            else:
                sums = each.treeReduce(add, depth=2)
            rows, s1, s2, ll = sums
            edges = [*first, len(weights)]
            for i, name in enumerate(names):
                part, model, now = slice(edges[i], edges[i + 1]), models[i], float(ll[i])
                if not math.isfinite(now):
                    del live[name]
                elif step == max_iter or abs(now - before.get(name, -math.inf)) < tol * n:
                    if name[0] not in best or now > best[name[0]][0]:
                        best[name[0]] = (now, model)
                    del live[name]
                else:
                    before[name] = now
                    size = rows[part] + 10 * np.finfo(float).eps
                    shift = s1[part] / size[:, None]
                    moved = s2[part] / size[:, None, None] - shift[:, :, None] * shift[:, None, :] + FLOOR * np.eye(d)
                    live[name] = Mixture(size / size.sum(), model.means + shift, moved)
            step += 1
    finally:
        data.unpersist()
    if not best:
        raise ValueError("no mixture could be fitted: every likelihood was undefined")
    bic = {k: mixture_bic(ll, n, k, d) for k, (ll, _) in sorted(best.items())}
    chosen = min(bic, key=lambda k: (bic[k], k))
    return MixtureChoice(best[chosen][1], chosen, bic, {k: ll for k, (ll, _) in best.items()}, step)


def assign(df: DataFrame, model: Mixture, valid: Sequence[int] | None = None, vec: str = "projected") -> DataFrame:
    """Add ``cluster`` and ``cluster_prob``, its posterior; with ``valid`` only those clusters compete, ties go to the first."""
    weights, means, white = model.weights, model.means, whitening(model.covariances)
    options = list(range(model.k)) if valid is None else sorted(valid)

    @F.pandas_udf("cluster int, cluster_prob double")
    def placed(v):
        import pandas as pd

        if not len(v):
            return pd.DataFrame({"cluster": np.empty(0, np.int32), "cluster_prob": np.empty(0)})
        x = np.stack(v.to_numpy())
        p = np.empty((len(x), len(weights)))
        for i in range(0, len(x), CHUNK_ROWS):
            log_p = _log_weighted(x[None, i : i + CHUNK_ROWS] - means[:, None], weights, white)
            share = np.exp(log_p - log_p.max(axis=0))
            p[i : i + CHUNK_ROWS] = (share / share.sum(axis=0)).T
        at = p[:, options].argmax(axis=1)
        cluster = np.array(options)[at]
        return pd.DataFrame({"cluster": cluster.astype(np.int32), "cluster_prob": p[np.arange(len(p)), cluster]})

    array = vector_to_array(F.col(vec)) if df.schema[vec].dataType.typeName() != "array" else F.col(vec)
    out = df.withColumn("__placed", placed(array))
    return out.withColumns({"cluster": F.col("__placed.cluster"), "cluster_prob": F.col("__placed.cluster_prob")}).drop("__placed")
