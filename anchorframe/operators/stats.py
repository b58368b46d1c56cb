"""Cluster statistics and association models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorframe.functions.pvalues import chi_square_p, normal_p, normal_two_sided
from anchorframe.functions.scalar import to_double
from anchorframe.operators.matrix import column_quantiles, to_long
from anchorframe.operators.skew import running
from anchorframe.session import configure, ensure_checkpoint_dir
from anchorframe.sources.readers import require_columns

#: Of rows that all meet: rows and bytes that stay in a task at most, bytes that pass by at once, and rows of both in one product.
STAY_ROWS, STAY_BYTES, PASS_BYTES, TILE = 1 << 15, 1 << 24, 1 << 22, (256, 1024)
#: Stands for a missing cluster.
_UNKNOWN = int(np.iinfo(np.int64).min)

# --------------------------------------------------------------------------
# clusters as groups


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows and percentage per cluster."""
    counts = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # one row per cluster
    return counts.select(cluster, "n", (F.col("n") * 100 / total).alias("pct"))


def keep_large_clusters(df: DataFrame, min_rows: int, cluster: str = "cluster") -> DataFrame:
    large = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
    return df.join(large.select(cluster), cluster, "left_semi")


def outcome_rates(df: DataFrame, outcome: str, stay: str, cluster: str = "cluster") -> DataFrame:
    """Mean outcome, and mean stay among rows with a stay, per cluster."""
    return df.groupBy(cluster).agg(
        F.avg(outcome).alias("outcome_rate"), F.avg(F.when(F.col(stay) != 0, F.col(stay))).alias("mean_stay")
    )


def cluster_means(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(*[F.avg(F.col(f"`{f}`")).alias(f) for f in features])


# --------------------------------------------------------------------------
# rank tests


def mid_ranks(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mid-rank of every distinct value of every feature.

    ``(feature, value, ties, mid_rank, parts)``; ``parts`` counts the value's
    rows per cluster.  Ranking runs on distinct values, not on rows.
    """
    long = to_long(df, features, [cluster]).filter(F.col("value").isNotNull() & F.col(cluster).isNotNull())
    per_cluster = long.groupBy("feature", "value", cluster).agg(F.count(F.lit(1)).alias("c"))
    # the list holds at most one entry per cluster
    values = per_cluster.groupBy("feature", "value").agg(
        F.sum("c").alias("ties"), F.collect_list(F.struct(F.col(cluster).alias("cluster"), F.col("c"))).alias("parts")
    )
    # a feature has no more distinct values than the table has rows
    ranked = running(values, ["feature"], "value", "ties", "sum", "before")
    return ranked.withColumn("mid_rank", F.coalesce("before", F.lit(0)) + (F.col("ties") + 1) / 2).drop("before")


def rank_groups(ranks: DataFrame) -> DataFrame:
    """Per feature and cluster: rows, rank sum, distinct values, value sum; with the feature's total and tie term."""
    ties = F.col("ties").cast("double")
    spread = ranks.select("feature", "value", "mid_rank", ties.alias("ties"), F.posexplode("parts").alias("pos", "part"))
    c = F.col("part.c")
    groups = spread.groupBy("feature", F.col("part.cluster").alias("cluster")).agg(
        F.sum(c).alias("n"),
        F.sum(c * F.col("mid_rank")).alias("rank_sum"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.sum(c * F.col("value")).alias("value_sum"),
        # each value's tie term is counted with the first of its clusters
        F.sum(F.when(F.col("pos") == 0, F.pow("ties", F.lit(3)) - F.col("ties")).otherwise(0.0)).alias("tie_part"),
    )
    every = Window.partitionBy("feature")  # one row per cluster
    return groups.withColumn("total", F.sum("n").over(every)).withColumn("tie_term", F.sum("tie_part").over(every))


def kruskal_wallis(
    df: DataFrame,
    features: Sequence[str],
    cluster: str = "cluster",
    min_effect: float | None = 0.01,
    with_p: bool = True,
) -> DataFrame:
    """Tie-corrected H, p and effect size per feature.

    Features that are constant within any cluster, or absent from one, are left
    out, as are those with an effect below ``min_effect``.
    """
    n_clusters = df.select(F.count_distinct(cluster)).scalar()
    groups = rank_groups(mid_ranks(df, features, cluster))
    n, k = F.col("total").cast("double"), F.col("k")
    agg = (
        groups.groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.min("distinct_values").alias("least_distinct"),
            F.first("total").alias("total"),
            F.first("tie_term").alias("tie_term"),
            F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("s"),
        )
        .filter((F.col("least_distinct") > 1) & (F.col("k") == n_clusters))
    )
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("s") - 3 * (n + 1)
    h = F.try_divide(raw, 1 - F.try_divide("tie_term", n * n * n - n))
    out = agg.withColumn("H", h).withColumn("eta_sq", F.try_divide(F.col("H") - k + 1, n - k))
    if min_effect is not None:
        out = out.filter(F.col("eta_sq") >= min_effect)
    cols = ["feature", "H", "k", F.col("total").alias("n"), "eta_sq"]
    return out.select(*cols, chi_square_p("H", F.col("k") - 1).alias("p")) if with_p else out.select(*cols)


def dunn_pairs(
    df: DataFrame,
    features: Sequence[str],
    cluster: str = "cluster",
    with_p: bool = True,
    alpha: float = 0.05,
) -> DataFrame:
    """Pairwise z on mean ranks with tie correction, Holm-adjusted p per feature, and the pair's means."""
    groups = rank_groups(mid_ranks(df, features, cluster)).select(
        "feature",
        "cluster",
        "n",
        "total",
        "tie_term",
        (F.col("rank_sum") / F.col("n")).alias("mean_rank"),
        (F.col("value_sum") / F.col("n")).alias("mean"),
    )
    a, b = groups.alias("a"), groups.alias("b")
    n = F.col("a.total").cast("double")
    var = (n * (n + 1) / 12 - F.try_divide(F.col("a.tie_term"), 12 * (n - 1))) * (1 / F.col("a.n") + 1 / F.col("b.n"))
    # one row per pair of clusters of a feature: the result itself
    pairs = a.join(b, (F.col("a.feature") == F.col("b.feature")) & (F.col("a.cluster") < F.col("b.cluster"))).select(
        F.col("a.feature").alias("feature"),
        F.col("a.cluster").alias("cluster_a"),
        F.col("b.cluster").alias("cluster_b"),
        F.try_divide(F.col("a.mean_rank") - F.col("b.mean_rank"), F.sqrt(var)).alias("z"),
        F.col("a.mean").alias("mean_a"),
        F.col("b.mean").alias("mean_b"),
        (F.col("b.mean") - F.col("a.mean")).alias("diff_b_minus_a"),
    )
    if not with_p:
        return pairs
    adjusted = holm(pairs.withColumn("p", normal_p("z")), ["feature"], "p", "p_adj", ["cluster_a", "cluster_b"])
    return adjusted.withColumn("significant", F.col("p_adj") < alpha)


# --------------------------------------------------------------------------
# multiple testing (windows run over result tables, one partition per family)


def benjamini_hochberg(df: DataFrame, p: str, name: str, family: Sequence[str] = (), ties: Sequence[str] = ()) -> DataFrame:
    """Step-up false discovery rate; NULL p-values are ignored."""
    fam = [F.col(c) for c in family] or [F.lit(1)]
    known = df.filter(F.col(p).isNotNull() & ~F.isnan(p))
    order = [F.col(p), *[F.col(t) for t in ties]]
    up = Window.partitionBy(*fam).orderBy(*order)
    m = F.count(F.lit(1)).over(Window.partitionBy(*fam))
    ranked = known.withColumn("__rank", F.row_number().over(up)).withColumn("__scaled", F.col(p) * m / F.col("__rank"))
    down = Window.partitionBy(*fam).orderBy(F.col("__rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    adjusted = ranked.withColumn(name, F.least(F.lit(1.0), F.min("__scaled").over(down))).drop("__rank", "__scaled")
    rest = df.filter(F.col(p).isNull() | F.isnan(p)).withColumn(name, F.lit(None).cast("double"))
    return adjusted.unionByName(rest)


def holm(df: DataFrame, family: Sequence[str], p: str, name: str, ties: Sequence[str] = ()) -> DataFrame:
    """Step-down family-wise adjustment."""
    up = Window.partitionBy(*family).orderBy(F.col(p), *[F.col(t) for t in ties])
    m = F.count(F.lit(1)).over(Window.partitionBy(*family))
    scaled = df.withColumn("__s", F.col(p) * (m - F.row_number().over(up) + 1))
    return scaled.withColumn(
        name, F.least(F.lit(1.0), F.max("__s").over(up.rowsBetween(Window.unboundedPreceding, 0)))
    ).drop("__s")


def flag_important(tests: DataFrame, alpha: float = 0.05, effect: float = 0.06) -> DataFrame:
    """Adjusted p per feature and whether it is both significant and large, those first."""
    adjusted = benjamini_hochberg(tests, "p", "p_fdr", ties=["feature"])
    flagged = adjusted.withColumn("consider", F.coalesce((F.col("p_fdr") < alpha) & (F.col("eta_sq") > effect), F.lit(False)))
    return flagged.orderBy(F.col("consider").desc(), F.col("p_fdr").asc(), F.col("feature"))


def compare_clusters(
    df: DataFrame, tests: DataFrame, features: Sequence[str], cluster: str = "cluster"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Means per cluster, adjusted feature tests, and pairwise comparisons."""
    pairs = dunn_pairs(df, features, cluster).orderBy("feature", "p_adj")
    return cluster_means(df, features, cluster), flag_important(tests), pairs


# --------------------------------------------------------------------------
# distances


def _packs(df: DataFrame, most: int) -> DataFrame:
    """(name, data): rows as Arrow bytes, some `most` bytes each; written, so that they can be read again and again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seq = [], 0, 0
        for batch in batches:
            step = max(1, int(most / max(1.0, batch.nbytes / max(1, batch.num_rows))))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                if held and size + part.nbytes > most:
                    yield packed(held, seq)
                    held, size, seq = [], 0, seq + 1
                held.append(part)
                size += part.nbytes
        if held:
            yield packed(held, seq)

    def packed(held: list[pa.RecordBatch], seq: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(held).combine_chunks()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return pa.RecordBatch.from_arrays([pa.array([f"{TaskContext.get().partitionId()}-{seq}"]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["name", "data"])

    return df.mapInArrow(run, "name string, data binary").checkpoint()


def _unpacked(data: bytes, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of a column, which of them are known, vectors)."""
    table = pa.ipc.open_stream(data).read_all()
    vec, x = table["vec"].combine_chunks(), table[column].combine_chunks()
    sizes = set(pc.list_value_length(vec).to_pylist())
    if len(sizes) > 1 or None in sizes:
        raise ValueError("vectors are missing or differ in length")
    vectors = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vec), -1)
    return x.fill_null(_UNKNOWN).to_numpy(zero_copy_only=False).astype(np.int64), x.is_valid().to_numpy(zero_copy_only=False), vectors


class _Staying:
    """Rows that stay in a task, and their summed distances to each cluster of the rows that have passed by."""

    def __init__(self, data: bytes):
        self.ids, self.known, x = _unpacked(data, "id")
        finite = np.where(np.isfinite(x), x, 0.0)
        self.centre = finite.mean(axis=0)  # far from the origin the squares would cancel
        x = x - self.centre
        self.x = np.column_stack([x, (x * x).sum(axis=1), np.ones(len(x))])
        self.sums: dict[int, np.ndarray] = {}
        self.n: dict[int, int] = {}

    def meet(self, data: bytes) -> None:
        clusters, _, y = _unpacked(data, "cluster")
        same, known, _ = _unpacked(data, "same_as")
        y = y - self.centre
        # a product of these and of self.x is a squared distance
        y = np.column_stack([-2.0 * y, np.ones(len(y)), (y * y).sum(axis=1)]).T
        groups, codes = np.unique(clusters, return_inverse=True)
        member = np.zeros((len(codes), len(groups)))
        member[np.arange(len(codes)), codes] = 1.0
        here = known & np.isin(same, self.ids[self.known])
        sums = np.zeros((len(self.x), len(groups)))
        for j in range(0, len(codes), TILE[1]):
            some, among = y[:, j : j + TILE[1]], member[j : j + TILE[1]]
            mine = np.flatnonzero(here[j : j + TILE[1]])
            for i in range(0, len(self.x), TILE[0]):
                d = self.x[i : i + TILE[0]] @ some
                np.maximum(d, 0.0, out=d)
                np.sqrt(d, out=d)
                if len(mine):  # a row is at distance exactly 0 from itself
                    equal = (self.ids[i : i + TILE[0], None] == same[j + mine]) & self.known[i : i + TILE[0], None]
                    at, to = np.nonzero(equal)
                    d[at, mine[to]] = 0.0
                sums[i : i + TILE[0]] += d @ among
        for k, (group, n) in enumerate(zip(groups.tolist(), member.sum(axis=0))):
            self.sums[group] = self.sums[group] + sums[:, k] if group in self.sums else sums[:, k].copy()
            self.n[group] = self.n.get(group, 0) + int(n)

    def result(self) -> bytes:
        groups, rows = list(self.sums), len(self.ids)
        columns = {
            "id": pa.array(np.tile(self.ids, len(groups)), mask=~np.tile(self.known, len(groups))),
            "cluster": np.repeat(np.array(groups, np.int64), rows),
            "dist": np.concatenate([self.sums[g] for g in groups]),
            "n": np.repeat(np.array([self.n[g] for g in groups], np.int64), rows),
        }
        sink, table = pa.BufferOutputStream(), pa.table(columns)
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table, max_chunksize=10_000)
        return sink.getvalue().to_pybytes()


def distance_sums(left: DataFrame, right: DataFrame, block_rows: int = 2048, same_rows: bool = True) -> DataFrame:
    """``(id, cluster, dist, n)``: summed Euclidean distance of each left row to each cluster of ``right``.

    ``same_rows`` says that equal ids on both sides are the same row.

    The distance is not decomposable, so every pair has to be evaluated.  Both sides are written once as packs of bounded
    size.  A pack of left rows stays in a task while the right packs are read past it, so what is shuffled and written grows
    with the rows, and only what is read and computed with the pairs.  No pair is ever emitted as a row.  A task has
    ``block_rows`` left rows at least, or more where there are no cores for more tasks.
    """
    spark = configure(left.sparkSession)
    ensure_checkpoint_dir(spark)
    rows = left.count()
    parts = max(1, -(-rows // STAY_ROWS), min(4 * spark.sparkContext.defaultParallelism, -(-rows // block_rows)))
    a = _packs(left.select("id", "vec").repartition(parts), STAY_BYTES)
    b = _packs(right.select("vec", F.col("cluster").cast("long").alias("cluster"), (F.col("id") if same_rows else F.lit(None).cast("long")).alias("same_as")), PASS_BYTES)

    def run(pairs: Iterator[tuple]) -> Iterator[tuple[bytes]]:
        staying: dict[str, _Staying] = {}
        for (name, data), (_, passing) in pairs:
            if name not in staying:
                staying[name] = _Staying(data)
            staying[name].meet(passing)
        for s in staying.values():
            yield (s.result(),)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield from pa.ipc.open_stream(data.as_py())

    # one partition of the right packs: they are read one after the other, never held together
    found = a.rdd.cartesian(b.rdd.coalesce(1)).mapPartitions(run)
    sums = spark.createDataFrame(found, "data binary").mapInArrow(rows_of, "id long, cluster long, dist double, n long")
    return sums.groupBy("id", "cluster").agg(F.sum("dist").alias("dist"), F.sum("n").alias("n"))


def _silhouette_from(sums: DataFrame, own: DataFrame, self_in_own: int) -> DataFrame:
    """Silhouette per row from mean distances; ``self_in_own`` is 1 when the row itself is among the cluster's rows."""
    mine = F.col("cluster") == F.col("own")
    joined = sums.join(own, "id")
    per_row = joined.groupBy("id").agg(
        F.first("own").alias("cluster"),
        F.max(F.when(mine, F.col("n"))).alias("n_own"),
        F.max(F.when(mine, F.try_divide("dist", F.col("n") - self_in_own))).alias("a"),
        F.min(F.when(~mine, F.col("dist") / F.col("n"))).alias("b"),
    )
    s = F.when(F.col("n_own") - self_in_own < 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return per_row.select("id", "cluster", s.alias("silhouette"))


def silhouette(points: DataFrame, block_rows: int = 2048) -> DataFrame:
    """Exact Euclidean silhouette per row of ``(id, vec, cluster)``; its cost grows with the square of the rows."""
    own = points.select("id", F.col("cluster").cast("long").alias("own"))
    return _silhouette_from(distance_sums(points, points, block_rows), own, 1)


def _cluster_moments(points: DataFrame) -> DataFrame:
    """Per cluster: rows, mean vector, mean squared norm; one small row each."""
    dims = points.select("cluster", F.posexplode("vec").alias("dim", "x"))
    means = dims.groupBy("cluster", "dim").agg(F.avg("x").alias("m"), F.avg(F.col("x") * F.col("x")).alias("q"), F.count(F.lit(1)).alias("n"))
    # a list entry per dimension
    return means.groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("center"),
        F.sum("q").alias("sq_norm"),
        F.max("n").alias("n"),
    )


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def silhouette_squared(points: DataFrame) -> DataFrame:
    """Silhouette with squared Euclidean distances, in linear time from cluster moments; for large tables."""
    m = _cluster_moments(points)
    table = m.agg(F.collect_list(F.struct("cluster", "center", "sq_norm", "n")).alias("all"))  # one entry per cluster
    own = points.select("id", "vec", F.col("cluster").alias("own"))
    joined = own.withColumn("all", table.scalar()).withColumn("norm", _dot(F.col("vec"), F.col("vec")))
    # mean squared distance to every cluster, side by side in the row; nothing is shuffled after the moments
    means = F.transform(
        "all",
        lambda c: F.struct(c["cluster"].alias("cluster"), c["n"].alias("n"), F.greatest(F.col("norm") + c["sq_norm"] - 2 * _dot(F.col("vec"), c["center"]), F.lit(0.0)).alias("d")),
    )
    told = joined.select("id", "own", means.alias("means")).select(
        "id", "own",
        F.element_at(F.filter("means", lambda c: c["cluster"] == F.col("own")), 1).alias("mine"),
        F.array_min(F.transform(F.filter("means", lambda c: c["cluster"] != F.col("own")), lambda c: c["d"])).alias("b"),
    )
    within = F.try_divide(F.col("mine.d") * F.col("mine.n"), F.col("mine.n") - 1)
    s = F.when(F.col("mine.n") <= 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(F.col("b") - within, F.greatest(F.col("b"), within)), F.lit(0.0)))
    return told.select("id", F.col("own").cast("long").alias("cluster"), s.alias("silhouette"))


def davies_bouldin(points: DataFrame) -> DataFrame:
    """One row: mean over clusters of the worst (scatter_i + scatter_j) / distance_ij."""
    centers = _cluster_moments(points).select("cluster", "center")
    dist = lambda a, b: F.sqrt(
        F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
    )
    scatter = (
        points.select("cluster", "vec")
        .join(centers, "cluster")
        .groupBy("cluster")
        .agg(F.avg(dist(F.col("vec"), F.col("center"))).alias("s"))
    )
    table = centers.join(scatter, "cluster").agg(F.collect_list(F.struct("cluster", "center", "s")).alias("all"))
    # clusters against clusters: an array of a few entries
    ratios = F.transform(
        "all",
        lambda i: F.array_max(
            F.transform(
                F.filter("all", lambda j: j["cluster"] != i["cluster"]),
                lambda j: F.coalesce(F.try_divide(i["s"] + j["s"], dist(i["center"], j["center"])), F.lit(0.0)),
            )
        ),
    )
    mean = F.aggregate(ratios, F.lit(0.0), lambda s, v: s + v) / F.size("all")
    return table.select(mean.alias("davies_bouldin"))


# --------------------------------------------------------------------------
# models on X and y


def prepare_xy(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric features and target; unreadable values are NULL and rows without a target go."""
    require_columns(df, [*features, target])
    out = df.select(*keep, *[to_double(F.col(f"`{c}`")).alias(c) for c in [*features, target]])
    return out.filter(F.col(f"`{target}`").isNotNull())


def binarise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """1 where a listed column is above zero, else 0 (NULL counts as 0)."""
    flags = {c: F.coalesce((F.col(f"`{c}`") > 0).cast("double"), F.lit(0.0)) for c in columns}
    return df.select(*[(flags[c] if c in flags else F.col(f"`{c}`")).alias(c) for c in df.columns])


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values become their column's median (one number per column comes back)."""
    found = {r["feature"]: r["median"] for r in column_quantiles(df, columns, [0.5], ["median"]).collect()}
    return df.fillna({f"{c}": v for c, v in found.items() if v is not None}) if found else df


def _sum_matrices(df: DataFrame, columns: Sequence[str], size: int, block) -> np.ndarray:
    """Sum over all rows of ``block(values)``, a ``size`` x ``size`` matrix per batch; partial sums per partition."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            total += block(batch.to_numpy(dtype="float64"))
        i, j = np.indices((size, size))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    parts = rows.mapInPandas(partial, "i int, j int, v double")
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # size * size numbers
        out[r["i"], r["j"]] = r["v"]
    return out


def _independent(corr: np.ndarray, tolerance: float = 1e-10) -> list[int]:
    """Columns that are no linear combination of those chosen before them, from a correlation matrix."""
    left, chosen = corr.astype(float).copy(), []
    for j in range(len(left)):
        if left[j, j] > tolerance:
            chosen.append(j)
            left = left - np.outer(left[:, j], left[j]) / left[j, j]
    return chosen


def linear_associations(
    df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.05, log_target: bool = True
) -> DataFrame:
    """Least squares with HC3 standard errors: coefficient, p, percentage change, adjusted p.

    Pass one finds means and spreads; pass two sums the products of the centred
    and scaled columns, so large offsets cancel nothing; pass three sums the
    leverage-weighted squared residuals.  Only matrices of the size of the
    feature list reach the driver.  A feature that is constant, or a linear
    combination of those before it, has no estimable effect and is reported
    with NULLs.  A missing value is an error.
    """
    y = F.log1p(F.col(f"`{target}`")) if log_target else F.col(f"`{target}`")
    data = df.select(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)], y.cast("double").alias("y"))
    n_features = len(features)
    found = data.agg(*[f(c).alias(f"{n}_{c}") for c in data.columns for n, f in (("mean", F.avg), ("sd", F.stddev_pop), ("n", F.count))], F.count("*").alias("rows")).first()
    missing = [name for name, c in zip([*features, target], data.columns) if found[f"n_{c}"] < found["rows"] or found[f"mean_{c}"] != found[f"mean_{c}"]]
    if missing:
        raise ValueError(f"missing values in {missing}")
    mean = np.array([found[f"mean_{c}"] or 0.0 for c in data.columns])
    sd = np.array([found[f"sd_{c}"] or 0.0 for c in data.columns])
    varying = [i for i in range(n_features) if sd[i] > 1e-12 * max(1.0, abs(mean[i]))]
    scaled = data.select(
        F.lit(1.0).alias("const"), *[((F.col(f"x{i}") - float(mean[i])) / float(sd[i])).alias(f"x{i}") for i in varying], (F.col("y") - float(mean[-1])).alias("y")
    )
    gram = _sum_matrices(scaled, scaled.columns, len(varying) + 2, lambda m: m.T @ m)
    kept = [0] + [j + 1 for j in _independent(gram[1:-1, 1:-1] / max(found["rows"], 1))]
    inverse = np.linalg.inv(gram[np.ix_(kept, kept)]) if found["rows"] else np.zeros((len(kept), len(kept)))
    beta = inverse @ gram[kept, -1]

    def meat(m: np.ndarray) -> np.ndarray:
        x, resid = m[:, kept], m[:, -1] - m[:, kept] @ beta
        leverage = np.einsum("ij,jk,ik->i", x, inverse, x)
        w = (resid / np.maximum(1.0 - leverage, 1e-12)) ** 2
        return (x * w[:, None]).T @ x

    cov = inverse @ _sum_matrices(scaled, scaled.columns, len(kept), meat) @ inverse
    se = np.sqrt(np.diag(cov))
    effect = {varying[j - 1]: (beta[k] / sd[varying[j - 1]], se[k] / sd[varying[j - 1]]) for k, j in enumerate(kept) if j}
    rows = []
    for i, name in enumerate(features):
        b, s = effect.get(i, (None, None))
        pv = normal_two_sided(b / s) if s else None
        rows.append((name, None if b is None else float(b), None if s is None else float(s), pv, None if b is None else float((np.exp(b) - 1.0) * 100.0)))
    table = df.sparkSession.createDataFrame(rows, "feature string, coef double, std_err double, p_value double, approx_pct_change double")
    if not log_target:
        table = table.drop("approx_pct_change")
    return _finish_associations(table, alpha)


def _finish_associations(table: DataFrame, alpha: float) -> DataFrame:
    q = benjamini_hochberg(table, "p_value", "q_value", ties=["feature"])
    flagged = q.withColumn("significant", F.coalesce(F.col("q_value") < alpha, F.lit(False)))
    return flagged.orderBy("q_value", "p_value", "feature")
