"""The ways for hot groups give the same exact answers as the plain ones."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from anchorframe.core import HOUR
from anchorframe.operators import features as ft
from anchorframe.operators import skew


@pytest.fixture(scope="module")
def table(spark):
    """One group holds a third of the rows; values tie heavily in another."""
    rng = np.random.default_rng(7)
    n = 3000
    g = np.where(np.arange(n) % 3 == 0, 0, np.arange(n) % 11 + 1)
    v = np.where(g == 1, rng.integers(0, 4, n), rng.lognormal(0, 4, n))
    v[g == 2] = -v[g == 2]
    t = rng.permutation(n) * 60_000_000
    return pd.DataFrame({"g": g.astype("int64"), "v": v.astype("float64"), "t": t.astype("int64")})


def both_sizes(monkeypatch, small):
    """The pieces as they are for large groups, or as they are."""
    if small:
        monkeypatch.setattr(skew, "ACCURACY", 50)
        monkeypatch.setattr(skew, "CUTS", 31)


@pytest.mark.parametrize("small", [True, False])
def test_exact_quantiles(spark, table, small, monkeypatch):
    both_sizes(monkeypatch, small)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    names = ["a", "b", "c", "d", "e"]
    got = skew.exact_quantiles(spark.createDataFrame(table), ["g"], "v", probs, names).toPandas().set_index("g")
    want = table.groupby("g")["v"].quantile(probs).unstack()
    assert len(got) == len(want)
    np.testing.assert_allclose(got.loc[want.index, names].to_numpy(), want.to_numpy(), rtol=1e-9)


def test_quantiles_ignore_null_and_single_values(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", None), ("b", 2.0), ("b", 2.0), ("b", 2.0)], "k string, v double")
    got = {r["k"]: r["m"] for r in skew.exact_median(df, ["k"], "v", "m").collect()}
    assert got == {"a": 5.0, "b": 2.0}


@pytest.mark.parametrize("small", [True, False])
def test_quantiles_with_null_group_and_one_extreme_value(spark, small, monkeypatch):
    both_sizes(monkeypatch, small)
    rng = np.random.default_rng(3)
    values = np.r_[rng.integers(0, 50, 2999) / 7.0, 1e300]
    df = spark.createDataFrame([(None, float(v)) for v in values] + [("a", 1.0)], "k string, v double")
    got = {r["k"]: (r["m"], r["h"]) for r in skew.exact_quantiles(df, ["k"], "v", [0.5, 0.99], ["m", "h"]).collect()}
    np.testing.assert_allclose(got[None], np.quantile(values, [0.5, 0.99]), rtol=1e-12)
    assert got["a"] == (1.0, 1.0)


@pytest.mark.parametrize("how", ["sum", "max"])
@pytest.mark.parametrize("small", [True, False])
def test_running(spark, table, how, small, monkeypatch):
    both_sizes(monkeypatch, small)
    df = spark.createDataFrame(table)
    got = skew.running(df, ["g"], "t", "v", how, "r").toPandas().sort_values(["g", "t"])
    s = table.sort_values(["g", "t"])
    prefix = s.groupby("g")["v"].cumsum() if how == "sum" else s.groupby("g")["v"].cummax()
    want = prefix.groupby(s["g"]).shift(1)
    assert len(got) == len(s)
    np.testing.assert_allclose(got["r"].to_numpy(dtype=float), want.to_numpy(), rtol=1e-6, atol=1e-6)


def test_trailing_min(spark, table):
    width = 48 * HOUR
    extra = table.assign(t=table["t"] // (3 * HOUR) * HOUR)  # many tied times, some exactly 48 h apart
    df = spark.createDataFrame(extra)
    got = skew.trailing_min(df, "g", "t", "v", width, "m").toPandas()
    for _, grp in got.groupby("g"):
        t, v = grp["t"].to_numpy(), grp["v"].to_numpy()
        want = [v[(t > x - width) & (t <= x)].min() for x in t]
        np.testing.assert_array_equal(grp["m"].to_numpy(), want)
    assert len(got) == len(extra)


def test_row_numbers_are_dense(spark, table):
    df = spark.createDataFrame(table).withColumn("h", F.xxhash64("t"))
    got = skew.spread_row_number(df, ["g"], "h", "i", cells=16).toPandas()
    for _, grp in got.groupby("g"):
        assert sorted(grp["i"]) == list(range(len(grp)))


def test_trailing_min_passes_missing_times_and_entities_through(spark):
    rows = [(1, 5, 3.0), (1, 7, 4.0), (1, 14, 9.0), (1, 15, 8.0), (1, None, 1.0), (1, None, None), (None, 5, 2.0), (None, None, 6.0), (1, -3, 7.0)]
    got = skew.trailing_min(spark.createDataFrame(rows, "g long, t long, v double"), "g", "t", "v", 10, "m").collect()
    want = {(1, 5): 3.0, (1, 7): 3.0, (1, 14): 3.0, (1, 15): 4.0, (1, None): 1.0, (None, 5): 2.0, (None, None): 6.0, (1, -3): 7.0}
    assert len(got) == len(rows) and all(r.m == want[r.g, r.t] for r in got)


def test_covered_time_against_a_sequential_merge(spark, table):
    pieces = spark.createDataFrame(table).select(
        "g", F.col("t").alias("s_us"), (F.col("t") + F.abs(F.col("v")).cast("long") * 1_000_000 + 1).alias("e_us")
    )
    plain = sorted(map(tuple, ft.covered_time(pieces, ["g"]).collect()))
    p = pieces.toPandas()
    for g, covered, islands in plain:
        total, n, reach = 0, 0, None
        for s, e in sorted(zip(p[p.g == g].s_us, p[p.g == g].e_us)):
            if reach is None or s > reach:
                n, total, reach = n + 1, total + e - s, e
            elif e > reach:
                total, reach = total + e - reach, e
        assert (covered, islands) == (total, n)
