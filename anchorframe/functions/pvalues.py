"""Tail probabilities, as plain functions and as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def chi_square_tail(x: float, df: int) -> float:
    """P(X > x) for a chi-square variable with a whole number of degrees of freedom."""
    if x is None or df is None or math.isnan(x) or df < 1:
        return math.nan
    if x <= 0:
        return 1.0
    half = x / 2
    if df % 2 == 0:
        start, total = 1.0, math.exp(-half)
    else:
        start, total = 0.5, math.erfc(math.sqrt(half))
    # Q(a + 1, h) = Q(a, h) + h^a e^-h / gamma(a + 1), stepping a up to df / 2
    a = start
    while a < df / 2 - 1e-9:
        total += math.exp(a * math.log(half) - half - math.lgamma(a + 1))
        a += 1
    return min(total, 1.0)


def normal_two_sided(z: float) -> float:
    return math.nan if z is None or math.isnan(z) else math.erfc(abs(z) / math.sqrt(2))


#: Terms of the series and of the continued fraction; both have converged to a double long before.
TERMS = 90


def erfc(y: Column) -> Column:
    """Complementary error function of y >= 0: a series of positive terms up to 3, a continued fraction beyond."""
    y2 = y * y
    first = F.struct(y.alias("term"), y.alias("sum"))

    def step(acc: Column, n: Column) -> Column:
        term = acc["term"] * 2 * y2 / (2 * n + 1)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), first, step)["sum"]
    fraction = F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, n: (n / 2.0) / (y + acc))
    root = math.sqrt(math.pi)
    return F.when(y < 3, 1 - F.lit(2 / root) * F.exp(-y2) * series).otherwise(F.exp(-y2) / (F.lit(root) * (y + fraction)))


def normal_p(z: Column | str) -> Column:
    """Two-sided p of a standard normal; NULL for NULL and NaN."""
    z = F.col(z) if isinstance(z, str) else z
    return F.when(~F.isnan(z), erfc(F.abs(z) / F.lit(math.sqrt(2))))


def chi_square_p(x: Column | str, df: Column) -> Column:
    """P(X > x) of a chi-square variable with a whole number of degrees of freedom (a finite sum); NULL below one."""
    x = F.col(x) if isinstance(x, str) else x
    half = F.greatest(x, F.lit(0.0)) / 2
    odd = df % 2 == 1
    # even: sum of half^i / i!, odd: of half^(i - 1/2) / gamma(i + 1/2), with i from 1 and terms each from the one before
    steps = F.when(odd, (df - 1) / 2).otherwise(df / 2 - 1).cast("int")
    start = F.when(odd, F.lit(2 / math.sqrt(math.pi)) * F.sqrt(half)).otherwise(F.lit(1.0))
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    first = F.struct(start.alias("term"), F.when(odd, F.lit(0.0)).otherwise(F.lit(1.0)).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        # the odd sum begins with its first term, the even one with the term before
        term = F.when(odd & (i == 1), acc["term"]).otherwise(acc["term"] * half / (F.when(odd, i - shift).otherwise(i.cast("double"))))
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.aggregate(F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")), first, step)["sum"]
    tail = F.exp(-half) * total + F.when(odd, erfc(F.sqrt(half))).otherwise(F.lit(0.0))
    return F.when((df >= 1) & x.isNotNull() & ~F.isnan(x), F.least(F.lit(1.0), tail))
