"""Order-dependent aggregates that stay bounded when one group holds most rows.

Counts, sums, minima and arg-minima are pre-aggregated by Spark before the
shuffle, so a hot group costs nothing special there.  Exact quantiles, running
aggregates, ranks and rolling frames need their group in order.  Each function
here has one plan for every size: a mergeable sketch or the time itself cuts a
group into pieces, so no task needs a whole group and nothing is counted while
the plan is built.  NULL keys form a group of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1024  # slices of a group that get row numbers
CUTS = 255  # cut points of a group in which running aggregates are carried on
ACCURACY = 10_000  # a sketched rank is wrong by at most 1/ACCURACY of the group


def _joined(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys in which NULL equals NULL; keys come from ``a``."""
    named = b.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in set(keys)])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return a.join(named, on).drop(*[f"__k{i}" for i in range(len(keys))])


# --------------------------------------------------------------------------
# exact quantiles


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact linearly interpolated quantiles of ``value`` per group, NULLs ignored.

    A first pass sketches a bracket around each rank; a second counts the rows
    below it and the values inside, which are at most 4/ACCURACY of the group
    (or a group of at most 4 * ACCURACY rows).  Only those are put in order.
    """
    keys, probs, names = list(keys), [float(p) for p in probs], list(names)
    rows = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    ends = [min(1.0, max(0.0, p + side * 2.0 / ACCURACY)) for p in probs for side in (-1, 1)]
    sketch = rows.groupBy(*keys).agg(
        F.count("__v").alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"), F.percentile_approx("__v", ends, ACCURACY).alias("__q")
    )
    small = F.col("__n") <= 4 * ACCURACY
    brackets = [
        F.struct(
            F.lit(i).alias("t"),
            F.when(small | F.lit(p <= 2.0 / ACCURACY), F.col("__min")).otherwise(F.col("__q")[2 * i]).alias("lo"),
            F.when(small | F.lit(p >= 1 - 2.0 / ACCURACY), F.col("__max")).otherwise(F.col("__q")[2 * i + 1]).alias("hi"),
        )
        for i, p in enumerate(probs)
    ]
    bracketed = _joined(rows, sketch.select(*keys, "__n", F.array(*brackets).alias("__b")), keys).select(*keys, "__n", "__v", F.explode("__b").alias("__b"))
    inside = bracketed.filter(F.col("__v") <= F.col("__b.hi")).select(
        *keys, "__n", F.col("__b.t").alias("__t"), F.when(F.col("__v") >= F.col("__b.lo"), F.col("__v")).alias("__v")
    )
    counts = inside.groupBy(*keys, "__n", "__t", "__v").agg(F.count(F.lit(1)).alias("__c"))
    # rows below the bracket are one NULL value, which comes first
    w = Window.partitionBy(*keys, "__t").orderBy(F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("__upto", F.sum("__c").over(w))

    def at(i: int, p: float) -> Column:
        place = (F.col("__n") - 1) * F.lit(p)
        value_at = lambda rank: F.min(F.when((F.col("__t") == i) & (F.col("__upto") > rank), F.col("__v")))
        low, high, share = value_at(F.floor(place)), value_at(F.ceil(place)), F.first(place - F.floor(place))
        # the sketch is only trusted as far as the counts bear it out
        mine = F.col("__t") == i
        lost = F.bool_or(mine & F.col("__v").isNull() & (F.col("__upto") > F.floor(place))) | (F.max(F.when(mine, F.col("__upto"))) <= F.first(F.ceil(place)))
        return F.when(lost, F.raise_error(F.lit("a quantile's rank lies outside its bracket")).cast("double")).otherwise((1 - share) * low + share * high)

    return upto.groupBy(*keys).agg(*[at(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names))])


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return exact_quantiles(df, keys, value, [0.5], [name])


# --------------------------------------------------------------------------
# running aggregates


def running(df: DataFrame, keys: Sequence[str], order: str, value: str, how: str, name: str) -> DataFrame:
    """Add ``how`` ('sum' or 'max') of ``value`` over rows with a strictly smaller ``order`` in the group.

    ``(keys, order)`` must be unique.  NULL where no earlier row exists.  A
    group is cut at its approximate order quantiles, from a sketch of fixed
    size; pieces run on their own and carry on the total of those before.
    """
    keys = list(keys)
    fn = {"sum": F.sum, "max": F.max}[how]
    before = Window.unboundedPreceding, -1
    cuts = df.groupBy(*keys).agg(F.percentile_approx(order, [i / (CUTS + 1) for i in range(1, CUTS + 1)], 10 * CUTS).alias("__cuts"))
    # two short looks into the sorted cuts: every 16th first, then the 15 in between
    below = lambda arr: F.coalesce(F.size(F.filter(arr, lambda x: x < F.col(order))), F.lit(0))
    coarse = F.transform(F.sequence(F.lit(16), F.lit(CUTS), F.lit(16)), lambda i: F.element_at("__cuts", i))
    celled = (
        _joined(df, cuts.withColumn("__coarse", coarse), keys)
        .withColumn("__big", below(F.col("__coarse")))
        .withColumn("__cell", F.col("__big") * 16 + below(F.slice("__cuts", F.col("__big") * 16 + 1, 15)))
        .drop("__cuts", "__coarse", "__big")
    )
    per_cell = celled.groupBy(*keys, "__cell").agg(fn(value).alias("__total"))
    carry = per_cell.withColumn("__carry", fn("__total").over(Window.partitionBy(*keys).orderBy("__cell").rowsBetween(*before))).drop("__total")
    local = _joined(celled.withColumn(name, fn(value).over(Window.partitionBy(*keys, "__cell").orderBy(order).rowsBetween(*before))), carry, [*keys, "__cell"])
    if how == "sum":
        both = F.when(F.col(name).isNull() & F.col("__carry").isNull(), None).otherwise(
            F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col("__carry"), F.lit(0))
        )
    else:
        both = F.greatest(name, "__carry")
    return local.withColumn(name, both).select(*df.columns, name)


# --------------------------------------------------------------------------
# trailing minimum


def trailing_min(df: DataFrame, entity: str, at_us: str, value: str, width_us: int, name: str) -> DataFrame:
    """Add the minimum of ``value`` over the entity's rows in ``(t - width, t]``; rows with equal times are peers.

    Time is cut into cells as wide as the frame, and every row is also copied
    into the next cell, moved by one width.  The frame is then the own rows up
    to t and the moved rows after t, so both parts are running minima and no
    row is read again for each frame.  Rows without a time are peers of each
    other.
    """
    t = F.col(at_us)
    at_cell = F.floor(t / width_us).cast("long")
    place = lambda own, at, c: F.struct(F.lit(own).alias("own"), at.cast("long").alias("at"), c.alias("cell"))
    # both places of a row from one read of it; a row without a time has one
    places = F.when(t.isNull(), F.array(place(True, t, at_cell))).otherwise(F.array(place(True, t, at_cell), place(False, t + width_us, at_cell + 1)))
    both = df.select("*", F.explode(places).alias("__p")).withColumns({"__own": F.col("__p.own"), "__at": F.col("__p.at"), "__cell": F.col("__p.cell")})
    cell = Window.partitionBy(entity, "__cell")
    up_to = F.min(F.when(F.col("__own"), F.col(value))).over(cell.orderBy("__at").rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(~F.col("__own"), F.col(value))).over(cell.orderBy(F.col("__at").desc()).rangeBetween(Window.unboundedPreceding, -1))
    both = both.withColumns({"__up_to": up_to, "__after": after}).filter("__own")
    return both.select(*df.columns, F.least("__up_to", "__after").alias(name))


# --------------------------------------------------------------------------
# row numbers


def spread_row_number(df: DataFrame, keys: Sequence[str], hash_col: str, name: str, cells: int = CELLS) -> DataFrame:
    """Zero-based row number per group in the order of an evenly spread, unique hash.

    Equal-width slices of the hash are numbered on their own and shifted by the
    size of the slices before them, so even a single huge group is spread out.
    """
    keys = list(keys)
    sliced = df.withColumn("__slice", F.pmod(F.col(hash_col), F.lit(cells)))
    sizes = sliced.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__slice", F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__off"))
    local = F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy(hash_col)) - 1
    return (
        sliced.withColumn("__local", local)
        .join(offsets, [*keys, "__slice"])
        .withColumn(name, F.col("__off") + F.col("__local"))
        .drop("__slice", "__local", "__off")
    )
