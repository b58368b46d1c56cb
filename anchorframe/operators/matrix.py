"""The one-row-per-entity matrix: assembly, cleaning, imputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorframe.functions.scalar import half_even
from anchorframe.operators.skew import exact_quantiles
from anchorframe.operators.windows import restrict_to_cohort


_KEEP = "__keep"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class FeatureBlock:
    """Long features of one builder.

    ``fill`` says what an absent feature means: ``None`` keeps NULL, ``"all"``
    gives 0 to every entity, ``"present"`` gives 0 to entities that have any
    feature of this block.
    """

    rows: DataFrame
    features: tuple[str, ...]
    fill: str | None = None
    prefix: str = ""
    digits: int | None = None

    @property
    def columns(self) -> list[str]:
        return [self.prefix + f for f in self.features]


def assemble_matrix(
    cohort: DataFrame,
    blocks: Sequence[FeatureBlock],
    required: FeatureBlock | None = None,
    keep_empty: Sequence[str] = (),
) -> DataFrame:
    """All blocks as one matrix: one union of long features and one pivot.

    With ``required``, only cohort entities with a feature of that block stay.
    Rows whose features (other than ``keep_empty``) are all NULL or zero go.
    """
    every = [*([required] if required else []), *blocks]
    names = [c for b in every for c in b.columns]
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"feature names used by more than one block: {sorted(twice)}")

    kept = {"entity", *keep_empty}

    def rows(b: FeatureBlock) -> DataFrame:
        value = half_even(F.col("value").cast("double"), b.digits)
        named = b.rows.filter(F.col("feature").isin(list(b.features))).select(
            "entity", F.concat(F.lit(b.prefix), F.col("feature")).alias("feature"), value.alias("value")
        )
        counted = [c for c in b.columns if c not in kept]
        if not counted:
            return named
        # A value that keeps its entity in the matrix is accompanied by a mark, so that
        # emptiness is one column of the pivot, not a condition over all of them.
        counts = F.col("feature").isin(counted) & (F.col("value") != 0)
        marked = F.array(
            F.struct(F.col("feature").alias("feature"), F.col("value").alias("value")),
            F.struct(F.when(counts, F.lit(_KEEP)).alias("feature"), F.lit(1.0).alias("value")),
        )
        return named.select("entity", F.inline(marked))

    members = cohort.select("entity").distinct()
    if required is not None:
        wanted = required.rows.filter(F.col("feature").isin(list(required.features)))
        members = restrict_to_cohort(members, wanted)
    long = reduce(DataFrame.unionByName, [rows(b) for b in every])
    pivoted = long.groupBy("entity").pivot("feature", [*names, _KEEP]).agg(F.max("value"))
    wide = members.join(pivoted.filter(F.col(_KEEP).isNotNull()), "entity")

    out: list[Column] = [F.col("entity")]
    for b in every:
        seen = F.coalesce(*[_q(c) for c in b.columns]).isNotNull()
        for c in b.columns:
            x = _q(c)
            if b.fill == "all":
                x = F.coalesce(x, F.lit(0.0))
            elif b.fill == "present":
                x = F.when(seen, F.coalesce(x, F.lit(0.0)))
            out.append(x.alias(c))
    return wide.select(*out)


def chain_join(base: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Left-join one-row-per-entity tables; repeated column names are an error."""
    for part in parts:
        twice = (set(base.columns) & set(part.columns)) - {"entity"}
        if twice:
            raise ValueError(f"columns appear twice: {sorted(twice)}")
        base = base.join(part, "entity", "left")
    return base


def drop_empty_rows(df: DataFrame, keep: Sequence[str], key: str = "entity") -> DataFrame:
    """Drop rows in which every column outside ``keep`` is NULL or zero.  Rows are told apart by ``key``, which may be NULL."""
    checked = [c for c in df.columns if c not in {*keep, key}]
    if not checked:
        return df
    # Catalyst derives 2**n constraints from one condition over n renamed columns; behind a generator it does not.
    busy = df.select(_q(key).alias("__key"), F.explode(F.array(*[F.coalesce(_q(c) != 0, F.lit(False)) for c in checked])).alias("__busy"))
    return df.join(busy.filter("__busy").select("__key"), _q(key).eqNullSafe(F.col("__key")), "left_semi")


def drop_zero_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns with no value other than zero (NULL counts as a value, as in a fresh pivot)."""
    checked = [c for c in df.columns if c not in set(keep)]
    if not checked:
        return df
    used = df.agg(*[F.bool_or(F.coalesce(_q(c) != 0, F.lit(True))).alias(c) for c in checked]).first()
    return df.select(*[_q(c) for c in df.columns if c not in checked or used[c]])


def null_counts(df: DataFrame) -> DataFrame:
    """``(feature, missing)`` for every column, from one pass."""
    counts = df.agg(*[F.count_if(_q(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("missing")) for i, c in enumerate(df.columns)]
    )
    return counts.select(F.inline(pairs))


def to_long(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """``(extra..., feature, value)`` rows of the listed columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), _q(c).cast("double").alias("value")) for c in columns])
    return df.select(*[_q(c) for c in extra], F.inline(pairs))


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str],
) -> DataFrame:
    """``(feature, names...)``: exact quantiles of every listed column."""
    return exact_quantiles(to_long(df, columns), ["feature"], "value", probs, names)


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return column_quantiles(df, columns, [0.5], ["median"])


def _filled(df: DataFrame, c: str, fill: float) -> Column:
    """The column with NULLs filled; an integer column becomes double when its fill has a fraction."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.IntegralType) and float(fill) != int(fill):
        kind = T.DoubleType()
    return F.coalesce(_q(c).cast(kind), F.lit(fill).cast(kind)).alias(c)


def impute_matrix(
    df: DataFrame,
    median_columns: Sequence[str],
    drop: Sequence[str] = (),
    entity: str = "entity",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Median for the named columns, 0 for the rest; returns (missing report, medians, matrix)."""
    df = df.drop(*drop)
    median_table = medians(df, median_columns)
    # a handful of numbers: one per named column
    found = {r["feature"]: r["median"] for r in median_table.collect()}
    fills = {c: (found.get(c) if c in set(median_columns) else 0) for c in df.columns if c != entity}
    filled = df.select(
        *[
            _q(c) if fills.get(c) is None else _filled(df, c, fills[c])
            for c in df.columns
        ]
    )
    return null_counts(filled), median_table, filled


def fill_from_constants(df: DataFrame, constants: dict[str, float], entity: str = "entity") -> DataFrame:
    """Given constants for listed columns, 0 for the other numeric ones."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() not in ("string", "timestamp", "date", "boolean")}
    return df.select(
        *[
            _filled(df, c, constants.get(c, 0))
            if c in numeric and c != entity
            else _q(c)
            for c in df.columns
        ]
    )
