"""Anchor-relative joins.

Every join carries the entity key, so Spark plans an equi-join with the time
condition as a residual, broadcasts the anchors when they are small at run
time, and splits a hot entity's partition otherwise (see ``session.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorframe.core import TimeWindow, offset_us


def restrict_to_cohort(df: DataFrame, cohort: DataFrame, entity: str = "entity") -> DataFrame:
    """Rows of entities that appear in the cohort."""
    return df.join(cohort.select(entity), entity, "left_semi")


def attach_bridge(df: DataFrame, bridge: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Replace a visit key by its entity through a ``(key, entity)`` bridge."""
    return df.join(bridge.select(key, "entity").distinct(), key, how).drop(key)


def _anchored(df: DataFrame, anchors: DataFrame) -> DataFrame:
    keep = [c for c in anchors.columns if c == "entity" or c not in df.columns]
    return df.join(anchors.select(*keep).filter(F.col("anchor_ts").isNotNull()), "entity", "inner")


def in_window(df: DataFrame, anchors: DataFrame, window: TimeWindow, ts: str = "ts") -> DataFrame:
    """Rows whose ``ts`` (or start, or end) lies in the window around the entity's anchor."""
    return _anchored(df, anchors).filter(window.contains(ts))


def overlapping(df: DataFrame, anchors: DataFrame, window: TimeWindow, strict: bool = False) -> DataFrame:
    """Intervals that meet the window; a missing end drops the row."""
    return _anchored(df, anchors).filter(window.overlaps(strict=strict))


def clipped(df: DataFrame, anchors: DataFrame, window: TimeWindow) -> DataFrame:
    """Intervals cut to the window as ``s_us``/``e_us``; a missing end means an instant; only positive lengths stay."""
    a = _anchored(df, anchors)
    start = offset_us("start_ts")
    end = F.coalesce(offset_us("end_ts"), start)
    cut = a.withColumn("s_us", F.greatest(start, F.lit(window.lo))).withColumn("e_us", F.least(end, F.lit(window.hi)))
    return cut.filter(F.col("start_ts").isNotNull() & (F.col("e_us") > F.col("s_us")))


def nearest_record(
    df: DataFrame, anchors: DataFrame, value: str, target_offset_us: int, ts: str = "ts", name: str | None = None
) -> DataFrame:
    """Per entity, the non-null ``value`` recorded closest in time to anchor + offset; the earlier one on ties.

    Entities without an anchor keep their first recorded value.
    """
    a = df.filter(F.col(value).isNotNull()).join(anchors.select("entity", "anchor_ts"), "entity", "left")
    far = F.lit(2**62)
    gap = F.coalesce(F.abs(offset_us(ts) - F.lit(target_offset_us)), far)
    return a.groupBy("entity").agg(F.min_by(value, F.struct(gap, F.col(ts), F.col(value))).alias(name or value))


def arg_first(target: Column | str, *order: Column | str) -> Column:
    """Aggregate: ``target`` of the first row in the given order."""
    return F.min_by(target, F.struct(*order))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; a partial aggregate, not a window."""
    rest = [c for c in df.columns if c not in keys]
    ranked = [F.col(c) for c in order] + [F.col(c) for c in rest if c not in order]
    pick = F.min(F.struct(*[r.alias(f"o{i}") for i, r in enumerate(ranked)])).alias("__first")
    names = order + [c for c in rest if c not in order]
    picked = df.groupBy(*keys).agg(pick)
    by_name = {n: F.col(f"__first.o{i}").alias(n) for i, n in enumerate(names)}
    return picked.select(*[F.col(c) if c in keys else by_name[c] for c in df.columns])


def without(df: DataFrame, other: DataFrame, entity: str = "entity") -> DataFrame:
    """Entities of ``df`` that have no row in ``other``."""
    return df.join(other.select(entity), entity, "left_anti")


def in_both(a: DataFrame, b: DataFrame, entity: str = "entity") -> DataFrame:
    return a.select(entity).intersect(b.select(entity))
