"""Event series around the onset, for dashboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.core import LOOK_BACK_12H, TimeWindow
from anchorframe.functions.scalar import half_even, hours_between, to_double, within_limits
from anchorframe.operators.windows import in_window, restrict_to_cohort


def centred_series(points: DataFrame, baselines: DataFrame, window: TimeWindow = TimeWindow.around(12)) -> DataFrame:
    """Values on both sides of the anchor with the entity's baseline; ``baselines`` holds ``entity, anchor_ts, baseline_value``."""
    keyed = baselines.select("entity", "anchor_ts", "baseline_value")
    return in_window(points, keyed, window).select("entity", "ts", "value", "baseline_value", "anchor_ts")


def chronological_series(
    points: DataFrame,
    anchors: DataFrame,
    limits: Mapping[str, tuple[float, float]],
    window: TimeWindow = LOOK_BACK_12H,
    digits: int | None = 2,
) -> DataFrame:
    """Mean value per entity, label and hours before the anchor (rounded), unordered."""
    plausible = points.filter(within_limits(F.col("label"), F.col("value"), limits))
    inside = in_window(plausible, anchors, window).select(
        "entity",
        "label",
        half_even(hours_between("anchor_ts", "ts"), digits).alias("hours_before"),
        half_even(F.col("value"), digits).alias("value"),
    )
    return inside.groupBy("entity", "label", "hours_before").agg(F.avg("value").alias("value"))


def newest_last(series: DataFrame) -> DataFrame:
    return series.orderBy(F.col("entity").asc(), F.col("hours_before").desc())


def entity_lookup(series: DataFrame) -> DataFrame:
    return series.select("entity").distinct()


def history_long(history: DataFrame, cohort: DataFrame) -> DataFrame:
    """``(entity, label, 1)`` for the cohort, sorted."""
    rows = restrict_to_cohort(history, cohort).select("entity", "label", F.lit(1).alias("value"))
    return rows.orderBy("entity", "label")


def normalise_events(
    df: DataFrame,
    item: str,
    amount: str | None = None,
    unit: str = "amountuom",
    entity: str = "entity",
    start: str = "starttime",
) -> DataFrame:
    """Any event table as ``(entity, item, amount, unit, start_ts)``; columns it lacks become NULL."""
    have = set(df.columns)
    return df.select(
        F.col(entity).alias("entity"),
        F.col(item).alias("item"),
        (to_double(amount) if amount and amount in have else F.lit(None).cast("double")).alias("amount"),
        (F.col(unit).cast("string") if unit in have else F.lit(None).cast("string")).alias("unit"),
        (F.col(start).try_cast("timestamp") if start in have else F.lit(None).cast("timestamp")).alias("start_ts"),
    )


def unified_event_log(
    sources: Sequence[DataFrame], anchors: DataFrame, window: TimeWindow = LOOK_BACK_12H, digits: int | None = 2
) -> tuple[DataFrame, DataFrame]:
    """Events of several sources in the window as (amounts, flags).

    Duplicates are removed before the split, preferring a row with an amount:
    a dose therefore hides a bare mention of the same item at the same time.
    """
    merged = sources[0]
    for s in sources[1:]:
        merged = merged.unionByName(s)
    inside = in_window(merged, anchors, window, "start_ts")
    amounts = (
        inside.groupBy("entity", "item", "unit", "start_ts", "anchor_ts")
        .agg(F.min("amount").alias("amount"))
        .filter(F.col("amount").isNotNull())
        .select("entity", "item", half_even(F.col("amount"), digits).alias("amount"), "unit", "start_ts", "anchor_ts")
    )
    flags = (
        inside.groupBy("entity", "item", "start_ts", "anchor_ts")
        .agg(F.count("amount").alias("with_amount"))
        .filter(F.col("with_amount") == 0)
        .select("entity", "item", F.lit(1).alias("amount"), "start_ts", "anchor_ts")
    )
    return amounts, flags
