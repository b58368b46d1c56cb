"""Index events, baselines and first onset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorframe.core import DAY, HOUR, TimeWindow, micros, offset_us
from anchorframe.functions.scalar import days_between, label_key, lookup
from anchorframe.operators.skew import exact_median, trailing_min
from anchorframe.operators.windows import arg_first, in_window
from anchorframe.session import ensure_checkpoint_dir


def first_index_event(index_events: DataFrame, ts: str = "ts") -> DataFrame:
    """Earliest index event per entity; an entity with only missing times keeps a NULL anchor."""
    rows = index_events.filter(F.col("entity").isNotNull())
    return rows.groupBy("entity").agg(F.min(ts).alias("anchor_ts"))


def peak_summary(
    points: DataFrame,
    anchors: DataFrame,
    window: TimeWindow = TimeWindow.after(7),
    look_back_us: int = 48 * HOUR,
) -> DataFrame:
    """Count, peak, first time of the peak, and lowest value in the look-back before the peak."""
    inside = in_window(points.select("entity", "ts", "value"), anchors.select("entity", "anchor_ts"), window)
    peaks = inside.groupBy("entity").agg(
        F.min("anchor_ts").alias("anchor_ts"),
        F.count(F.lit(1)).alias("n_points"),
        F.max("value").alias("peak_value"),
        F.max_by("ts", F.when(F.col("value").isNotNull(), F.struct(F.col("value"), -micros("ts")))).alias("peak_ts"),
    ).filter(F.col("peak_value").isNotNull())
    low = (
        inside.join(peaks.select("entity", "peak_ts"), "entity")
        .filter(TimeWindow(-look_back_us, 0).contains("ts", "peak_ts"))
        .groupBy("entity")
        .agg(F.min("value").alias("min_before_peak"))
    )
    return peaks.join(low, "entity")


_MEDIAN_RULES = ((30, "pre_1m_median"), (90, "pre_3m_median"), (365, "pre_1y_median"))


def baseline_cascade(points: DataFrame, anchors: DataFrame) -> DataFrame:
    """Reference value per entity by the first rule that yields one.

    Two or more rows in the closed week before the anchor give their minimum;
    else the median of the last 30, 90 or 365 days (left-open); else the
    minimum of the 30 days after; else the earliest value within a year.
    """
    anchors = anchors.select("entity", "anchor_ts")
    off, v, ts = F.col("off"), F.col("value"), F.col("ts")
    year = TimeWindow(-365 * DAY, 365 * DAY)
    near = (
        in_window(points.select("entity", "ts", "value"), anchors, year)
        .withColumn("off", offset_us("ts"))
        .select("entity", "ts", "value", "off")
    )
    # the rows around the anchors are read several times from here on, points once
    ensure_checkpoint_dir(points.sparkSession)
    near = near.checkpoint()

    week = TimeWindow(-7 * DAY, 0).holds(off)
    month_after = TimeWindow(0, 30 * DAY).holds(off)
    year_after = TimeWindow(0, 365 * DAY, lo_closed=False).holds(off)
    pre = {d: TimeWindow(-d * DAY, 0, lo_closed=False).holds(off) & v.isNotNull() for d, _ in _MEDIAN_RULES}

    def lowest(cond: Column) -> tuple[Column, Column]:
        seen = cond & v.isNotNull()
        return F.min(F.when(seen, v)), F.min_by(ts, F.when(seen, F.struct(v, ts)))

    week_v, week_t = lowest(week)
    month_v, month_t = lowest(month_after)
    first_after = F.when(year_after, F.struct(ts, v))
    tally = near.groupBy("entity").agg(
        F.count_if(week).alias("n_week"),
        *[F.count_if(pre[d]).alias(f"n_{d}") for d, _ in _MEDIAN_RULES],
        F.count_if(month_after).alias("n_month_after"),
        F.count_if(year_after).alias("n_year_after"),
        week_v.alias("week_v"),
        week_t.alias("week_t"),
        month_v.alias("month_v"),
        month_t.alias("month_t"),
        F.min(first_after).alias("first_after"),
    )
    rule = F.when(F.col("n_week") >= 2, "pre_7d_min")
    for d, name in _MEDIAN_RULES:
        rule = rule.when(F.col(f"n_{d}") > 0, name)
    rule = (
        rule.when(F.col("n_month_after") > 0, "post_1m_min").when(F.col("n_year_after") > 0, "post_1y_oldest").otherwise("none")
    )
    decided = tally.withColumn("rule", rule)

    # Entities whose rule is a median: the rows of their chosen window.
    days = lookup(F.col("rule"), {name: d for d, name in _MEDIAN_RULES})
    spans = decided.select("entity", days.alias("days")).filter(F.col("days").isNotNull())
    chosen = (
        near.filter(v.isNotNull() & (off <= 0))
        .join(spans, "entity")
        .filter(off > -F.col("days").cast("long") * F.lit(DAY))
        .select("entity", "ts", "value")
    )
    medians = exact_median(chosen, ["entity"], "value", "med")
    closest = (
        chosen.join(medians, "entity")
        .groupBy("entity")
        .agg(F.first("med").alias("med"), arg_first("ts", F.abs(v - F.col("med")), ts).alias("med_t"))
    )

    r = F.col("rule")
    is_median = r.isin([n for _, n in _MEDIAN_RULES])
    value = (
        F.when(r == "pre_7d_min", F.col("week_v"))
        .when(is_median, F.col("med"))
        .when(r == "post_1m_min", F.col("month_v"))
        .when(r == "post_1y_oldest", F.col("first_after.value"))
    )
    when = (
        F.when(r == "pre_7d_min", F.col("week_t"))
        .when(is_median, F.col("med_t"))
        .when(r == "post_1m_min", F.col("month_t"))
        .when(r == "post_1y_oldest", F.col("first_after.ts"))
    )
    picked = decided.join(closest, "entity", "left").select(
        "entity", value.alias("baseline_value"), when.alias("baseline_ts"), r.alias("baseline_rule")
    )
    # one row an entity, which all that follows joins
    return anchors.join(picked.checkpoint(), "entity", "left").withColumn(
        "baseline_rule", F.coalesce("baseline_rule", F.lit("none"))
    )


def rolling_minimum(
    points: DataFrame,
    width_us: int = 48 * HOUR,
    name: str = "rolling_min",
) -> DataFrame:
    """Minimum over the trailing, left-open time frame; rows at the same time share their frame."""
    timed = points.withColumn("at_us", micros("ts"))
    return trailing_min(timed, "entity", "at_us", "value", width_us, name).drop("at_us")


def framed_points(points: DataFrame, baselines: DataFrame, look_back_us: int = 48 * HOUR) -> DataFrame:
    """Values after the anchor with ``low``, the lowest of their trailing frame; onsets at any thresholds come from it."""
    keyed = baselines.select("entity", "anchor_ts", "baseline_value")
    rows = points.select("entity", "ts", "value").filter(F.col("value").isNotNull() & F.col("ts").isNotNull())
    return rolling_minimum(in_window(rows, keyed, TimeWindow(0, None)), look_back_us, "low")


def detect_onset(
    points: DataFrame,
    baselines: DataFrame,
    rise: float = 0.3,
    ratio: float = 1.5,
    look_back_us: int = 48 * HOUR,
    ratio_window: TimeWindow = TimeWindow.after(7),
    status: tuple[str, str] = ("onset", "no onset"),
    framed: DataFrame | None = None,
) -> DataFrame:
    """First time after the anchor that a value rises by ``rise`` within the look-back or reaches ``ratio`` x baseline.

    ``baselines`` holds ``entity, anchor_ts, baseline_value`` and any further
    per-entity columns, which are kept.  ``framed`` is what `framed_points`
    gives for the same points, baselines and look-back, where it is at hand.
    """
    framed = framed_points(points, baselines, look_back_us) if framed is None else framed
    rose = (F.col("value") - F.col("low")) >= rise
    reached = F.coalesce(F.col("value") >= F.col("baseline_value") * F.lit(ratio), F.lit(False)) & ratio_window.contains("ts")
    hits = framed.groupBy("entity").agg(
        F.bool_or(rose).alias("rise_flag"),
        F.min(F.when(rose, F.col("ts"))).alias("rise_ts"),
        F.bool_or(reached).alias("ratio_flag"),
        F.min(F.when(reached, F.col("ts"))).alias("ratio_ts"),
    )
    found = baselines.join(hits, "entity", "left")
    for flag in ("rise_flag", "ratio_flag"):
        found = found.withColumn(flag, F.coalesce(flag, F.lit(False)))
    return (
        found.withColumn("onset_flag", F.col("rise_flag") | F.col("ratio_flag"))
        .withColumn("onset_ts", F.least("rise_ts", "ratio_ts"))
        .withColumn("days_to_onset", days_between("onset_ts", "anchor_ts"))
        .withColumn("status", F.when(F.col("onset_flag"), status[0]).otherwise(status[1]))
    )


def onset_anchors(onsets: DataFrame) -> DataFrame:
    """``(entity, anchor_ts)`` with the onset as the new anchor."""
    return onsets.select("entity", F.col("onset_ts").alias("anchor_ts"))


def onset_cohort(onsets: DataFrame, label: str = "onset", column: str = "stage") -> DataFrame:
    return onsets.filter(F.col("onset_flag")).select("entity").distinct().withColumn(column, F.lit(label))


def stage_means_onset(stage: Column | str, negatives: Sequence[str]) -> Column:
    """Onset flag from a free-text stage: anything but a listed negative."""
    return ~label_key(stage).isin(list(negatives))


def text_means_onset(text: Column | str, positives: Sequence[str]) -> Column:
    return label_key(F.col(text).cast("string") if isinstance(text, str) else text.cast("string")).isin(list(positives))


COMPARE_MODES = ("orig_true", "new_true", "both_true", "either_true")


def compare_onsets(
    original: DataFrame, new: DataFrame, mode: str = "both_true", tolerance_us: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Reconcile two onset tables; returns the per-entity rows and a one-row tally."""
    if mode not in COMPARE_MODES:
        raise ValueError(f"mode must be one of {COMPARE_MODES}")
    side = lambda df, s: df.select(
        "entity", F.col("onset_flag").alias(f"flag_{s}"), F.col("onset_ts").alias(f"ts_{s}")
    )
    both = side(original, "orig").join(side(new, "new"), "entity")
    o, n = F.col("flag_orig"), F.col("flag_new")
    rows = both.filter({"orig_true": o, "new_true": n, "both_true": o & n, "either_true": o | n}[mode])
    gap = F.abs(micros("ts_new") - micros("ts_orig"))
    rows = rows.withColumn("gap_us", gap).withColumn("matches", F.coalesce(F.col("gap_us") <= tolerance_us, F.lit(False)))
    tally = rows.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("matches")).alias("n_match"),
        F.count_if(F.col("ts_new").isNull()).alias("n_missing_new"),
        F.count_if(F.col("ts_orig").isNull()).alias("n_missing_orig"),
        F.count_if(~F.col("matches") & F.col("ts_new").isNotNull() & F.col("ts_orig").isNotNull()).alias("n_mismatch"),
    )
    return rows, tally


def order_comparison(rows: DataFrame) -> DataFrame:
    """Mismatches first, largest gap first."""
    return rows.orderBy(F.col("matches").asc(), F.col("gap_us").desc_nulls_last(), F.col("entity"))


def time_to_onset(onsets: DataFrame, max_days: float = 7) -> DataFrame:
    return onsets.filter(F.col("days_to_onset").between(0, max_days)).select("entity", "anchor_ts", "days_to_onset")


def fixed_width_histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts of all ``bins`` equal bins over ``[lo, hi]``; the last bin is closed."""
    x = F.col(column)
    bin_ = F.least(F.floor((x - lo) * F.lit(bins / (hi - lo))), F.lit(bins - 1)).cast("long")
    counts = df.filter(x.between(lo, hi)).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 0.5) * F.lit(width)).alias("bin_center"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def stage_members(df: DataFrame, stage: str, relabel: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct ``(entity, stage)`` after relabelling."""
    c = F.col(stage)
    return df.select("entity", lookup(c, relabel or {}, c).alias("stage")).distinct()


def stage_distribution(
    df: DataFrame, stage: str, order: Sequence[str], relabel: Mapping[str, str] | None = None
) -> DataFrame:
    """Entities per stage, in the requested order, with each stage's share; stages not listed are left out."""
    members = stage_members(df, stage, relabel)
    counts = members.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(_whole_result())
    place = lookup(F.col("stage"), {s: i for i, s in enumerate(order)})
    return (
        counts.withColumn("share", F.col("n") / total)
        .withColumn("position", place)
        .filter(F.col("position").isNotNull())
        .select("position", "stage", "n", "share")
    )


def _whole_result():
    from pyspark.sql import Window

    # one row per stage: the result table, not the data
    return Window.partitionBy(F.lit(1))
