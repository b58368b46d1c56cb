"""Features from the events around an anchor.

Each builder returns long rows ``(entity, feature, value)``; ``widen`` turns
them into one row per entity over a fixed vocabulary.  Long features can also
be unioned and pivoted once (see ``matrix.assemble_matrix``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorframe.core import HOUR, LOOK_BACK_12H, MINUTE, SECOND, TimeWindow, micros, offset_us
from anchorframe.functions.scalar import classify, floored_days, half_even, label_key, lookup, title_case, within_limits
from anchorframe.operators.windows import clipped, in_window, nearest_record, overlapping, restrict_to_cohort

def observed_features(long: DataFrame, column: str = "feature", most: int = 10_000) -> list[str]:
    """Sorted distinct feature names, for pivots without a given vocabulary; more than ``most`` columns are an error."""
    names = [r[0] for r in long.select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} different values of {column}: name a vocabulary")
    return names


def widen(
    long: DataFrame,
    vocabulary: Sequence[str] | None = None,
    entities: DataFrame | None = None,
    fill: float | int | None = None,
    digits: int | None = None,
    as_int: bool = False,
    prefix: str = "",
) -> DataFrame:
    """One row per entity, one column per feature.

    ``entities`` keeps (and limits the result to) a whole entity set; ``fill``
    replaces NULLs.
    """
    names = list(vocabulary) if vocabulary is not None else observed_features(long)
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("feature names differ only in case; standardise the labels first")
    rows = long.filter(F.col("feature").isin(names))
    # long rows are already one per (entity, feature), so max just picks the value
    wide = rows.groupBy("entity").pivot("feature", names).agg(F.max("value")) if names else rows.select("entity").distinct()
    if entities is not None:
        wide = entities.select("entity").distinct().join(wide, "entity", "left")

    def finish(c: str) -> Column:
        x = half_even(F.col(f"`{c}`"), digits)
        if fill is not None:
            x = F.coalesce(x, F.lit(fill))
        if as_int:
            x = x.cast("int")
        return x.alias(prefix + c)

    return wide.select("entity", *[finish(c) for c in names])


def _feature_rows(df: DataFrame, feature: Column, value: Column) -> DataFrame:
    return df.groupBy("entity", feature.alias("feature")).agg(value.alias("value"))


# --------------------------------------------------------------------------
# point events


def windowed_mean(
    points: DataFrame,
    anchors: DataFrame,
    limits: Mapping[str, tuple[float, float]],
    window: TimeWindow = LOOK_BACK_12H,
) -> DataFrame:
    """Mean per label of the plausible values in the window."""
    plausible = points.filter(within_limits(F.col("label"), F.col("value"), limits))
    return _feature_rows(in_window(plausible, anchors, window), F.col("label"), F.avg("value"))


def windowed_mean_matrix(points, anchors, limits, window=LOOK_BACK_12H, digits: int | None = 2) -> DataFrame:
    return widen(windowed_mean(points, anchors, limits, window), list(limits), digits=digits)


def nearest_attribute(
    records: DataFrame, anchors: DataFrame, value: str = "value", window: TimeWindow = LOOK_BACK_12H, name: str = "value"
) -> DataFrame:
    """The attribute recorded nearest to the start of the window."""
    return nearest_record(records, anchors, value, window.lo, name=name)


# --------------------------------------------------------------------------
# doses


def windowed_dose(
    intervals: DataFrame,
    anchors: DataFrame,
    vocabulary: Sequence[str] | None = None,
    window: TimeWindow = LOOK_BACK_12H,
    by: str = "start_ts",
    loose_labels: bool = False,
) -> DataFrame:
    """Summed amount of events that start (or, with ``by='end_ts'``, end) in the window.

    A group with only missing amounts sums to 0.  ``loose_labels`` matches the
    vocabulary regardless of case.
    """
    label: Column = F.col("label")
    rows = intervals
    if vocabulary is not None and loose_labels:
        label = lookup(F.lower("label"), {v.lower(): v for v in vocabulary})
        rows = rows.filter(F.lower("label").isin([v.lower() for v in vocabulary]))
    elif vocabulary is not None:
        rows = rows.filter(F.col("label").isin(list(vocabulary)))
    return _feature_rows(in_window(rows, anchors, window, by), label, F.coalesce(F.sum("amount"), F.lit(0.0)))


def dose_by_start_matrix(
    intervals, anchors, cohort, vocabulary=None, window=LOOK_BACK_12H, digits: int | None = 2, loose_labels: bool = False
) -> DataFrame:
    """Whole cohort; NULL where a drug was not given."""
    long = windowed_dose(intervals, anchors, vocabulary, window, "start_ts", loose_labels)
    return widen(long, vocabulary, entities=cohort, digits=digits)


def dose_by_end_matrix(
    intervals, anchors, vocabulary, window=LOOK_BACK_12H, digits: int | None = 2, drop_empty: bool = True
) -> DataFrame:
    """Entities with any dose; 0 where a drug was not given; drugs never given are dropped."""
    from anchorframe.operators.matrix import drop_zero_columns

    wide = widen(windowed_dose(intervals, anchors, vocabulary, window, "end_ts"), vocabulary, fill=0.0)
    wide = drop_zero_columns(wide, keep=["entity"]) if drop_empty else wide
    return wide.select("entity", *[half_even(F.col(f"`{c}`"), digits).alias(c) for c in wide.columns if c != "entity"])


# --------------------------------------------------------------------------
# interval overlap


def overlap_flag(intervals, anchors, vocabulary: Sequence[str], window=LOOK_BACK_12H) -> DataFrame:
    rows = intervals.filter(F.col("label").isin(list(vocabulary)))
    return _feature_rows(overlapping(rows, anchors, window), F.col("label"), F.max(F.lit(1.0)))


def overlap_flag_matrix(intervals, anchors, cohort, vocabulary, window=LOOK_BACK_12H) -> DataFrame:
    """Whole cohort, whole vocabulary, 0 or 1."""
    return widen(overlap_flag(intervals, anchors, vocabulary, window), vocabulary, cohort, fill=0, as_int=True)


def overlap_sum(intervals, anchors, vocabulary: Sequence[str], window=LOOK_BACK_12H) -> DataFrame:
    """Full amount of every interval that meets the window."""
    rows = intervals.filter(F.col("label").isin(list(vocabulary)))
    return _feature_rows(overlapping(rows, anchors, window), F.col("label"), F.coalesce(F.sum("amount"), F.lit(0.0)))


def overlap_sum_matrix(intervals, anchors, cohort, vocabulary, window=LOOK_BACK_12H) -> DataFrame:
    """Entities both in the cohort and anchored; NULL where nothing overlaps."""
    both = restrict_to_cohort(anchors.select("entity"), cohort)
    return widen(overlap_sum(intervals, anchors, vocabulary, window), vocabulary, both)


def prorated_overlap(intervals, anchors, window=LOOK_BACK_12H, name: Column | None = None) -> DataFrame:
    """Amount times the share of the interval inside the window; durations below a second count as one."""
    o = overlapping(intervals.filter(F.col("amount").isNotNull()), anchors, window, strict=True)
    start, end = offset_us("start_ts"), offset_us("end_ts")
    inside = F.least(end, F.lit(window.hi)) - F.greatest(start, F.lit(window.lo))
    length = F.greatest(end - start, F.lit(SECOND))
    share = F.col("amount") * (inside / length)
    return _feature_rows(o, title_case("label") if name is None else name, F.sum(share))


def prorated_overlap_matrix(
    intervals, anchors, vocabulary=None, window=LOOK_BACK_12H, prefix: str = "", digits: int | None = 2
) -> DataFrame:
    return widen(prorated_overlap(intervals, anchors, window), vocabulary, fill=0.0, digits=digits, prefix=prefix)


def _canonical(intervals: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Rows whose label matches the vocabulary regardless of case and space, relabelled to it."""
    names = {v.lower().strip(): v for v in vocabulary}
    return intervals.filter(label_key("label").isin(list(names))).withColumn("label", lookup(label_key("label"), names))


def covered_time(pieces: DataFrame, keys: Sequence[str], cell_us: int = 6 * HOUR) -> DataFrame:
    """Length of the union of ``[s_us, e_us]`` per key, and the number of separate islands.

    Time is cut into cells and pieces at their borders, so a key's cells are independent and a hot key is spread.  In
    start order a piece adds only what reaches beyond the furthest end before it in its cell.  Islands that meet at a
    border are one: a cell tells whether it is covered up to its borders.
    """
    keys, s, e = list(keys), F.col("s_us"), F.col("e_us")
    first = ((s - F.pmod(s, F.lit(cell_us))) / cell_us).cast("long")  # exact, also before 0
    last = F.greatest(first, ((e - F.pmod(e, F.lit(cell_us))) / cell_us).cast("long") - (F.pmod(e, F.lit(cell_us)) == 0).cast("long"))
    cut = pieces.select(*keys, "s_us", "e_us", F.explode(F.sequence(first, last)).alias("cell"))
    low, high = F.col("cell") * cell_us, (F.col("cell") + 1) * cell_us
    distinct = cut.groupBy(*keys, "cell", F.greatest(s, low).alias("s_us")).agg(F.max(F.least(e, high)).alias("e_us"))
    before = Window.partitionBy(*keys, "cell").orderBy("s_us").rowsBetween(Window.unboundedPreceding, -1)
    reach = distinct.withColumn("reach", F.max("e_us").over(before))
    starts = F.col("reach").isNull() | (s > F.col("reach"))
    per_cell = reach.groupBy(*keys, "cell").agg(
        F.sum(F.greatest(F.lit(0), e - F.greatest("s_us", "reach"))).alias("covered_us"),
        F.count_if(starts).alias("islands"),
        (F.min("s_us") == low).alias("from_border"),
        (F.max("e_us") == high).alias("to_border"),
    )
    # a few cells a key: the ones covered up to the border that the next one is covered from
    borders = F.array_intersect(F.collect_set(F.when(F.col("to_border"), F.col("cell") + 1)), F.collect_set(F.when(F.col("from_border"), F.col("cell"))))
    return per_cell.groupBy(*keys).agg(F.sum("covered_us").alias("covered_us"), (F.sum("islands") - F.size(borders)).alias("islands"))


def union_minutes(intervals, anchors, vocabulary, window=LOOK_BACK_12H) -> DataFrame:
    """Minutes of the window covered by at least one interval of the label."""
    pieces = clipped(_canonical(intervals, vocabulary), anchors, window)
    covered = covered_time(pieces, ["entity", "label"], max(1, (window.hi - window.lo) // 4))
    return covered.select("entity", F.col("label").alias("feature"), (F.col("covered_us") / MINUTE).alias("value"))


def interval_presence(intervals, anchors, vocabulary, window=LOOK_BACK_12H) -> DataFrame:
    """1 for any positive overlap; an instant never counts."""
    return _feature_rows(clipped(_canonical(intervals, vocabulary), anchors, window), F.col("label"), F.max(F.lit(1.0)))


# --------------------------------------------------------------------------
# flags


def standardised_flag(events, anchors, names: Mapping[str, str], window=LOOK_BACK_12H, by: str = "end_ts") -> DataFrame:
    """1 per standardised label with an event in the window; unmapped labels keep their own text."""
    std = lookup(label_key("label"), names, F.col("label"))
    return _feature_rows(in_window(events, anchors, window, by), std, (F.count(by) > 0).cast("double"))


def standardised_flag_matrix(events, anchors, names, window=LOOK_BACK_12H, vocabulary=None) -> DataFrame:
    return widen(standardised_flag(events, anchors, names, window), vocabulary, fill=0, as_int=True)


def fixed_flag(events, anchors, vocabulary: Sequence[str], window=LOOK_BACK_12H, by: str = "end_ts") -> DataFrame:
    """1 per listed label in the window, 0 for the other listed labels of entities with any event in it."""
    inside = in_window(events, anchors, window, by)
    listed = F.array(
        *[F.struct(F.lit(v).alias("feature"), (F.col("label") == v).cast("double").alias("value")) for v in vocabulary]
    )
    # collapse to distinct labels before spreading each over the vocabulary
    seen = inside.select("entity", F.when(F.col("label").isin(list(vocabulary)), F.col("label")).alias("label")).distinct()
    rows = seen.select("entity", F.inline(listed))
    return rows.groupBy("entity", "feature").agg(F.coalesce(F.max("value"), F.lit(0.0)).alias("value"))


def fixed_flag_matrix(events, anchors, vocabulary, window=LOOK_BACK_12H) -> DataFrame:
    return widen(fixed_flag(events, anchors, vocabulary, window), vocabulary, fill=0, as_int=True)


def with_class(events: DataFrame, classes: Mapping[str, Sequence[str]], column: str = "class") -> DataFrame:
    return events.withColumn(column, classify(F.col("label"), classes))


def history_flag(history: DataFrame, cohort: DataFrame) -> DataFrame:
    """1 per condition on record; ``history`` holds ``entity, label``."""
    return _feature_rows(restrict_to_cohort(history, cohort), F.col("label"), F.max(F.lit(1.0)))


def history_matrix(history, cohort, vocabulary=None) -> DataFrame:
    return widen(history_flag(history, cohort), vocabulary, cohort, fill=0, as_int=True)


# --------------------------------------------------------------------------
# outcomes and stays


def outcome_within_horizon(
    outcomes: DataFrame,
    anchors: DataFrame,
    cohort: DataFrame,
    horizon_days: int = 90,
    order: str | None = None,
    name: str = "outcome",
) -> DataFrame:
    """1 when the event falls within the horizon after the anchor, else 0.

    Days are floored and an event before the anchor counts as day 0.
    ``outcomes`` holds ``entity, event_ts``; ``order`` names the column that
    decides which of several rows is used (the earliest event otherwise).
    """
    pick = F.min("event_ts") if order is None else F.min_by("event_ts", order)
    one = restrict_to_cohort(outcomes, cohort).groupBy("entity").agg(pick.alias("event_ts"))
    joined = one.join(anchors.select("entity", "anchor_ts"), "entity").filter(F.col("anchor_ts").isNotNull())
    days = floored_days("event_ts", "anchor_ts")
    clipped_days = F.when(days.isNotNull(), F.greatest(days, F.lit(0)))
    return joined.select("entity", F.coalesce(clipped_days.between(0, horizon_days), F.lit(False)).cast("int").alias(name))


def stay_before_anchor(
    stays: DataFrame, anchors: DataFrame, cohort: DataFrame, window=LOOK_BACK_12H, name: str = "stay_days"
) -> DataFrame:
    """Whole days of the latest stay that starts in the window, 0 for entities without one.

    ``stays`` holds ``entity, start_ts, end_ts``.
    """
    inside = in_window(restrict_to_cohort(stays, cohort), anchors, window, "start_ts").filter(
        offset_us("end_ts") >= window.lo
    )
    days = floored_days("end_ts", "start_ts")
    latest = inside.groupBy("entity").agg(
        F.max_by(days, F.struct(micros("start_ts"), micros("end_ts"))).alias("days")
    )
    return cohort.select("entity").distinct().join(latest, "entity", "left").select(
        "entity", F.coalesce("days", F.lit(0)).alias(name)
    )


def stay_lengths(stays: DataFrame, anchors: DataFrame, cohort: DataFrame, window=LOOK_BACK_12H, name: str = "stay_days") -> DataFrame:
    """Every stay that starts in the window, one row each, plus a 0 row for entities without one."""
    inside = in_window(restrict_to_cohort(stays, cohort), anchors, window, "start_ts").filter(
        offset_us("end_ts") >= window.lo
    )
    rows = inside.select("entity", floored_days("end_ts", "start_ts").alias(name))
    none = cohort.select("entity").distinct().join(rows.select("entity"), "entity", "left_anti")
    return rows.unionByName(none.withColumn(name, F.lit(0).cast("long")))


def combined_interval_features(
    doses: DataFrame,
    procedures: DataFrame,
    anchors: DataFrame,
    cohort: DataFrame,
    dose_vocabulary: Sequence[str],
    presence_vocabulary: Sequence[str],
    minutes_vocabulary: Sequence[str],
    window: TimeWindow = LOOK_BACK_12H,
) -> DataFrame:
    """Doses by start, presence and union minutes for the cohort, 0 where absent."""
    long = combined_interval_rows(
        doses, procedures, anchors, dose_vocabulary, presence_vocabulary, minutes_vocabulary, window
    )
    names = [*dose_vocabulary, *presence_vocabulary, *minutes_vocabulary]
    return widen(long, names, restrict_to_cohort(anchors.select("entity"), cohort), fill=0.0)


def combined_interval_rows(
    doses, procedures, anchors, dose_vocabulary, presence_vocabulary, minutes_vocabulary, window=LOOK_BACK_12H,
) -> DataFrame:
    parts = [windowed_dose(doses, anchors, dose_vocabulary, window, "start_ts", loose_labels=True)]
    if presence_vocabulary:
        parts.append(interval_presence(procedures, anchors, presence_vocabulary, window))
    if minutes_vocabulary:
        parts.append(union_minutes(procedures, anchors, minutes_vocabulary, window))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return long
