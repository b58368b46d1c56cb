"""Every operator applied to the sample tables: name -> (spark, sf_dir) -> DataFrame.

Times are returned as microseconds since the epoch and flags as integers, so
results compare the same way in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.core import HOUR, TimeWindow, micros
from anchorframe.functions.scalar import label_key, lookup, title_case
from anchorframe.operators import features as ft
from anchorframe.operators import matrix as mx
from anchorframe.operators import onset as on
from anchorframe.operators import rules, series
from anchorframe.operators import windows as wj
from anchorframe.plans import bindings as b
from anchorframe.session import ensure_checkpoint_dir

QUERIES: dict = {}
THREE_DAYS = TimeWindow.before(72)
HALF_DAY = TimeWindow.before(12)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r6(c, name: str):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


def us(c: str, name: str):
    return micros(c).alias(name)


def us_or(c: str, name: str):
    """Microseconds, -1 where there is no time."""
    return F.coalesce(micros(c), F.lit(-1)).alias(name)


def whole(c: str, name: str | None = None):
    return F.col(c).cast("int").alias(name or c)


def rounded(df: DataFrame) -> DataFrame:
    """All double columns at six decimals."""
    return df.select(
        *[r6(F.col(f"`{n}`"), n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def durable(df: DataFrame) -> DataFrame:
    """A table that the next steps read several times is written once, as the stages of a study are."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


# ---- index events, baselines, onset ----------------------------------------


@query
def cohort_semi(spark, d):
    """Orders of one market segment's customers."""
    kept = wj.restrict_to_cohort(b.order_points(spark, d), b.segment_cohort(spark, d))
    return kept.select("entity", us("ts", "ts_us"), r6("value", "value"))


@query
def first_anchor(spark, d):
    late_errors = b.event_points(spark, d).filter((F.col("label") == "error") & (F.col("ts") >= F.lit("2024-01-10").cast("timestamp")))
    return on.first_index_event(late_errors).select("entity", us("anchor_ts", "anchor_us"))


@query
def peak_summary(spark, d):
    p = on.peak_summary(b.event_points(spark, d), b.event_anchors(spark, d))
    return p.select("entity", us("anchor_ts", "anchor_us"), "n_points", r6("peak_value", "peak_value"),
                    us("peak_ts", "peak_us"), r6("min_before_peak", "min_before_peak"))


@query
def baseline_cascade(spark, d):
    x = on.baseline_cascade(b.order_points(spark, d), b.customer_anchors(spark, d))
    return x.select("entity", r6("baseline_value", "baseline_value"), us_or("baseline_ts", "baseline_us"), "baseline_rule")


@query
def rolling_min(spark, d):
    x = on.rolling_minimum(b.event_points(spark, d).select("entity", "ts", "value"))
    return x.select("entity", us("ts", "ts_us"), r6("value", "value"), r6("rolling_min", "rolling_min"))


def _onsets(spark, d, rise: float = 50.0):
    points = b.event_points(spark, d)
    base = on.baseline_cascade(points, b.event_anchors(spark, d))
    return on.detect_onset(points, base, rise=rise, ratio=1.5)


@query
def detect_onset(spark, d):
    return _onsets(spark, d).select(
        "entity", us("anchor_ts", "anchor_us"), r6("baseline_value", "baseline_value"),
        whole("rise_flag"), us_or("rise_ts", "rise_us"), whole("ratio_flag"), us_or("ratio_ts", "ratio_us"),
        whole("onset_flag"), us_or("onset_ts", "onset_us"), r6("days_to_onset", "days_to_onset"), "status",
    )


def _two_onsets(spark, d):
    """Onsets at two thresholds from one set of baselines and one framed table."""
    points = b.event_points(spark, d)
    base = on.baseline_cascade(points, b.event_anchors(spark, d))
    framed = durable(on.framed_points(points, base))
    return [on.detect_onset(points, base, rise=rise, ratio=1.5, framed=framed) for rise in (50.0, 120.0)]


@query
def compare_onsets(spark, d):
    rows, _ = on.compare_onsets(*_two_onsets(spark, d), "either_true", 6 * HOUR)
    return rows.select("entity", whole("flag_orig"), whole("flag_new"), us_or("ts_orig", "orig_us"), us_or("ts_new", "new_us"),
                       F.coalesce("gap_us", F.lit(-1)).alias("gap_us"), whole("matches"))


@query
def compare_onsets_tally(spark, d):
    _, tally = on.compare_onsets(*_two_onsets(spark, d), "both_true", 6 * HOUR)
    return tally


@query
def time_to_onset(spark, d):
    x = on.time_to_onset(_onsets(spark, d))
    return x.select("entity", us("anchor_ts", "anchor_us"), r6("days_to_onset", "days_to_onset"))


@query
def onset_histogram(spark, d):
    h = on.fixed_width_histogram(on.time_to_onset(_onsets(spark, d)), "days_to_onset", 0.0, 7.0, 28)
    return h.select("bin", r6("bin_lo", "bin_lo"), r6("bin_center", "bin_center"), "n")


@query
def stage_distribution(spark, d):
    order = ["1-URGENT", "HIGH", "3-MEDIUM", "5-LOW"]
    s = on.stage_distribution(b.order_points(spark, d), "label", order, {"2-HIGH": "HIGH"})
    return s.select("position", "stage", "n", r6("share", "share"))


@query
def onset_cohort(spark, d):
    return on.onset_cohort(_onsets(spark, d))


# ---- joins and selections --------------------------------------------------


@query
def point_window(spark, d):
    """Events in the closed twelve hours before the anchor."""
    x = wj.in_window(b.event_points(spark, d), b.event_anchors(spark, d), HALF_DAY)
    return x.select("entity", us("ts", "ts_us"), "label", r6("value", "value"))


@query
def end_window(spark, d):
    """Intervals that end in the three days before the anchor."""
    x = wj.in_window(b.event_intervals(spark, d), b.event_anchors(spark, d), THREE_DAYS, "end_ts")
    return x.select("entity", us("start_ts", "start_us"), us("end_ts", "end_us"), "label", r6("amount", "amount"))


@query
def overlap_closed(spark, d):
    x = wj.overlapping(b.event_intervals(spark, d), b.event_anchors(spark, d), HALF_DAY)
    return x.select("entity", us("start_ts", "start_us"), us("end_ts", "end_us"), "label")


@query
def overlap_strict(spark, d):
    x = wj.overlapping(b.event_intervals(spark, d), b.event_anchors(spark, d), HALF_DAY, strict=True)
    return x.select("entity", us("start_ts", "start_us"), us("end_ts", "end_us"), "label")


@query
def plausible_values(spark, d):
    from anchorframe.functions.scalar import within_limits

    e = b.event_points(spark, d)
    return e.filter(within_limits(F.col("label"), F.col("value"), b.EVENT_LIMITS)).select(
        "entity", us("ts", "ts_us"), "label", r6("value", "value"))


@query
def keep_first(spark, d):
    """First event of every user and type."""
    x = wj.keep_first(b.event_points(spark, d), ["entity", "label"], ["ts", "value"])
    return x.select("entity", "label", us("ts", "ts_us"), r6("value", "value"))


@query
def entities_without(spark, d):
    """Anchored users with no event in the twelve hours before."""
    anchors = b.event_anchors(spark, d)
    before = wj.in_window(b.event_points(spark, d).filter(F.col("label") != "error"), anchors, HALF_DAY)
    return wj.without(anchors.select("entity"), before)


@query
def entities_in_both(spark, d):
    return wj.in_both(b.event_anchors(spark, d), b.event_cohort(spark, d))


@query
def union_of_sources(spark, d):
    """Orders and events as one list of dated values."""
    e = b.event_points(spark, d).select("entity", "ts", F.col("value"), "label")
    o = b.order_points(spark, d).select("entity", "ts", "label")
    u = e.unionByName(o, allowMissingColumns=True)
    return u.select("entity", us("ts", "ts_us"), "label", r6("value", "value"))


@query
def label_matching(spark, d):
    """Events per label after trimming and lower-casing mixed spellings."""
    m = b.mixed_case_events(spark, d)
    return m.groupBy(label_key("label").alias("label"), title_case("label").alias("title")).agg(F.count(F.lit(1)).alias("n"))


@query
def decimal_comma_text(spark, d):
    from anchorframe.sources.sinks import with_decimal_commas

    o = b.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return with_decimal_commas(o)


def _folder(spark, name: str) -> str:
    """A new folder in the shared one."""
    import uuid

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query
def csv_scan(spark, d):
    """Orders written as CSV shards of two layouts, read back with types, names normalised."""
    from anchorframe.sources import readers as rd
    from anchorframe.sources import sinks

    o = b.table(spark, d, "orders").select(F.col("o_orderkey").alias(" Order_ID"), F.col("o_orderdate").alias("DAY"), F.col("o_totalprice").alias("price"), "o_orderpriority")
    low, high = F.col("price") < 100_000, F.col("price") >= 100_000
    paths = [_folder(spark, "orders-a"), _folder(spark, "orders-b")]
    sinks.write_csv(o.filter(low), paths[0])
    sinks.write_csv(o.filter(high).select("price", " Order_ID", "DAY"), paths[1])
    back = rd.read_csv_table(spark, paths, {"order_id": "id", "day": "date", "price": "double"})
    rd.require_columns(back, ["order_id", "day", "price", "o_orderpriority"], "orders")
    return back.select("order_id", us("day", "day_us"), r6("price", "price"), F.coalesce("o_orderpriority", F.lit("none")).alias("priority"))


@query
def cohort_scan(spark, d):
    """Files by suffix, Parquet and CSV, kept to a cohort, the end time from whichever column is there."""
    from anchorframe.sources import readers as rd

    path = _folder(spark, "events") + ".csv"
    e = b.table(spark, d, "events").select(F.col("user_id").alias("entity"), F.col("ts").cast("string").alias("stoptime"), "event_type")
    e.write.option("header", True).csv(path)
    cohort = b.event_cohort(spark, d)
    rows = rd.with_end_column(rd.load_for_cohort(spark, path, cohort)).select(F.col("entity").cast("long").alias("entity"), "end_ts", "event_type")
    plain = rd.with_end_column(rd.load(spark, f"{d}/events.parquet").select(F.col("user_id").alias("entity"), "event_type")).join(cohort, "entity", "left_semi")
    both = rows.unionByName(plain.select("entity", "end_ts", "event_type"))
    return both.groupBy("event_type").agg(F.count("*").alias("n"), F.count("end_ts").alias("ended"), F.max(micros("end_ts")).alias("last_us"), F.count_distinct("entity").alias("entities"))


@query
def row_positions(spark, d):
    """Each order's place by price, then key."""
    from anchorframe.sources import sinks

    o = b.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rounded(sinks.with_position(o, ["o_totalprice", "o_orderkey"], "place"))


@query
def indexed_csv(spark, d):
    """Customers in a CSV sink with its row index, read back."""
    from anchorframe.sources import sinks

    path = _folder(spark, "customers")
    sinks.write_csv(b.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), path, comma=True, index_by=["c_mktsegment", "c_custkey"])
    back = spark.read.option("header", True).schema("place long, c_custkey long, c_acctbal string, c_mktsegment string").csv(path)
    return back.select("place", "c_custkey", "c_acctbal", "c_mktsegment")


@query
def value_counts(spark, d):
    e = b.event_points(spark, d)
    n = e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("entity").alias("entities"))
    total = F.sum("n").over(on._whole_result())
    return n.select("label", "n", "entities", r6(F.col("n") * 100 / total, "pct"))


# ---- features --------------------------------------------------------------


@query
def window_mean_pivot(spark, d):
    x = ft.windowed_mean_matrix(b.event_points(spark, d), b.event_anchors(spark, d), b.EVENT_LIMITS, THREE_DAYS, digits=None)
    return rounded(x)


@query
def nearest_attribute(spark, d):
    x = ft.nearest_attribute(b.order_points(spark, d), b.customer_anchors(spark, d))
    return x.select("entity", r6("value", "value"))


@query
def dose_sum_start(spark, d):
    x = ft.dose_by_start_matrix(b.event_intervals(spark, d), b.event_anchors(spark, d), b.event_cohort(spark, d),
                                ["click", "purchase", "view"], THREE_DAYS, digits=None)
    return rounded(x)


@query
def dose_sum_end(spark, d):
    x = ft.dose_by_end_matrix(b.event_intervals(spark, d), b.event_anchors(spark, d),
                              ["click", "view", "absent"], THREE_DAYS, digits=None)
    return rounded(x)


@query
def overlap_flags(spark, d):
    return ft.overlap_flag_matrix(b.event_intervals(spark, d), b.event_anchors(spark, d), b.event_cohort(spark, d), b.EVENT_LABELS)


@query
def overlap_sum(spark, d):
    x = ft.overlap_sum_matrix(b.event_intervals(spark, d), b.event_anchors(spark, d), b.event_cohort(spark, d), ["signup", "view"])
    return rounded(x)


@query
def prorated_sum(spark, d):
    x = ft.prorated_overlap_matrix(b.mixed_case_events(spark, d), b.event_anchors(spark, d),
                                   ["Click", "Error", "Purchase", "Signup", "View"], prefix="in_", digits=None)
    return rounded(x)


@query
def union_minutes(spark, d):
    rows = b.mixed_case_events(spark, d)
    x = ft.union_minutes(rows, b.event_anchors(spark, d), ["click", "view"], THREE_DAYS)
    return x.select("entity", "feature", r6(F.col("value") * 60, "seconds"))


@query
def merged_islands(spark, d):
    """All labels of a user merged: covered time and separate stretches over three days."""
    pieces = wj.clipped(b.event_intervals(spark, d), b.event_anchors(spark, d), THREE_DAYS)
    c = ft.covered_time(pieces, ["entity"])
    return c.select("entity", "covered_us", "islands")


@query
def interval_presence(spark, d):
    x = ft.interval_presence(b.mixed_case_events(spark, d), b.event_anchors(spark, d), ["purchase", "error"])
    return x.select("entity", "feature", whole("value"))


@query
def std_flags(spark, d):
    return ft.standardised_flag_matrix(b.mixed_case_events(spark, d), b.event_anchors(spark, d), b.MIXED_NAMES, THREE_DAYS,
                                       ["Click", "Purchase", "View", "signup", " signup "])


@query
def fixed_flags(spark, d):
    return ft.fixed_flag_matrix(b.event_intervals(spark, d), b.event_anchors(spark, d), ["click", "purchase", "refund"], THREE_DAYS)


@query
def event_classes(spark, d):
    classes = {"read": ["view", "click"], "write": ["purchase"]}
    x = ft.with_class(b.event_points(spark, d), classes)
    return x.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query
def combined_interval_features(spark, d):
    i = b.event_intervals(spark, d)
    x = ft.combined_interval_features(i, i.withColumn("label", F.concat(F.lit("p_"), "label")), b.event_anchors(spark, d),
                                      b.event_cohort(spark, d), ["Click", "View"], ["p_error"], ["p_view", "p_signup"], THREE_DAYS)
    return rounded(x)


@query
def history_matrix(spark, d):
    h = b.order_points(spark, d).select("entity", "label")
    return ft.history_matrix(h, b.segment_cohort(spark, d), b.PRIORITIES)


@query
def horizon_outcome(spark, d):
    o = b.table(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
    outcomes = o.select(F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("timestamp").alias("event_ts"))
    return ft.outcome_within_horizon(outcomes, b.customer_anchors(spark, d), b.segment_cohort(spark, d), 90)


@query
def stay_before_anchor(spark, d):
    i = b.event_intervals(spark, d)
    stays = i.withColumn("end_ts", F.timestamp_micros(micros("start_ts") + (micros("end_ts") - micros("start_ts")) * 20))
    return ft.stay_before_anchor(stays, b.event_anchors(spark, d), b.event_cohort(spark, d))


@query
def stay_lengths(spark, d):
    i = b.event_intervals(spark, d)
    stays = i.withColumn("end_ts", F.timestamp_micros(micros("start_ts") + (micros("end_ts") - micros("start_ts")) * 20))
    x = ft.stay_lengths(stays, b.event_anchors(spark, d), b.event_cohort(spark, d))
    return x.groupBy("entity", "stay_days").agg(F.count(F.lit(1)).alias("n"))


# ---- matrix ----------------------------------------------------------------


def _matrix(spark, d):
    anchors = b.event_anchors(spark, d)
    points, intervals = b.event_points(spark, d), b.event_intervals(spark, d)
    labels = list(b.EVENT_LIMITS)
    vitals = mx.FeatureBlock(ft.windowed_mean(points, anchors, b.EVENT_LIMITS, THREE_DAYS), tuple(labels), prefix="mean_")
    blocks = [
        mx.FeatureBlock(ft.windowed_dose(intervals, anchors, ["click", "view"], HALF_DAY), ("click", "view"), None, "dose_"),
        mx.FeatureBlock(ft.windowed_dose(intervals, anchors, ["purchase", "signup"], HALF_DAY, "end_ts"), ("purchase", "signup"), "present", "given_"),
        mx.FeatureBlock(ft.overlap_flag(intervals, anchors, ["signup", "view"], HALF_DAY), ("signup", "view"), "all", "flag_"),
        mx.FeatureBlock(ft.union_minutes(intervals, anchors, ["click"], THREE_DAYS), ("click",), None, "min_"),
    ]
    return mx.assemble_matrix(anchors.select("entity"), blocks, required=vitals, keep_empty=["mean_signup"])


@query
def feature_matrix(spark, d):
    return rounded(_matrix(spark, d))


@query
def impute(spark, d):
    _, _, filled = mx.impute_matrix(durable(_matrix(spark, d)), ["mean_click", "mean_purchase", "mean_view"], drop=["mean_signup"])
    return rounded(filled)


@query
def impute_medians(spark, d):
    _, medians, _ = mx.impute_matrix(durable(_matrix(spark, d)), ["mean_click", "mean_purchase", "mean_view"], drop=["mean_signup"])
    return medians.select("feature", r6("median", "median"))


@query
def null_counts(spark, d):
    return mx.null_counts(_matrix(spark, d))


@query
def joined_matrix(spark, d):
    """Separately widened tables chained by left joins."""
    anchors = b.event_anchors(spark, d)
    means = ft.windowed_mean_matrix(b.event_points(spark, d), anchors, b.EVENT_LIMITS, THREE_DAYS, digits=None)
    stays = ft.stay_before_anchor(b.event_intervals(spark, d), anchors, anchors)
    return rounded(mx.chain_join(anchors.select("entity"), [means, stays]))


@query
def nonempty_rows(spark, d):
    m = ft.dose_by_start_matrix(b.event_intervals(spark, d), b.event_anchors(spark, d), b.event_anchors(spark, d),
                                ["click", "purchase"], HALF_DAY, digits=None)
    return rounded(mx.drop_empty_rows(m, keep=["entity"]))


# ---- series and annotations ------------------------------------------------


@query
def centred_series(spark, d):
    points = b.event_points(spark, d)
    base = on.baseline_cascade(points, b.event_anchors(spark, d))
    x = series.centred_series(points, base)
    return x.select("entity", us("ts", "ts_us"), r6("value", "value"), r6("baseline_value", "baseline_value"), us("anchor_ts", "anchor_us"))


@query
def chronological(spark, d):
    x = series.chronological_series(b.event_points(spark, d), b.event_anchors(spark, d), {"click": (1.0, 200.0), "view": (0.5, 300.0)},
                                    THREE_DAYS, digits=None)
    return x.select("entity", "label", r6("hours_before", "hours_before"), r6("value", "value"))


@query
def history_long(spark, d):
    h = b.order_points(spark, d).select("entity", "label")
    return series.history_long(h, b.segment_cohort(spark, d))


def _event_log(spark, d):
    e = b.table(spark, d, "events")
    kind = F.col("event_type")
    base = e.select(F.col("user_id").alias("entity"), F.col("ts").cast("timestamp").alias("starttime"), "event_type", "value")
    doses = base.filter(kind.isin("purchase", "view")).withColumn("amountuom", F.lit("unit"))
    bare = base.filter(kind.isin("view", "signup", "click"))
    sources = [
        series.normalise_events(doses, "event_type", "value"),
        series.normalise_events(doses.filter(F.col("value") > 50), "event_type", "value"),
        series.normalise_events(bare, "event_type"),
        series.normalise_events(bare, "event_type", "no_such_column"),
    ]
    return series.unified_event_log(sources, b.event_anchors(spark, d), THREE_DAYS, digits=None)


@query
def event_log_amounts(spark, d):
    amounts, _ = _event_log(spark, d)
    return amounts.select("entity", "item", r6("amount", "amount"), "unit", us("start_ts", "start_us"), us("anchor_ts", "anchor_us"))


@query
def event_log_flags(spark, d):
    _, flags = _event_log(spark, d)
    return flags.select("entity", "item", "amount", us("start_ts", "start_us"), us("anchor_ts", "anchor_us"))


@query
def rule_annotations(spark, d):
    rows = b.table(spark, d, "events").select(
        F.col("event_id").alias("id"), (F.col("user_id") % 7).cast("int").alias("cluster"),
        (F.col("value") / 100).alias("score"), F.col("value").alias("load"),
        (F.col("event_type") == "error").cast("int").alias("failed"),
    )
    x = rules.annotate(
        rows, {"score_colour": "score"}, {3: "three", 4: "four", 5: "five"},
        [rules.TextRule("failed", "failed once", 1), rules.TextRule("load", "heavy", 90.0, above=True), rules.TextRule("gone", "never", 1)],
    )
    return rounded(x)


# ---- cluster statistics ----------------------------------------------------

from anchorframe.operators import cluster as cl  # noqa: E402
from anchorframe.operators import models as md  # noqa: E402
from anchorframe.operators import stats as st  # noqa: E402
from anchorframe.plans import analysis as an  # noqa: E402

X = b.MATRIX_FEATURES


def _segmented(spark, d):
    """The customer matrix with the market segment as cluster number."""
    numbers = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
    return durable(b.customer_matrix(spark, d)).withColumn("cluster", lookup(F.col("segment"), numbers))


@query
def variance_filter(spark, d):
    m = durable(b.complete_matrix(spark, d))
    moments = cl.column_moments(m, X)
    kept = set(cl.variance_filter(moments, 0.05))
    rows = [(c, float(v), int(c in kept)) for c, v in moments.variance.items()]
    return rounded(spark.createDataFrame(rows, "feature string, variance double, kept int"))


@query
def column_quartiles(spark, d):
    return rounded(mx.column_quantiles(durable(b.customer_matrix(spark, d)), X, [0.25, 0.5, 0.75], ["q1", "q2", "q3"]))


@query
def robust_scale(spark, d):
    m = durable(b.complete_matrix(spark, d)).drop("segment")
    return rounded(cl.robust_scale(m, X, cl.scaling_table(m, X)))


@query
def cluster_profile(spark, d):
    e = b.embedding_points(spark, d)
    return rounded(st.cluster_sizes(st.keep_large_clusters(e, 47)))


@query
def outcome_rates(spark, d):
    m = _segmented(spark, d).withColumn("outcome", F.col("urgent"))
    return rounded(st.outcome_rates(m, "outcome", "returned"))


@query
def cluster_means(spark, d):
    return rounded(st.cluster_means(_segmented(spark, d), ["n_orders", "balance", "avg_quantity"]))


@query
def silhouette(spark, d):
    return rounded(st.silhouette(b.embedding_points(spark, d)))


@query
def silhouette_squared(spark, d):
    x = st.silhouette_squared(b.embedding_points(spark, d))
    return rounded(x.withColumn("cluster", F.col("cluster").cast("long")))


@query
def davies_bouldin(spark, d):
    return rounded(st.davies_bouldin(b.embedding_points(spark, d)))


@query
def mid_ranks(spark, d):
    x = st.mid_ranks(_segmented(spark, d), ["n_orders", "balance", "urgent"])
    return rounded(x.select("feature", "value", "ties", "mid_rank"))


@query
def kruskal_h(spark, d):
    return rounded(st.kruskal_wallis(_segmented(spark, d), X, min_effect=None, with_p=False))


@query
def kruskal_p(spark, d):
    """The same test with its p-value and adjusted p."""
    t = st.kruskal_wallis(_segmented(spark, d), X, min_effect=None)
    return rounded(st.flag_important(t))


@query
def dunn_z(spark, d):
    return rounded(st.dunn_pairs(_segmented(spark, d), X, with_p=False))


@query
def dunn_p(spark, d):
    return rounded(st.dunn_pairs(_segmented(spark, d), X))


@query
def cluster_comparison(spark, d):
    """Means per cluster, adjusted feature tests and adjusted pairs, as one list."""
    m = _segmented(spark, d)
    means, tests, pairs = st.compare_clusters(m, st.kruskal_wallis(m, X, min_effect=None), X)
    none = F.lit(-1)
    parts = [
        mx.to_long(means, X, ["cluster"]).select(F.lit("mean").alias("kind"), "feature", F.col("cluster").alias("cluster_a"), none.alias("cluster_b"), "value"),
        tests.select(F.lit("p_fdr").alias("kind"), "feature", none.alias("cluster_a"), none.alias("cluster_b"), F.col("p_fdr").alias("value")),
        pairs.select(F.lit("p_adj").alias("kind"), "feature", "cluster_a", "cluster_b", F.col("p_adj").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out)


def _pseudo_p(spark, d):
    """A number in (0, 1] per event type and user group, standing in for a p-value."""
    e = b.event_points(spark, d)
    return e.groupBy("label", (F.col("entity") % 10).alias("grp")).agg(
        (F.count_if(F.col("value") > 120) / F.count(F.lit(1))).alias("p"))


@query
def bh_q(spark, d):
    x = st.benjamini_hochberg(_pseudo_p(spark, d), "p", "q", ["label"], ["grp"])
    return rounded(x.select("label", "grp", "p", "q"))


@query
def holm_p(spark, d):
    return rounded(st.holm(_pseudo_p(spark, d), ["label"], "p", "p_adj", ["grp"]))


@query
def xy_prepare(spark, d):
    m = b.customer_matrix(spark, d)
    text = m.withColumn("balance", F.when(F.col("balance") < 0, F.lit("overdrawn")).otherwise(F.col("balance").cast("string")))
    xy = st.prepare_xy(text, ["balance", "returned", "avg_quantity"], "avg_price", ["entity"])
    return rounded(st.binarise(xy, ["returned"]))


@query
def fold_numbers(spark, d):
    """Rows per class and fold of the stratified split."""
    m = durable(b.complete_matrix(spark, d))
    f = md.assign_folds(m, "entity", 5, "urgent")
    return f.groupBy("urgent", "fold").agg(F.count(F.lit(1)).alias("n"))


@query
def ranking_scores(spark, d):
    """How well an event's value tells errors from other events, by user group."""
    e = b.event_points(spark, d).select((F.col("entity") % 10).alias("grp"), (F.col("label") == "error").cast("double").alias("y"), "value")
    return rounded(md.ranking_scores(e, "grp", "y", "value"))


@query
def value_scores(spark, d):
    """An order's price predicted from its customer's number, by priority."""
    o = b.order_points(spark, d).select("label", (F.col("value") / 1000).alias("price"), (F.col("entity") % 200 + 50).cast("double").alias("guess"))
    return rounded(md.value_scores(o, "label", "price", "guess"))


@query
def ols_hc3(spark, d):
    m = durable(b.complete_matrix(spark, d))
    return rounded(an.stay_associations(m, ["avg_price", "balance", "avg_quantity", "urgent"], "returned", ["urgent"]))


@query
def logit(spark, d):
    m = durable(b.complete_matrix(spark, d))
    return rounded(an.outcome_associations(m, ["n_orders", "balance", "avg_quantity", "returned"], "urgent", ["returned"]))


# ---- clustering and models (no SQL counterpart) ----------------------------


@query
def pca_k(spark, d):
    """Components kept for 90% of the variance, and each row's length in that space."""
    m = durable(b.complete_matrix(spark, d))
    model = cl.fit_projection(m, X, 0.90)
    out = cl.project(m, model).withColumn("v", cl.vector_to_array("projected"))
    return rounded(out.select("entity", F.size("v").alias("components"),
                              F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("length")))


@query
def pca_plane(spark, d):
    """Two scaled columns turned to their principal components: how many are kept, and each row's length there."""
    m = durable(b.complete_matrix(spark, d))
    out = cl.project(m, cl.fit_projection(m, ["balance", "avg_quantity"], 0.60)).withColumn("v", cl.vector_to_array("projected"))
    return rounded(out.select("entity", F.size("v").alias("components"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("length")))


def _dense(spark, d):
    m = durable(b.complete_matrix(spark, d))
    projected = durable(cl.project(m, cl.fit_projection(m, X, 0.90)))
    return cl.measure_density(projected, "projected", "entity", neighbours=10, dense_share=0.8, min_rows=20)[1]


@query
def density_core(spark, d):
    """Density over all principal components."""
    x = _dense(spark, d)
    return rounded(x.select("entity", "density_distance", F.col("density_component").cast("string").alias("component"), "density_strength"))


@query
def neighbour_density(spark, d):
    """Density of customers by balance, orders and mean quantity."""
    m = durable(b.complete_matrix(spark, d).select("entity", F.array(F.col("balance") / 1000, F.col("n_orders") / 4, F.col("avg_quantity") / 5).alias("v")))
    x = cl.measure_density(m, "v", "entity", neighbours=8, dense_share=0.7, min_rows=10)[1]
    return rounded(x.select("entity", "density_distance", F.coalesce("density_component", F.lit(-1)).alias("component"), "density_strength"))


@query
def gmm_bic(spark, d):
    core = cl.density_core(_dense(spark, d), 0.5)
    choice = cl.fit_mixture(core, "projected")
    rows = [(k, float(v), int(k == choice.k)) for k, v in choice.bic.items()]
    return spark.createDataFrame(rows, "k int, bic double, chosen int")


@query
def gmm_assign(spark, d):
    core = cl.density_core(_dense(spark, d), 0.5)
    choice = cl.fit_mixture(core, "projected")
    return cl.assign(core, choice.model).select("entity", "cluster", "cluster_prob")


def _plane(spark, d):
    """Customers by balance and orders, with the market segment as cluster."""
    m = _segmented(spark, d).fillna(0.0, subset=X)
    return m.select("entity", "cluster", F.array(F.col("balance") / 1000, F.col("n_orders") / 4).alias("v"))


@query
def mixture_posterior(spark, d):
    """Each customer's most likely segment under a mixture of the segments' own means and covariances."""
    import numpy as np

    from anchorframe.operators.mixture import Mixture

    p = durable(_plane(spark, d))
    a, c = F.col("v")[0], F.col("v")[1]
    # five rows of moments
    rows = p.groupBy("cluster").agg(F.count("*").alias("n"), F.avg(a).alias("ma"), F.avg(c).alias("mb"), F.var_pop(a).alias("saa"), F.covar_pop(a, c).alias("sab"), F.var_pop(c).alias("sbb")).orderBy("cluster").collect()
    n = np.array([r["n"] for r in rows], float)
    model = Mixture(n / n.sum(), np.array([[r["ma"], r["mb"]] for r in rows]), np.array([[[r["saa"], r["sab"]], [r["sab"], r["sbb"]]] for r in rows]))
    return rounded(cl.assign(p.drop("cluster"), model, vec="v").select("entity", "cluster", "cluster_prob"))


@query
def cluster_distances(spark, d):
    """Mean distance of each customer to the customers of each segment, over a tree of balls."""
    from anchorframe.operators.balls import ball_index, ball_sums

    p = durable(_plane(spark, d))
    sums = ball_sums(p.select(F.col("entity").alias("id"), F.col("v").alias("vec")), ball_index(p.select(F.col("v").alias("vec"), "cluster")), tolerance=1e-12)
    return rounded(sums.select("id", "cluster", (F.col("dist") / F.col("n")).alias("mean_dist"), "n"))


@query
def gbt_classifier(spark, d):
    m = durable(b.complete_matrix(spark, d))
    features = ["n_orders", "avg_price", "balance", "avg_quantity"]
    r = md.boosted_classifier(m, features, "urgent", "entity")
    return r.importances


@query
def gbt_regressor(spark, d):
    m = durable(b.complete_matrix(spark, d))
    features = ["n_orders", "avg_price", "balance", "avg_quantity"]
    r = md.boosted_regressor(m, features, "returned", "entity")
    return r.importances


@query
def cluster_analysis(spark, d):
    """The whole clustering job: clusters of the core with their size, outcome rate and mean stay."""
    a = _analysis(spark, d)
    return rounded(a.distribution.join(a.rates, "cluster").select(F.col("cluster").cast("long").alias("cluster"), "n", "pct", "outcome_rate", "mean_stay"))


@query
def outcome_models(spark, d):
    """The whole modelling job: scores of both boosted models, and the association tables' effects."""
    m = durable(b.complete_matrix(spark, d).drop("segment"))
    r = an.model_outcomes(m, ["n_orders", "avg_price", "balance", "avg_quantity"], [], "entity", "urgent", "returned")
    scores = [(f"{kind} {name}", float(v[0]), float(v[1])) for kind, report in (("classifier", r.classifier), ("regressor", r.regressor)) for name, v in report.scores.items()]
    effects = r.outcome.select(F.concat(F.lit("outcome "), "feature").alias("name"), F.col("coef").alias("value"), F.col("q_value").alias("spread")).unionByName(
        r.stay.select(F.concat(F.lit("stay "), "feature").alias("name"), F.col("coef").alias("value"), F.col("q_value").alias("spread")))
    return rounded(spark.createDataFrame(scores, "name string, value double, spread double").unionByName(effects))


def _analysis(spark, d):
    m = durable(b.complete_matrix(spark, d).drop("segment"))
    s = an.ClusterSettings(neighbours=10, dense_share=0.8, min_component_rows=10, min_strength=0.5, min_cluster_rows=10)
    return an.analyse_clusters(m, "entity", "urgent", "returned", s)


@query
def score(spark, d):
    """A clustering of all customers, then every customer scored against its core."""
    from anchorframe.operators.score import score_rows

    a = _analysis(spark, d)
    m = durable(b.complete_matrix(spark, d).drop("segment"))
    out = score_rows(m, a.bundle)
    return rounded(out.select("entity", "cluster", "cluster_prob", "density_strength", "silhouette"))


@query
def stream_scoring(spark, d):
    """The customers as a stream of files, scored batch by batch against the clustering of all."""
    from anchorframe.streaming.scoring import start_scoring

    m = durable(b.complete_matrix(spark, d).drop("segment"))
    source, out = _folder(spark, "stream-in"), _folder(spark, "stream-out")
    m.repartition(2).write.parquet(source)
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(source)
    start_scoring(stream, _analysis(spark, d).bundle, out, _folder(spark, "stream-state"), available_now=True).awaitTermination()
    return rounded(spark.read.parquet(out).select("entity", "cluster", "cluster_prob", "density_strength", "silhouette"))
