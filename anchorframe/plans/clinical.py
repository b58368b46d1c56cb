"""The whole intensive-care study as one job: CSV extracts in, result tables out.

Stages meet in Parquet, so a lost executor costs at most one stage, and every
later stage reads columns it needs from a finished table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorframe.functions.scalar import gender_code, title_case
from anchorframe.operators import features as ft
from anchorframe.operators import matrix as mx
from anchorframe.operators import onset as on
from anchorframe.operators import rules, series
from anchorframe.operators import stats as st
from anchorframe.operators.models import Boosting
from anchorframe.operators.score import append_scored, score_rows
from anchorframe.operators.windows import attach_bridge, restrict_to_cohort
from anchorframe.plans import vocabulary as voc
from anchorframe.plans.analysis import ClusterAnalysis, ClusterSettings, OutcomeModels, analyse_clusters, model_outcomes
from anchorframe.session import configure
from anchorframe.sources.readers import (
    as_intervals,
    as_points,
    read_csv_table,
    require_columns,
    with_end_column,
)
from anchorframe.sources.sinks import write_csv, write_parquet

_TYPES = {
    "subject_id": "id",
    "valuenum": "double",
    "creatinine_mg_dl": "double",
    "amount": "double",
    "totalamount": "double",
    "value": "double",
    "rate": "double",
    "age": "double",
    "charttime": "timestamp",
    "starttime": "timestamp",
    "endtime": "timestamp",
    "stoptime": "timestamp",
    "suspected_infection_time": "timestamp",
    "admittime": "timestamp",
    "intime": "timestamp",
    "outtime": "timestamp",
    "dod": "date",
}


@dataclass
class StudyTables:
    """The input tables, from a folder of CSV files.

    With ``staged`` every file is parsed once: the first use writes its typed rows as Parquet there, and each use reads
    the columns it needs.  Staged tables are not bucketed by entity: joins then could not split a hot entity's bucket.
    """

    spark: SparkSession
    folder: str
    staged: str | None = None
    tables: dict[tuple[str, ...], DataFrame] = field(default_factory=dict)

    def read(self, *names: str) -> DataFrame:
        if names not in self.tables:
            df = read_csv_table(self.spark, [f"{self.folder}/{n}.csv" for n in names], _TYPES).withColumnRenamed("subject_id", "entity")
            if self.staged is not None:
                path = f"{self.staged}/{'+'.join(names)}"
                write_parquet(df, path)
                df = self.spark.read.schema(df.schema).parquet(path)
            self.tables[names] = df
        return self.tables[names]

    def index_events(self) -> DataFrame:
        return as_points(self.read("sepsis_diagnose_time"), "entity", "suspected_infection_time")

    def marker(self) -> DataFrame:
        return as_points(self.read("creatinine_over_time"), "entity", "charttime", "valuenum")

    def marker_history(self) -> DataFrame:
        return as_points(self.read("creatinine"), "entity", "charttime", "creatinine_mg_dl")

    def vitals(self) -> DataFrame:
        stays = self.read("sepsis_diagnose_time").select("stay_id", "entity").filter(F.col("entity").isNotNull())
        rows = self.read("vitals1", "vitals2", "vitals3").select("stay_id", "charttime", "label", "valuenum")
        return as_points(attach_bridge(rows, stays, "stay_id"), "entity", "charttime", "valuenum", "label")

    def inputs(self) -> DataFrame:
        return self.read("inputevents_sepsis1", "inputevents_sepsis2", "inputevents_sepsis3")

    def procedures(self) -> DataFrame:
        rows = require_columns(self.read("procedureevents_sepsis"), ["item_label", "starttime"], "procedure events")
        return as_intervals(with_end_column(rows), "entity", "starttime", "end_ts", "item_label")

    def vasopressors(self) -> DataFrame:
        bridge = self.read("VASO").select("stay_id", "entity")
        return attach_bridge(self.read("vasopressors"), bridge, "stay_id")

    def stays(self) -> DataFrame:
        return as_intervals(self.read("sepsis3_los_dod"), "entity", "intime", "outtime", "stay_id")

    def deaths(self) -> DataFrame:
        return self.read("sepsis3_los_dod").select("entity", F.col("dod").alias("event_ts"))

    def conditions(self) -> DataFrame:
        return self.read("sepsis_preex_conditions").select("entity", F.col("condition").alias("label"))

    def ages(self) -> DataFrame:
        return as_points(self.read("age"), "entity", "admittime", "age")


def find_onsets(t: StudyTables) -> DataFrame:
    """Per patient: first index event, baseline, peak, and first onset."""
    anchors = on.first_index_event(t.index_events())
    marker = restrict_to_cohort(t.marker(), anchors)
    # only patients with a marker take part
    anchors = restrict_to_cohort(anchors, marker)
    peaks = on.peak_summary(marker, anchors).select("entity", "peak_value", "min_before_peak")
    base = on.baseline_cascade(marker, anchors).join(peaks, "entity", "left")
    return on.detect_onset(marker, base, rise=0.3, ratio=1.5, status=voc.STATUS)


def build_matrix(t: StudyTables, onsets: DataFrame) -> DataFrame:
    """One row per patient with onset and vitals."""
    anchors = on.onset_anchors(onsets)
    cohort = on.onset_cohort(onsets)
    indexed = restrict_to_cohort(t.inputs(), onsets)
    doses = as_intervals(indexed, "entity", "starttime", "endtime", "item_label", "amount")
    totals = as_intervals(indexed, "entity", "starttime", "endtime", "item_label", "totalamount")
    fluids = as_intervals(
        indexed.filter(F.col("item_category") == voc.FLUID_CATEGORY), "entity", "starttime", "endtime", "item_label", "amount"
    )
    diu = restrict_to_cohort(as_intervals(t.read("DIU"), "entity", None, "stoptime", "drug"), cohort)
    ace = restrict_to_cohort(as_intervals(t.read("ACE_ARB"), "entity", None, "stoptime", "drug"), cohort)
    pressors = as_intervals(t.vasopressors(), "entity", "starttime", "endtime", "label", "amount")

    def block(rows: DataFrame, names, fill=None, prefix="", digits=None) -> mx.FeatureBlock:
        return mx.FeatureBlock(rows, tuple(names), fill, prefix, digits)

    gender = t.read("gender").select("entity", F.lit("gender").alias("feature"), gender_code("gender").cast("double").alias("value"))
    age = ft.nearest_attribute(t.ages(), anchors).select("entity", F.lit("age_12h_before_AKI").alias("feature"), "value")
    fluid_rows = ft.windowed_dose(fluids, anchors)
    diuretic_rows = ft.windowed_dose(doses, anchors, voc.DIURETICS, by="end_ts")
    std_rows = ft.standardised_flag(diu, anchors, voc.DIURETIC_NAMES)
    pressor_rows = ft.prorated_overlap(pressors, anchors)
    condition_rows = ft.history_flag(t.conditions(), cohort)
    ventilation = ft.combined_interval_rows(
        doses, t.procedures(), anchors, voc.INOTROPICS, voc.PRESENCE_PROCEDURES, voc.TIMED_PROCEDURES
    )
    died = ft.outcome_within_horizon(t.deaths(), anchors, cohort)
    stay = ft.stay_before_anchor(t.stays(), anchors, cohort)
    single = lambda df, c, name: df.select("entity", F.lit(name).alias("feature"), F.col(c).cast("double").alias("value"))

    vitals = block(ft.windowed_mean(t.vitals(), anchors, voc.VITAL_LIMITS), voc.VITAL_LIMITS, digits=2)
    blocks = [
        block(gender, ["gender"]),
        block(age, ["age_12h_before_AKI"]),
        block(fluid_rows, ft.observed_features(fluid_rows), digits=2),
        # drugs that were never given get no column
        block(diuretic_rows, ft.observed_features(diuretic_rows.filter(F.col("value") != 0)), "present", digits=2),
        block(std_rows, ft.observed_features(std_rows), "present"),
        block(ft.fixed_flag(ace, anchors, voc.ACE_DRUGS + voc.ARB_DRUGS), voc.ACE_DRUGS + voc.ARB_DRUGS),
        block(pressor_rows, ft.observed_features(pressor_rows), "present", "vaso_", 2),
        block(ft.overlap_flag(doses, anchors, voc.ANTIBIOTICS), voc.ANTIBIOTICS, "all"),
        block(ft.overlap_sum(totals, anchors, voc.OTHER_MEDICATION), voc.OTHER_MEDICATION),
        block(ventilation, voc.INOTROPICS + voc.PRESENCE_PROCEDURES + voc.TIMED_PROCEDURES, "all"),
        block(condition_rows, ft.observed_features(condition_rows), "all"),
        block(single(died, "outcome", voc.OUTCOME_COLUMN), [voc.OUTCOME_COLUMN]),
        block(single(stay, "stay_days", voc.STAY_COLUMN), [voc.STAY_COLUMN], "all"),
    ]
    return mx.assemble_matrix(cohort, [b for b in blocks if b.features], vitals, keep_empty=["gender", "age_12h_before_AKI"])


def marker_series(t: StudyTables, onsets: DataFrame) -> DataFrame:
    keyed = onsets.select("entity", F.col("onset_ts").alias("anchor_ts"), "baseline_value")
    return series.centred_series(t.marker_history(), keyed)


def heart_rate_series(t: StudyTables, onsets: DataFrame) -> DataFrame:
    points = restrict_to_cohort(t.vitals(), on.onset_cohort(onsets))
    limits = {"Heart Rate": voc.VITAL_LIMITS["Heart Rate"]}
    s = series.chronological_series(points, on.onset_anchors(onsets), limits)
    return s.select("entity", "hours_before", F.col("value").alias("Heart Rate"))


def medication_log(t: StudyTables, onsets: DataFrame) -> tuple[DataFrame, DataFrame]:
    inputs = t.inputs()
    ace = t.read("ACE_ARB")
    pressors = t.vasopressors().withColumn("drug", title_case("label"))
    listed = lambda df, c, names: df.filter(F.col(c).isin(names))
    sources = [
        series.normalise_events(listed(inputs, "item_label", voc.ANTIBIOTICS), "item_label", "value"),
        series.normalise_events(listed(inputs, "item_label", voc.DIURETICS), "item_label", "amount"),
        series.normalise_events(listed(ace, "drug", voc.ACE_DRUGS + voc.ARB_DRUGS), "drug"),
        series.normalise_events(pressors, "drug", "amount"),
    ]
    return series.unified_event_log(sources, on.onset_anchors(onsets))


def dashboard(core: DataFrame) -> DataFrame:
    """Cluster, scores, selected features, colours and texts per patient."""
    cols = [c for c in voc.DASHBOARD_COLUMNS if c in core.columns]
    colours = {"silhouette_colour": "silhouette", "cluster_colour": "cluster_prob"}
    return rules.annotate(core.select("entity", *[F.col(f"`{c}`") for c in cols]), colours, voc.CLUSTER_TEXT, voc.FEATURE_TEXT)


@dataclass
class StudyResult:
    onsets: DataFrame
    matrix: DataFrame
    clusters: ClusterAnalysis | None


def _subject(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("entity", "subject_id")


def run_study(
    spark: SparkSession,
    data: str,
    out: str,
    settings: ClusterSettings | None = None,
    cluster: bool = True,
) -> StudyResult:
    """Every stage in order; tables land under ``out``."""
    configure(spark)
    t = StudyTables(spark, data, f"{out}/staged")
    write_parquet(find_onsets(t), f"{out}/onsets")
    onsets = spark.read.parquet(f"{out}/onsets")
    write_csv(_subject(on.onset_cohort(onsets, voc.STATUS[0])), f"{out}/cohort_csv")

    write_parquet(build_matrix(t, onsets), f"{out}/matrix")
    raw = spark.read.parquet(f"{out}/matrix")
    present = [c for c in voc.MEDIAN_COLUMNS if c in raw.columns]
    missing, medians, filled = mx.impute_matrix(raw, present, voc.DROPPED_COLUMNS)
    write_parquet(filled, f"{out}/matrix_filled")
    matrix = spark.read.parquet(f"{out}/matrix_filled")
    write_csv(_subject(matrix), f"{out}/matrix_filled_csv")
    write_csv(missing, f"{out}/missing_csv")
    write_csv(medians, f"{out}/medians_csv")

    write_csv(_subject(marker_series(t, onsets)), f"{out}/dashboard/creatinine_filtered", comma=True)
    write_parquet(heart_rate_series(t, onsets), f"{out}/heart_rate")
    rate = spark.read.parquet(f"{out}/heart_rate")
    write_csv(_subject(series.newest_last(rate)), f"{out}/dashboard/vitals_chronological", comma=True)
    write_csv(_subject(series.entity_lookup(rate)), f"{out}/dashboard/subject_ids")
    history = series.history_long(t.conditions(), on.onset_cohort(onsets))
    write_csv(_subject(history), f"{out}/dashboard/conditions_per_subject", comma=True)
    amounts, flags = medication_log(t, onsets)
    write_csv(_subject(amounts), f"{out}/dashboard/medication_amounts", comma=True)
    write_csv(_subject(flags), f"{out}/dashboard/medication_flags", comma=True)

    if not cluster:
        return StudyResult(onsets, matrix, None)
    found = cluster_study(matrix, settings)
    found.bundle.save(f"{out}/models")
    write_csv(found.feature_tests, f"{out}/dashboard/cluster_feature_importance")
    write_csv(_subject(dashboard(found.core)), f"{out}/dashboard/df_dashboard")
    return StudyResult(onsets, matrix, found)


def cluster_study(matrix: DataFrame, settings: ClusterSettings | None = None) -> ClusterAnalysis:
    settings = settings or ClusterSettings(min_strength=0.835)
    return analyse_clusters(matrix, "entity", voc.OUTCOME_COLUMN, voc.STAY_COLUMN, settings, voc.NEW_PATIENT_VALUES)


def compare_study_clusters(found: ClusterAnalysis) -> tuple[DataFrame, DataFrame, DataFrame]:
    names = [f for f in voc.COMPARED_FEATURES if f in found.core.columns]
    return st.compare_clusters(found.core, found.feature_tests, names)


def model_study(
    matrix: DataFrame,
    settings: ClusterSettings | None = None,
    classifier: Boosting = Boosting(),
    regressor: Boosting = Boosting(rounds=800),
) -> OutcomeModels:
    """Cluster, then relate the core patients' features to both outcomes."""
    core = cluster_study(matrix, settings or ClusterSettings()).core
    return model_outcomes(
        core, voc.MODEL_FEATURES, voc.BINARY_FEATURES, "entity", voc.OUTCOME_COLUMN, voc.STAY_COLUMN, classifier, regressor
    )


def score_patients(rows: DataFrame, found: ClusterAnalysis) -> tuple[DataFrame, DataFrame]:
    """Score new patient rows; returns them and the dashboard of core and new patients together."""
    scored = score_rows(rows, found.bundle)
    return scored, dashboard(append_scored(found.core, scored))
