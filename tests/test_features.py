import pytest
from conftest import A, as_dict, plus
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs

from anchorframe.operators import features as ft


def test_means_respect_limits_and_rounding(points, anchors):
    rows = [(1, plus(-1), "hr", 80.0), (1, plus(-2), "hr", 81.0), (1, plus(-3), "hr", 500.0), (1, plus(-1), "other", 5.0), (1, plus(-1), "bp", 19.0), (1, plus(-2), "hr", 80.004)]
    row = ft.windowed_mean_matrix(points(rows), anchors(), {"hr": (20, 300), "bp": (20, 200)}).first().asDict()
    assert row == {"entity": 1, "hr": 80.33, "bp": None}


def test_dose_sums(intervals, anchors, cohort):
    rows = [(1, plus(-1), plus(1), "a", 2.0), (1, plus(-12), plus(-11), "a", 3.0), (1, plus(-2), plus(0), "b", None), (2, plus(-1), plus(-1), "a", 5.0)]
    start = as_dict(ft.dose_by_start_matrix(intervals(rows), anchors([(1, A), (3, A)]), cohort([1, 2, 3]), ["a", "b"]))
    assert start[1] == {"entity": 1, "a": 5.0, "b": 0.0}  # only missing amounts: 0
    assert start[2]["a"] is None and start[3]["a"] is None  # no anchor; no dose
    end = as_dict(ft.dose_by_end_matrix(intervals(rows), anchors(), ["a", "b", "c"]))
    assert end == {1: {"entity": 1, "a": 3.0}}  # b and c were never given


def test_overlap_flag_and_sum(intervals, anchors, cohort):
    rows = [(1, plus(-20), plus(-12), "a", 2.0), (1, plus(-1), plus(3), "a", 4.0), (1, plus(-1), None, "b", 1.0)]
    flags = as_dict(ft.overlap_flag_matrix(intervals(rows), anchors([(1, A), (2, A)]), cohort([1, 2]), ["a", "b"]))
    assert flags == {1: {"entity": 1, "a": 1, "b": 0}, 2: {"entity": 2, "a": 0, "b": 0}}
    sums = as_dict(ft.overlap_sum_matrix(intervals(rows), anchors([(1, A), (2, A)]), cohort([1, 2, 3]), ["a", "b"]))
    assert sums == {1: {"entity": 1, "a": 6.0, "b": None}, 2: {"entity": 2, "a": None, "b": None}}


def test_prorated(intervals, anchors):
    rows = [(1, plus(-14), plus(-10), " drug A", 8.0), (1, plus(-1), plus(1), "DRUG a", 2.0), (1, plus(0), plus(5), "drug a", 9.0),
            (1, plus(-1), plus(-1), "instant", 3.0), (1, plus(-2), plus(-1), "drug a", None)]
    row = ft.prorated_overlap_matrix(intervals(rows), anchors(), prefix="vaso_").first().asDict()
    # half of 8 + half of 2; the instant overlaps strictly but has no length
    assert row == {"entity": 1, "vaso_Drug A": 5.0, "vaso_Instant": 0.0}


def test_union_minutes(intervals, anchors):
    rows = [
        (1, plus(-13), plus(-11), "Vent", 0.0),  # 60 inside
        (1, plus(-11), plus(-10), "vent ", 0.0),  # touching: 60 more
        (1, plus(-10.5), plus(-10.2), "vent", 0.0),  # nested
        (1, plus(-1), plus(1), "vent", 0.0),  # 60 inside
        (1, plus(-5), None, "vent", 0.0),  # instant
        (1, plus(-3), plus(-3), "tube", 0.0),
        (2, plus(-3), plus(-2), "tube", 0.0),
    ]
    i, a = intervals(rows), anchors([(1, A), (2, A)])
    assert [tuple(r) for r in ft.union_minutes(i, a, ["vent"]).collect()] == [(1, "vent", 180.0)]
    assert [tuple(r) for r in ft.interval_presence(i, a, ["Tube"]).collect()] == [(2, "Tube", 1.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(hs.lists(hs.tuples(hs.floats(-20, 4), hs.floats(0, 9)), min_size=1, max_size=12))
def test_union_properties(spark, intervals, anchors, spans):
    rows = [(1, plus(s), plus(s + n), "v", 1.0) for s, n in spans]
    i, a = intervals(rows), anchors()
    got = ft.union_minutes(i, a, ["v"]).first()
    minutes = got["value"] if got else 0.0
    clipped = sum(max(0.0, min(s + n, 0) - max(s, -12)) * 60 for s, n in spans)
    assert -1e-6 <= minutes <= 720 + 1e-6 and minutes <= clipped + 1e-4
    part = ft.prorated_overlap(i, a).first()
    assert (part["value"] if part else 0.0) <= len(spans) + 1e-9


def test_standardised_and_fixed_flags(intervals, anchors):
    rows = [(1, None, plus(-1), " FUROSEMIDE", 0.0), (1, None, plus(-2), "furosemide", 0.0), (1, None, plus(-3), "Odd Name ", 0.0), (2, None, plus(-1), "nothing listed", 0.0), (3, None, plus(1), "furosemide", 0.0)]
    i, a = intervals(rows), anchors([(1, A), (2, A), (3, A)])
    got = as_dict(ft.standardised_flag_matrix(i, a, {"furosemide": "Furosemide"}))
    assert got[1] == {"entity": 1, "Furosemide": 1, "Odd Name ": 1, "nothing listed": 0} and got[2]["nothing listed"] == 1 and 3 not in got
    fixed = as_dict(ft.fixed_flag_matrix(i, a, ["furosemide", "other"]))
    assert fixed == {1: {"entity": 1, "furosemide": 1, "other": 0}, 2: {"entity": 2, "furosemide": 0, "other": 0}}


def test_names_that_differ_in_case_are_refused(intervals, anchors):
    with pytest.raises(ValueError):
        ft.standardised_flag_matrix(intervals([(1, None, plus(-1), "x", 0.0), (1, None, plus(-1), "X", 0.0)]), anchors(), {})


def test_outcome_days_are_floored_then_clipped(spark, anchors, cohort):
    events = {1: plus(-1), 2: plus(0), 3: plus(days=90, hours=23), 4: plus(days=91), 5: None, 6: plus(0)}
    out = spark.createDataFrame(list(events.items()), "entity long, event_ts timestamp")
    got = as_dict(ft.outcome_within_horizon(out, anchors([(i, A) for i in range(1, 6)] + [(6, None)]), cohort(range(1, 7))))
    assert {k: v["outcome"] for k, v in got.items()} == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0}


def test_outcome_order_column(spark, anchors, cohort):
    out = spark.createDataFrame([(1, 2, plus(1)), (1, 1, None)], "entity long, pos int, event_ts timestamp")
    assert ft.outcome_within_horizon(out, anchors(), cohort([1]), order="pos").first()["outcome"] == 0


def test_stays(spark, intervals, anchors, cohort):
    rows = [(1, plus(-3), plus(60), "s1", None), (1, plus(-10), plus(1), "s2", None), (2, plus(-13), plus(50), "s3", None)]
    i, a = intervals(rows), anchors([(1, A), (2, A), (3, A)])
    got = {k: v["stay_days"] for k, v in as_dict(ft.stay_before_anchor(i, a, cohort([1, 2, 3]))).items()}
    assert got == {1: 2, 2: 0, 3: 0}
    every = sorted(tuple(r) for r in ft.stay_lengths(i, a, cohort([1, 2, 3])).collect())
    assert every == [(1, 0), (1, 2), (2, 0), (3, 0)]


def test_history(spark, cohort):
    h = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (9, "a")], "entity long, label string")
    assert as_dict(ft.history_matrix(h, cohort([1, 2, 3]))) == {1: {"entity": 1, "a": 1, "b": 0}, 2: {"entity": 2, "a": 0, "b": 1}, 3: {"entity": 3, "a": 0, "b": 0}}


def test_covered_time_over_cell_borders(spark):
    """Pieces that end at, start at, span and touch borders, before and after time 0, in any cell width."""
    import random

    rng = random.Random(2)
    rows = [(k, s, s + rng.choice([0, 1, 5, 10, 25, 70])) for k in range(12) for s in (rng.randrange(-60, 60) for _ in range(rng.randint(1, 14)))]
    rows += [(20, -10, 0), (20, 0, 10), (21, -10, -1), (21, 0, 10), (22, 10, 20), (22, 20, 30), (23, 10, 20), (23, 21, 30), (24, 0, 0), (25, 10, 10), (25, 5, 10)]
    want = {}
    for k in {r[0] for r in rows}:
        reach, covered, islands = None, 0, 0
        for _, s, e in sorted(r for r in rows if r[0] == k):
            if reach is None or s > reach:
                islands, covered, reach = islands + 1, covered + e - s, e
            elif e > reach:
                covered, reach = covered + e - reach, e
        want[k] = (covered, islands)
    df = spark.createDataFrame(rows, "k int, s_us long, e_us long")
    for width in (1, 10, 7, 1_000):
        assert {r.k: (r.covered_us, r.islands) for r in ft.covered_time(df, ["k"], width).collect()} == want, width


def test_observed_names_are_bounded(spark):
    df = spark.createDataFrame([(x,) for x in "cabbc"], "feature string")
    assert ft.observed_features(df) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        ft.observed_features(df, most=2)
