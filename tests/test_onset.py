import pytest
from conftest import A, as_dict, plus

from anchorframe.core import HOUR
from anchorframe.operators import onset as on


def test_first_index_event_keeps_null_only_entities(spark, points):
    got = as_dict(on.first_index_event(points([(1, plus(2), "x", 0.0), (1, plus(1), "x", 0.0), (2, None, "x", 0.0), (None, A, "x", 0.0)])))
    assert set(got) == {1, 2} and got[2]["anchor_ts"] is None
    assert got[1]["anchor_ts"] == plus(1).replace(tzinfo=None)


def test_peak_summary(points, anchors):
    rows = [(1, plus(1), "x", 2.0), (1, plus(50), "x", 1.5), (1, plus(60), "x", 5.0), (1, plus(70), "x", 5.0), (1, plus(80), "x", None),
            (1, plus(-1), "x", 9.0), (1, plus(days=7, us=1), "x", 9.0), (2, plus(1), "x", None)]
    got = as_dict(on.peak_summary(points(rows), anchors([(1, A), (2, A)])))
    assert set(got) == {1}  # nothing but missing values: no peak
    assert got[1]["n_points"] == 5 and got[1]["peak_value"] == 5.0
    assert got[1]["peak_ts"] == plus(60).replace(tzinfo=None)
    assert got[1]["min_before_peak"] == 1.5  # the value 59 hours before the peak is out


def test_baseline_rules(points, anchors):
    rows = [
        (1, plus(days=-7), "x", 3.0), (1, plus(0), "x", 2.0), (1, plus(days=-8), "x", 1.0),  # two in the closed week
        (2, plus(days=-1), "x", 4.0), (2, plus(days=-20), "x", 6.0), (2, plus(days=-30), "x", 100.0),  # one: median of the open month
        (3, plus(days=-30), "x", 8.0),  # exactly 30 days: only the 90-day rule sees it
        (4, plus(days=-365), "x", 8.0), (4, plus(days=3), "x", 5.0), (4, plus(days=2), "x", 7.0),  # left-open year: post rules
        (5, plus(days=40), "x", 6.0), (5, plus(days=50), "x", 1.0),
        (6, plus(days=400), "x", 1.0),
        (7, plus(days=-1), "x", None), (7, plus(days=-2), "x", 9.0),  # a missing value counts as a row in the first rule
    ]
    got = as_dict(on.baseline_cascade(points(rows), anchors([(i, A) for i in range(1, 8)] + [(9, None)])))
    rule = {k: (v["baseline_rule"], v["baseline_value"]) for k, v in got.items()}
    assert rule == {
        1: ("pre_7d_min", 2.0), 2: ("pre_1m_median", 5.0), 3: ("pre_3m_median", 8.0), 4: ("post_1m_min", 5.0),
        5: ("post_1y_oldest", 6.0), 6: ("none", None), 7: ("pre_7d_min", 9.0), 9: ("none", None),
    }
    assert got[2]["baseline_ts"] == plus(days=-20).replace(tzinfo=None)  # equally near: the earlier one


def test_rolling_minimum_is_left_open(points):
    rows = [(1, plus(0), "x", 1.0), (1, plus(0, 1), "x", 2.0), (1, plus(48), "x", 5.0), (1, plus(48), "x", 4.0)]
    got = {(r["ts"], r["value"]): r["m"] for r in on.rolling_minimum(points(rows), 48 * HOUR, "m").collect()}
    n = lambda t: t.replace(tzinfo=None)
    assert got[(n(plus(48)), 5.0)] == 2.0  # the row exactly 48 h earlier is out, the one a microsecond later is in
    assert got[(n(plus(48)), 4.0)] == 2.0
    assert got[(n(plus(0)), 1.0)] == 1.0


def test_detect_onset_takes_the_earlier_hit(spark, points, anchors):
    base = spark.createDataFrame([(1, A, 1.0), (2, A, None), (3, A, 1.0), (4, None, 1.0)], "entity long, anchor_ts timestamp, baseline_value double")
    rows = [
        (1, plus(1), "x", 1.0), (1, plus(2), "x", 1.3), (1, plus(3), "x", 1.6),
        (2, plus(1), "x", 9.0), (2, plus(60), "x", 9.5),
        (3, plus(days=7), "x", 1.5), (3, plus(days=-1), "x", 0.1),
        (4, plus(1), "x", 9.0),
    ]
    got = as_dict(on.detect_onset(points(rows), base))
    assert got[1]["rise_flag"] and got[1]["ratio_flag"] and got[1]["onset_ts"] == plus(2).replace(tzinfo=None)
    assert got[1]["days_to_onset"] == pytest.approx(2 / 24)
    assert not got[2]["onset_flag"] and got[2]["onset_ts"] is None and got[2]["status"] == "no onset"
    assert got[3]["ratio_flag"] and not got[3]["rise_flag"]
    assert not got[4]["onset_flag"]


def test_detect_onset_without_points(points, spark):
    base = spark.createDataFrame([(1, A, 1.0)], "entity long, anchor_ts timestamp, baseline_value double")
    row = on.detect_onset(points([]), base).first()
    assert row["onset_flag"] is False and row["onset_ts"] is None


def test_compare_onsets(spark):
    schema = "entity long, onset_flag boolean, onset_ts timestamp"
    o = spark.createDataFrame([(1, True, plus(0)), (2, True, plus(1)), (3, True, None), (4, False, None)], schema)
    n = spark.createDataFrame([(1, True, plus(0)), (2, True, plus(5)), (3, True, plus(1)), (4, True, plus(1)), (5, True, plus(1))], schema)
    rows, tally = on.compare_onsets(o, n, "both_true", 0)
    assert tuple(tally.first()) == (3, 1, 0, 1, 1)
    assert [r["entity"] for r in on.order_comparison(rows).collect()] == [2, 3, 1]
    assert on.compare_onsets(o, n, "new_true")[0].count() == 4
    assert on.compare_onsets(o, n, "both_true", 4 * HOUR)[1].first()["n_match"] == 2
    with pytest.raises(ValueError):
        on.compare_onsets(o, n, "neither")


def test_flags_from_text(spark):
    df = spark.createDataFrame([(" No AKI ", "True"), ("AKI stage 1", "0"), (None, "aki")], "stage string, text string")
    got = df.select(on.stage_means_onset("stage", ["no aki", "none"]).alias("s"), on.text_means_onset("text", ["true", "1", "aki"]).alias("t")).collect()
    assert [tuple(r) for r in got] == [(False, True), (True, False), (True, True)]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (6.99,), (7.0,), (7.1,)], "x double")
    h = {r["bin"]: r["n"] for r in on.fixed_width_histogram(df, "x", 0.0, 7.0, 28).collect()}
    assert len(h) == 28 and h[0] == 1 and h[1] == 1 and h[27] == 2 and sum(h.values()) == 4


def test_stage_distribution(spark):
    df = spark.createDataFrame([(1, "b2"), (1, "b2"), (2, "b"), (3, "a"), (4, "z")], "entity long, stage string")
    got = [tuple(r) for r in on.stage_distribution(df, "stage", ["b", "a", "c"], {"b2": "b"}).orderBy("position").collect()]
    assert got == [(0, "b", 2, 0.5), (1, "a", 1, 0.25)]
