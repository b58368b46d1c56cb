from conftest import A, as_dict, plus

from anchorframe.core import HOUR, TimeWindow
from anchorframe.operators import windows as wj


def values(df):
    return sorted(r["value"] for r in df.collect())


def test_point_window_bounds_are_closed(points, anchors):
    rows = [(1, plus(0), "x", 1.0), (1, plus(-12), "x", 2.0), (1, plus(0, 1), "x", 3.0), (1, plus(-12, -1), "x", 4.0), (2, plus(0), "x", 5.0)]
    assert values(wj.in_window(points(rows), anchors(), TimeWindow.before(12))) == [1.0, 2.0]
    assert values(wj.in_window(points(rows), anchors(), TimeWindow.around(12))) == [1.0, 2.0, 3.0]
    assert values(wj.in_window(points(rows), anchors(), TimeWindow(-12 * HOUR, 0, False, False))) == []


def test_missing_anchor_gives_no_rows(points, anchors):
    assert wj.in_window(points([(1, plus(0), "x", 1.0)]), anchors([(1, None)]), TimeWindow.before(12)).count() == 0


def test_overlap_closed_and_strict(intervals, anchors):
    rows = [
        (1, plus(-14), plus(-12), "touch_start", 1.0),
        (1, plus(0), plus(1), "touch_end", 1.0),
        (1, plus(-13), plus(-11), "cross_start", 1.0),
        (1, plus(-20), plus(5), "cover", 1.0),
        (1, plus(1), plus(2), "after", 1.0),
        (1, plus(-1), None, "no_end", 1.0),
    ]
    labels = lambda df: {r["label"] for r in df.collect()}
    w = TimeWindow.before(12)
    assert labels(wj.overlapping(intervals(rows), anchors(), w)) == {"touch_start", "touch_end", "cross_start", "cover"}
    assert labels(wj.overlapping(intervals(rows), anchors(), w, strict=True)) == {"cross_start", "cover"}


def test_nearest_record_skips_nulls_and_breaks_ties_early(points, anchors):
    rows = [(1, plus(-13), "x", 7.0), (1, plus(-11), "x", 8.0), (1, plus(-12), "x", None), (2, plus(5), "x", 9.0)]
    got = as_dict(wj.nearest_record(points(rows), anchors(), "value", -12 * HOUR))
    assert got[1]["value"] == 7.0
    assert got[2]["value"] == 9.0  # no anchor: the first value on record


def test_keep_first_set_operations(points, cohort):
    rows = [(1, plus(2), "x", 1.0), (1, plus(1), "y", 2.0), (2, A, "x", None)]
    got = as_dict(wj.keep_first(points(rows), ["entity"], ["ts"]))
    assert got[1]["value"] == 2.0 and got[1]["label"] == "y" and got[2]["value"] is None
    assert [r["entity"] for r in wj.without(cohort([1, 3]), points(rows)).collect()] == [3]
    assert [r["entity"] for r in wj.in_both(cohort([1, 3]), cohort([1, 2])).collect()] == [1]
