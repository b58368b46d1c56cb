import pytest
from conftest import A, as_dict, plus

from anchorframe.operators import matrix as mx
from anchorframe.operators import rules, series


def long(spark, rows):
    return spark.createDataFrame(rows, "entity long, feature string, value double")


def test_assemble_fills_by_block(spark, cohort):
    v = mx.FeatureBlock(long(spark, [(1, "hr", 80.004), (2, "hr", 0.0), (3, "hr", 1.0)]), ("hr",), digits=2)
    some = mx.FeatureBlock(long(spark, [(1, "a", 5.0), (9, "a", 1.0)]), ("a", "b"), "present", "p_")
    flags = mx.FeatureBlock(long(spark, [(3, "f", 1.0)]), ("f",), "all")
    plain = mx.FeatureBlock(long(spark, [(4, "g", 1.0)]), ("g",))
    got = as_dict(mx.assemble_matrix(cohort([1, 2, 3, 4]), [some, flags, plain], required=v))
    assert got == {
        1: {"entity": 1, "hr": 80.0, "p_a": 5.0, "p_b": 0.0, "f": 0.0, "g": None},
        3: {"entity": 3, "hr": 1.0, "p_a": None, "p_b": None, "f": 1.0, "g": None},
    }  # 2 has nothing but zeros, 4 no required feature
    with pytest.raises(ValueError):
        mx.assemble_matrix(cohort([1]), [plain, plain])


def test_chain_join_checks_names(spark, cohort):
    a = spark.createDataFrame([(1, 2.0)], "entity long, x double")
    assert mx.chain_join(cohort([1, 2]), [a]).count() == 2
    with pytest.raises(ValueError):
        mx.chain_join(cohort([1]), [a, a])


def test_empty_rows_and_zero_columns(spark):
    df = spark.createDataFrame([(1, 0.0, None, 4.0), (2, 0.0, 1.0, 0.0)], "entity long, a double, b double, age double")
    assert [r["entity"] for r in mx.drop_empty_rows(df, ["entity", "age"]).collect()] == [2]
    assert mx.drop_zero_columns(df, ["entity"]).columns == ["entity", "b", "age"]


def test_impute(spark):
    df = spark.createDataFrame([(1, 1.0, None, 5.0, 9.0), (2, 4.0, 2, None, 9.0), (3, None, None, 7.0, 9.0)], "entity long, `v 1` double, n int, o double, t double")
    missing, medians, filled = mx.impute_matrix(df, ["v 1"], drop=["t"])
    assert {r["feature"]: r["median"] for r in medians.collect()} == {"v 1": 2.5}
    assert sorted(map(tuple, filled.collect())) == [(1, 1.0, 0, 5.0), (2, 4.0, 2, 0.0), (3, 2.5, 0, 7.0)]
    assert {r["feature"]: r["missing"] for r in missing.collect()} == {"entity": 0, "v 1": 0, "n": 0, "o": 0}
    assert {r["feature"]: r["missing"] for r in mx.null_counts(df).collect()}["n"] == 2


def test_fill_from_constants(spark):
    df = spark.createDataFrame([(1, None, None, None)], "entity long, hr double, dose double, note string")
    assert tuple(mx.fill_from_constants(df, {"hr": 88.18}).first()) == (1, 88.18, 0.0, None)


def test_event_log_prefers_amounts(spark, anchors):
    t = plus(-1)
    df = spark.createDataFrame([(1, "drug", 2.345, "mg", t), (1, "drug", 9.0, "mg", t), (1, "drug", None, None, t), (1, "bare", None, None, t), (1, "late", None, None, plus(1))],
                               "entity long, name string, amount double, amountuom string, starttime timestamp")
    log = series.normalise_events(df, "name", "amount")
    amounts, flags = series.unified_event_log([log, log], anchors())
    assert [tuple(r)[:4] for r in amounts.collect()] == [(1, "drug", 2.34, "mg")]
    assert [tuple(r)[:3] for r in flags.collect()] == [(1, "bare", 1)]
    bare = series.normalise_events(df.drop("amountuom", "starttime"), "name", "no_amount")
    assert set(bare.first().asDict().values()) == {1, "drug", None}


def test_series(points, anchors, spark):
    rows = [(1, plus(-1, 1), "hr", 80.0), (1, plus(-1), "hr", 90.0), (1, plus(-2), "hr", 400.0), (1, plus(-3), "hr", 70.0)]
    s = series.chronological_series(points(rows), anchors(), {"hr": (20, 300)})
    assert [(r["hours_before"], r["value"]) for r in series.newest_last(s).collect()] == [(3.0, 70.0), (1.0, 85.0)]
    assert series.entity_lookup(s).count() == 1
    base = spark.createDataFrame([(1, A, 1.5)], "entity long, anchor_ts timestamp, baseline_value double")
    c = series.centred_series(points([(1, plus(12), "x", 1.0), (1, plus(12, 1), "x", 2.0), (1, plus(-12), "x", 3.0)]), base)
    assert sorted(r["value"] for r in c.collect()) == [1.0, 3.0] and c.first()["baseline_value"] == 1.5


def test_rules(spark):
    df = spark.createDataFrame([(1, 3, 0.69, 1.0), (2, 9, 0.7, 0.0), (3, 4, None, None)], "id long, cluster int, s double, hf double")
    out = rules.annotate(df, {"colour": "s"}, {3: "three", 4: "four"}, [rules.TextRule("hf", "failing", 1), rules.TextRule("gone", "-", 1)])
    got = {r["id"]: (r["colour"], r["cluster_advice"], r["hf_advice"]) for r in out.collect()}
    assert got == {1: ("#FF0000", "three", "failing"), 2: ("#000000", None, None), 3: (None, "four", None)}
    assert "gone_advice" not in out.columns


def test_fills_with_a_fraction_widen_integers(spark):
    df = spark.createDataFrame([(1, 60, 1), (2, 61, None), (3, None, 3)], "entity long, a int, b int")
    _, _, filled = mx.impute_matrix(df, ["a", "b"])
    assert [tuple(r) for r in filled.orderBy("entity").collect()] == [(1, 60.0, 1), (2, 61.0, 2), (3, 60.5, 3)]
    scored = mx.fill_from_constants(df, {"a": 88.18})
    assert [r.a for r in scored.orderBy("entity").collect()] == [60.0, 61.0, 88.18] and [r.b for r in scored.orderBy("entity").collect()] == [1, 0, 3]


@pytest.mark.parametrize("width", [2, 8, 9, 40])
def test_rows_without_a_key_survive_at_every_width(spark, width):
    rows = [(None, *[0] * (width - 1), 1), (1, *[0] * width), (2, *[None] * (width - 1), 3)]
    df = spark.createDataFrame(rows, "entity long, " + ", ".join(f"c{i} int" for i in range(width)))
    assert sorted((r.entity or 0) for r in mx.drop_empty_rows(df, []).collect()) == [0, 2]
