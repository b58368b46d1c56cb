"""The whole study on a small invented hospital."""

import datetime as dt
import random

import pytest
from conftest import as_dict

from anchorframe.operators.models import Boosting
from anchorframe.plans import clinical
from anchorframe.plans import vocabulary as voc
from anchorframe.plans.analysis import ClusterSettings

T0 = dt.datetime(2150, 3, 1, 8)
SMALL = ClusterSettings(neighbours=3, dense_share=0.95, min_component_rows=4, min_strength=0.05, min_cluster_rows=8, ks=(2,), starts=1, max_iter=10)
N = 60


def stamp(hours):
    return (T0 + dt.timedelta(hours=hours)).strftime("%Y-%m-%d %H:%M:%S")


def put(folder, name, header, rows):
    lines = [header] + [",".join("" if v is None else str(v) for v in r) for r in rows]
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    d, out = tmp_path_factory.mktemp("data"), tmp_path_factory.mktemp("out")
    rnd = random.Random(4)
    ids = range(1, N + 1)
    sick = [i for i in ids if i % 6 != 0]  # every sixth patient has no onset
    put(d, "sepsis_diagnose_time", "subject_id,stay_id,suspected_infection_time",
        [(i, 1000 + i, stamp(0)) for i in ids] + [(1, 1001, stamp(5)), (99, 1099, stamp(0))])
    creat = [(i, stamp(-48), 1.0) for i in ids] + [(i, stamp(-24), 1.1) for i in ids]
    creat += [(i, stamp(24), 1.45 if i in sick else 1.1) for i in ids] + [(i, stamp(20), 1.1) for i in ids]
    put(d, "creatinine_over_time", "subject_id,charttime,valuenum,extra", [(*r, "x") for r in creat] + [("bad", "bad", "bad", "x")])
    put(d, "creatinine", "subject_id,charttime,creatinine_mg_dl", creat)
    vit = []
    for i in ids:
        for h in (14, 18, 24):
            vit += [(1000 + i, stamp(h), "Heart Rate", 70 + i % 2 * 40 + rnd.random()), (1000 + i, stamp(h), "Oxygen Saturation", 96 + rnd.random())]
        vit.append((1000 + i, stamp(15), "Heart Rate", 900))
        vit.append((1000 + i, stamp(15), "Temperature", 37))
    for n in (1, 2, 3):
        put(d, f"vitals{n}", "stay_id,charttime,label,valuenum", vit[n - 1 :: 3])
    head = "subject_id,item_label,item_category,amount,rate,totalamount,starttime,endtime,amountuom"
    inp = []
    for i in ids:
        inp.append((i, "NaCl 0.9%", voc.FLUID_CATEGORY, 100 + i, 1, 500, stamp(20), stamp(21), "ml"))
        inp.append((i, "Furosemide (Lasix)", "Diuretics", 20 * (i % 2), 1, 20, stamp(10), stamp(13), "mg"))
        inp.append((i, "Vancomycin", "Antibiotics", 1, 1, 1, stamp(11), stamp(12), "dose"))
        inp.append((i, "norepinephrine", "Drugs", 2 + i % 3, 1, 2, stamp(13), stamp(30), "mg"))
        inp.append((i, "Cyclosporine", "Drugs", 1, 1, 7, stamp(0), stamp(13), "mg"))
    for n in (1, 2, 3):
        put(d, f"inputevents_sepsis{n}", head, inp[n - 1 :: 3])
    put(d, "procedureevents_sepsis", "subject_id, Item_Label ,starttime,stoptime",
        [(i, "invasive VENTILATION ", stamp(10), stamp(13)) for i in ids] + [(i, "Invasive Ventilation", stamp(12.5), stamp(14)) for i in ids]
        + [(1, "Intubation", stamp(20), stamp(21)), (2, "Intubation", stamp(20), None)])
    put(d, "ACE_ARB", "subject_id,drug,starttime,stoptime", [(i, "Lisinopril" if i % 2 else "Aspirin", stamp(13), stamp(20)) for i in ids])
    put(d, "DIU", "subject_id,drug,stoptime", [(i, " FUROSEMIDE", stamp(20)) for i in ids if i % 2])
    put(d, "VASO", " Subject_ID ,Stay_ID", [(i, 1000 + i) for i in ids])
    put(d, "vasopressors", "stay_id,label,amount,starttime,endtime", [(1000 + i, "dopamine", 10, stamp(8), stamp(16)) for i in ids])
    put(d, "sepsis_preex_conditions", "subject_id,condition", [(i, "Heart Failure") for i in ids if i % 3] + [(i, "Hypertension") for i in ids if i % 4])
    put(d, "sepsis3_los_dod", "subject_id,stay_id,intime,outtime,dod",
        [(i, 1000 + i, stamp(13), stamp(13 + 24 * (i % 5)), (T0 + dt.timedelta(days=30)).date() if i % 3 == 0 else None) for i in ids])
    put(d, "age", "subject_id,admittime,age", [(i, stamp(0), 50 + i % 30) for i in ids] + [(i, stamp(-9000), 20) for i in ids])
    put(d, "gender", "subject_id,gender", [(i, "MF"[i % 2]) for i in ids])
    return clinical.run_study(spark, str(d), str(out), SMALL), str(out), sick, str(d)


def test_onsets(study):
    result, _, sick, _ = study
    got = as_dict(result.onsets)
    assert set(got) == set(range(1, N + 1))
    assert {k for k, v in got.items() if v["onset_flag"]} == set(sick)
    one = got[1]
    assert one["baseline_value"] == 1.0 and one["baseline_rule"] == "pre_7d_min" and one["peak_value"] == 1.45
    assert one["onset_ts"] == T0 + dt.timedelta(hours=24) and one["days_to_onset"] == 1.0 and one["status"] == "AKI"
    assert one["rise_flag"] and not one["ratio_flag"]


def test_matrix(study):
    result, _, sick, _ = study
    got = as_dict(result.matrix)
    assert set(got) == set(sick)
    one = got[1]
    assert one["gender"] == 1.0 and one["age_12h_before_AKI"] == 51.0
    assert 110 < one["Heart Rate"] < 111  # the impossible 900 is out
    assert "Temperature" not in one
    assert one["NaCl 0.9%"] == 101.0 and one["Furosemide (Lasix)"] == 20.0 and one["Furosemide"] == 1.0
    assert one["Lisinopril"] == 1.0 and one["Captopril"] == 0.0
    assert one["vaso_Dopamine"] == 5.0  # half of the infusion lies in the window
    assert one["Vancomycin"] == 1.0 and one["Meropenem"] == 0.0  # ends exactly at the window's start
    assert one["Cyclosporine"] == 7.0
    assert one["Norepinephrine"] == 3.0 and one["Invasive ventilation"] == 120.0
    assert one["Intubation"] == 1.0 and got[2]["Intubation"] == 0.0
    assert one["Heart Failure"] == 1.0 and got[3]["Heart Failure"] == 0.0
    assert one[voc.OUTCOME_COLUMN] == 0.0 and got[3][voc.OUTCOME_COLUMN] == 1.0
    assert one[voc.STAY_COLUMN] == 1.0 and got[4][voc.STAY_COLUMN] == 4.0


def test_dashboard_tables(spark, study):
    _, out, sick, _ = study
    read = lambda n: spark.read.option("header", True).csv(f"{out}/dashboard/{n}")
    marker = read("creatinine_filtered")
    assert marker.columns == ["subject_id", "ts", "value", "baseline_value", "anchor_ts"]
    assert marker.count() == 2 * len(sick) and marker.filter("value = '1,45'").count() == len(sick)
    rate = read("vitals_chronological").filter("subject_id = 1").collect()
    assert [r["hours_before"] for r in rate] == ["10,0", "6,0", "0,0"]
    assert read("subject_ids").count() == len(sick)
    assert read("conditions_per_subject").filter("subject_id = 1").count() == 2
    amounts = read("medication_amounts").filter("subject_id = 1").collect()
    assert {r["item"] for r in amounts} == set()  # every dose of patient 1 started before the window
    flags = read("medication_flags").filter("subject_id = 1").collect()
    assert {r["item"] for r in flags} == {"Lisinopril"}
    board = read("df_dashboard")
    assert "Heart Failure_advice" in board.columns and board.count() > 0


def test_clusters_models_and_scoring(spark, study):
    result, out, _, _ = study
    a = result.clusters
    assert len(a.bundle.valid) >= 2
    means, tests, pairs = clinical.compare_study_clusters(a)
    assert means.count() == len(a.bundle.valid) and "Oxygen Saturation" in means.columns
    assert set(tests.columns) >= {"feature", "H", "p", "p_fdr", "consider"} and pairs.count() > 0
    patient = result.matrix.filter("entity = 1").withColumn("entity", result.matrix.entity + 5000)
    scored, board = clinical.score_patients(patient, a)
    assert scored.first()["cluster"] in a.bundle.valid
    assert board.count() == a.core.count() + 1
    core = a.core.withColumn("Diabetes Mellitus", (a.core.entity % 2).cast("double"))
    from anchorframe.operators.models import boosted_regressor

    r = boosted_regressor(core, ["Heart Rate", "Furosemide"], voc.STAY_COLUMN, "entity", Boosting(rounds=2, depth=2), folds=2)
    assert set(r.scores) == {"mae", "r2"}


def test_each_file_is_parsed_once(spark, study, tmp_path, monkeypatch):
    result, out, _, data = study
    seen = []
    read = clinical.read_csv_table
    monkeypatch.setattr(clinical, "read_csv_table", lambda spark, paths, types: seen.extend(paths) or read(spark, paths, types))
    t = clinical.StudyTables(spark, data, str(tmp_path))
    matrix = clinical.build_matrix(t, result.onsets)
    clinical.medication_log(t, result.onsets)
    clinical.heart_rate_series(t, result.onsets)
    assert len(seen) == len(set(seen)) > 10
    assert ".csv" not in matrix._jdf.queryExecution().sparkPlan().toString()
    plain = clinical.build_matrix(clinical.StudyTables(spark, data), result.onsets)
    assert {tuple(r) for r in matrix.select(*[f"`{c}`" for c in plain.columns]).collect()} == {tuple(r) for r in plain.collect()}
