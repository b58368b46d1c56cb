import pytest

from anchorframe.sources import readers as rd
from anchorframe.sources import sinks


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_shards_names_and_types(spark, tmp_path):
    types = {"subject_id": "id", "charttime": "timestamp", "valuenum": "double", "day": "date"}
    a = write(tmp_path / "a.csv", " Subject_ID ,charttime,valuenum,note\n1,2024-01-01 10:00:00,1.5,n\n2.0,bad,x,\n,2024-01-01,  ,\n")
    b = write(tmp_path / "b.csv", "subject_id,valuenum,charttime,day\n3,NaN,2024-01-02,2024-02-03\n")
    df = rd.read_csv_table(spark, [a, b], types)
    assert df.columns == ["subject_id", "charttime", "valuenum", "note", "day"]
    got = {r["entity"]: (r["ts"], r["value"]) for r in rd.as_points(df, "subject_id", "charttime", "valuenum").collect()}
    assert set(got) == {1, 2, 3}  # the row without an id is gone
    assert got[1][1] == 1.5 and got[1][0] is not None and got[2] == (None, None) and got[3][1] is None
    assert df.filter("subject_id = 3").first()["day"] is not None
    assert df.filter("subject_id = 2").first()["note"] is None
    with pytest.raises(Exception):
        rd.read_csv_table(spark, a, types, strict=True).collect()
    assert rd.normalise_names(spark.createDataFrame([(1,)], [" A b "])).columns == ["a b"]


def test_load_by_suffix(spark, tmp_path):
    p = write(tmp_path / "a.csv", "entity,x\n1,2\n5,6\n")
    assert rd.load(spark, p).count() == 2
    cohort = spark.createDataFrame([(5,), (5,)], "entity long")
    assert [r["x"] for r in rd.load_for_cohort(spark, p, cohort).collect()] == ["6"]
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert rd.load(spark, str(tmp_path / "t.parquet")).count() == 3
    with pytest.raises(ValueError):
        rd.load(spark, "x.json")


def test_end_column_fallback_and_required_columns(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "stoptime string")
    assert rd.with_end_column(df).first()["end_ts"] is not None
    assert rd.with_end_column(spark.range(1)).first()["end_ts"] is None
    with pytest.raises(KeyError):
        rd.require_columns(df, ["item_label"])
    assert rd.column_position(df, "stoptime") == 0
    with pytest.raises(ValueError):
        rd.column_position(df, "nope")


def test_decimal_comma(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "a.b", None)], "i int, x double, s string, n double")
    assert tuple(sinks.with_decimal_commas(df).first()) == (1, "2,5", "a.b", None)
    sinks.write_csv(df, str(tmp_path / "o"), comma=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).first()["x"] == "2,5"


def test_quoted_blanks_line_breaks_and_corrupt_records(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('id,name,v\n1,"",1.5\n2,"   ",x\n3,plain,2.5\n4,"two\nlines",3.5\n5,too,1,2,3\n')
    types = {"id": "id", "v": "double"}
    df = rd.read_csv_table(spark, str(p), types, multiline=True, corrupt="bad")
    got = {r.id: r for r in df.collect()}
    assert got[1].name is None and got[2].name is None and got[3].name == "plain" and got[4].name == "two\nlines"
    assert {i for i, r in got.items() if r.bad is not None} == {2, 5} and got[2].v is None and got[1].bad is None


def test_positions_and_indexed_csv(spark, tmp_path):
    rows = [(i, (i * 7) % 50, None if i % 11 == 0 else "x") for i in range(700)]
    df = spark.createDataFrame(rows, "id long, v long, s string").repartition(5)
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or "", r[1], r[0]))
    got = {r.id: r["index"] for r in sinks.with_position(df, ["s", "v", "id"], partitions=9).collect()}
    assert got == {r[0]: i for i, r in enumerate(order)}
    assert sinks.with_position(df.limit(0), ["v"]).count() == 0
    sinks.write_csv(df, str(tmp_path / "o"), index_by=["id"])
    back = spark.read.schema("place long, id long, v long, s string").option("header", True).csv(str(tmp_path / "o"))
    assert {(r.place, r.id) for r in back.collect()} == {(i, i) for i in range(700)}
    head = next(p for p in (tmp_path / "o").iterdir() if p.suffix == ".csv" and p.stat().st_size).read_text().splitlines()[0]
    assert head.split(",")[1:] == ["id", "v", "s"]
