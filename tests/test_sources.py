"""Scans, sinks, validation and the stream."""

from datetime import date

import pytest

from casegrid.operators import layers as ly
from casegrid.operators import quality as q
from casegrid.plans.cleaning import clean_cases, cleaning_report
from casegrid.plans.study import hotspot_study
from casegrid.sources import readers, schemas, writers
from casegrid.streaming.cleaning import read_case_stream, write_clean_stream

HEADER = ",".join(schemas.RAW_CASE_COLUMNS)
ROWS = [
    'P1,Male,34,2020-01-05 10:00:00,10:00,"Main St, Tondo",14.6,120.9,Tondo,http://x/1',
    'P2,NA,,2021-02-03 00:00:00,,"say ""hi""",14.5,121.0,N/A,http://x/2',
    "P1,Female,20,2020-01-06 00:00:00,09:00,dup,14.6,120.9,Paco,http://x/3",
    "P3,na,40,2022-07-08 00:00:00,08:00,far away,10.0,120.9,Ermita,null",
    "P4,Male,50,bad date,08:00,x,14.6,120.9,Ermita,u",
]


@pytest.fixture()
def case_file(tmp_path):
    path = tmp_path / "cases.csv"
    path.write_text("\n".join([HEADER, *ROWS]) + "\n", encoding="utf-8")
    return str(path)


def test_missing_tokens_and_quotes(spark, case_file):
    rows = readers.read_cases(spark, case_file).orderBy("row_id").collect()
    assert [r.gender for r in rows] == ["Male", None, "Female", "na", "Male"]
    assert (rows[1].age, rows[1].district, rows[3].post_url) == (None, None, None)
    assert rows[0].location_text == "Main St, Tondo" and rows[1].location_text == 'say "hi"'


def test_missing_path(spark, tmp_path):
    with pytest.raises(readers.MissingInput):
        readers.read_cases(spark, str(tmp_path / "nothing.csv"))


def test_validation_report(spark, case_file):
    _, report = readers.load_and_validate(spark, case_file)
    rows = {r.check: (r.ok, r.detail) for r in report.collect()}
    assert rows == {"schema": (True, None), "coordinates": (False, "1 outside bounds")}


def test_extract_columns_take_canonical_names(spark):
    df = spark.createDataFrame([("1", "x")], "AGE string, `Longtitude` string")
    out = readers.canonical(df, required=["district"])
    assert out.columns == ["age", "longitude", "district"]
    assert q.missing_columns(out, ["age", "gender"]) == ["gender"]


def test_cleaning_plan(spark, case_file):
    raw = readers.read_cases(spark, case_file)
    rows = {r.case_id: r for r in clean_cases(raw).collect()}
    assert set(rows) == {"P1", "P2", "P3", "P4"}
    assert rows["P1"].location_text == "Main St, Tondo"  # the first of the two
    assert rows["P2"].age == 40.0  # median of 34, 40, 50
    assert (rows["P2"].gender, rows["P2"].reported_time) == ("Unknown", "00:00")
    assert rows["P1"].reported_date == date(2020, 1, 5) and rows["P4"].reported_date is None
    assert [rows[k].gender_code for k in ("P1", "P2", "P3")] == [0, 1, 2]
    report = cleaning_report(raw).first()
    assert (report.initial_rows, report.duplicates_removed, report.final_rows) == (5, 1, 4)
    assert (report.filled_age, report.filled_gender) == (1, 1)


def test_strategies(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert q.handle_missing(df, "drop").count() == 1
    assert q.handle_missing(df, "fill").count() == 2
    with pytest.raises(ValueError):
        q.handle_missing(df, "guess")


def test_missing_coordinates_are_not_out_of_bounds(spark):
    df = spark.createDataFrame(
        [(14.5, 121.0), (None, 200.0), (None, None), (16.0, None)],
        "latitude double, longitude double",
    )
    r = q.coordinate_check(df).first()
    assert (r.total, r.invalid, r.valid) == (4, 2, False)


def test_csv_roundtrip_keeps_spaces_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'b "c", d'), (None, "e")], "x string, y string")
    writers.write_csv(df, str(tmp_path / "out"), ["y", "x"])
    back = readers.read_csv(spark, str(tmp_path / "out"), "y string, x string")
    assert sorted(map(tuple, back.collect())) == [('b "c", d', " a "), ("e", None)]


def test_json_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "n int, score double")
    writers.write_json(df, str(tmp_path / "out"))
    assert spark.read.schema("n int, score double").json(str(tmp_path / "out")).first().n == 1
    doc = writers.metric_document(df, a=["n"], b=["score"]).first()[0]
    assert doc == '{"a":{"n":1},"b":{"score":0.5}}'


def test_empty_input_is_refused_for_maps(spark):
    with pytest.raises(ValueError):
        ly.require_rows(spark.createDataFrame([], "a int"))


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = ",".join(schemas.EXTRACT_COLUMNS)
    (folder / "a.csv").write_text(
        head + "\n,14.5, male,1/14/2020,12:48 PM,na,Tondo,,,u\n,teen,FEMALE,2/3/2021,na,,X,,,u\n"
    )
    stream = read_case_stream(spark, str(folder))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    write_clean_stream(stream, out, ckpt).awaitTermination(120)
    (folder / "b.csv").write_text(head + "\n,30,Male,3/4/2021,1:07,1/1/2021,Y,,,u\n")
    write_clean_stream(read_case_stream(spark, str(folder)), out, ckpt).awaitTermination(120)
    rows = {r.location_text: r for r in spark.read.parquet(out).collect()}
    assert len(rows) == 3
    assert (rows["Tondo"].gender, rows["Tondo"].hour, rows["Tondo"].age_group) == ("Male", 12, "Old")
    assert rows["X"].reported_time is None and rows["X"].age_group == "Teen"
    assert rows["Y"].last_seen_date == date(2021, 1, 1) and rows["Y"].year == 2021


def test_whole_study(spark):
    rows = []
    for i in range(240):
        d = i % 4
        year = 2019 + (i // 4) % 5
        rows.append((
            i, f"P{i}", "Male" if i % 3 else None, str(10 + i % 60), f"{1 + i % 12}/3/{year}",
            "10:00", f"place {d}", str(14.1 + d / 10 + (i % 7) / 1000), str(120.7 + d / 10),
            f"D{d}", "u",
        ))
    raw = spark.createDataFrame(rows, "row_id long, " + ", ".join(
        f"{c} string" for c in schemas.CANONICAL_REQUIRED[:1]
        + ("gender", "age", "reported_date", "reported_time", "location_text", "latitude",
           "longitude", "district", "post_url")
    ))
    out = hotspot_study(raw, (2, 5), n_init=2)
    assert out["bounds"].first().valid
    assert out["k_search"].count() == 4
    # four far places: every cluster holds whole places
    assert sum(r.size for r in out["clusters"].collect()) == 240
    assert {r.district for r in out["forecast"].collect()} == {"D0", "D1", "D2", "D3"}
    kinds = [r.kind for r in out["forecast_layer"].collect()]
    assert (kinds.count("point"), kinds.count("center"), kinds.count("marker")) == (4, 1, 4)
    for name in ("summary", "cleaning", "markers", "target_groups", "trends", "charts"):
        assert out[name].count() > 0


def test_row_ids_follow_the_files_by_name(spark, tmp_path):
    for name, rows in (("a", 1), ("b", 50), ("c", 3)):
        lines = [f"{name}{i},30,Male,2020-01-01 00:00:00" for i in range(rows)]
        (tmp_path / f"{name}.csv").write_text("id,age,gender,reported_date\n" + "\n".join(lines) + "\n")
    schema = "id string, age double, gender string, reported_date string"
    from casegrid.sources.readers import read_cases

    got = read_cases(spark, str(tmp_path), schema).orderBy("row_id").select("id").collect()
    assert [r[0] for r in got] == ["a0", *(f"b{i}" for i in range(50)), "c0", "c1", "c2"]


def test_row_ids_follow_files_and_lines(spark, tmp_path):
    """One read and no shuffle; ids grow with the path and the line, over many blocks."""
    for name, n in (("b file", 3000), ("a", 20), ("c", 1)):
        (tmp_path / "in" / name).mkdir(parents=True)
        lines = "\n".join(f"{name}-{i},{'x' * 50}" for i in range(n))
        (tmp_path / "in" / name / "part.csv").write_text(f"Person ID,Gender\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df = readers.read_cases(spark, f"{tmp_path}/in/*", "`Person ID` string, Gender string")
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = df.select("row_id", "case_id").collect()
        assert df.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert "hashpartitioning" not in plan and plan.count("FileScan csv") == 1
    assert len({r.row_id for r in rows}) == 3021
    order = [r.case_id for r in sorted(rows, key=lambda r: r.row_id)]
    assert order == [f"{name}-{i}" for name, n in (("a", 20), ("b file", 3000), ("c", 1)) for i in range(n)]
