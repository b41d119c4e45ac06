"""Ranks, first rows and codes, with one key that holds a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from casegrid.operators import ordering as od
from casegrid.operators import summaries as sm


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = [(i, "hot" if rng.random() < 0.34 else f"k{rng.randrange(200)}", rng.randrange(9))
            for i in range(3000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "row_id long, key string, v int").repartition(6)


def test_global_row_number(skewed):
    rows, df = skewed
    got = od.with_global_row_number(df, ["key", "row_id"]).select("row_id", "rn").collect()
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert {r.row_id: r.rn for r in got} == want


def test_surrogate_ids_follow_row_order(skewed):
    _, df = skewed
    got = od.surrogate_id(df, ["row_id"]).orderBy("row_id").select("person_id").limit(3).collect()
    assert [r[0] for r in got] == ["MP-0001", "MP-0002", "MP-0003"]


def test_dedup_keeps_first_row(skewed):
    rows, df = skewed
    got = {r.key: r.row_id for r in od.dedup_first(df, ["key"], "row_id").collect()}
    want = {}
    for i, k, _ in sorted(rows):
        want.setdefault(k, i)
    assert got == want


def test_dedup_null_keys(spark):
    df = spark.createDataFrame(
        [(0, "a"), (1, None), (2, "a"), (3, None)], "row_id int, key string"
    )
    assert sorted(r[0] for r in od.dedup_first(df, ["key"], "row_id").collect()) == [0, 1]
    kept = od.dedup_first(df, ["key"], "row_id", null_key="distinct")
    assert sorted(r[0] for r in kept.collect()) == [0, 1, 3]
    with pytest.raises(ValueError):
        od.dedup_first(df, ["key"], "row_id", null_key="other")


def test_top_values_tie_by_value(spark):
    df = spark.createDataFrame([(x,) for x in "bbaac"] + [(None,)], "x string")
    assert [tuple(r) for r in od.top_values(df, "x", 2).collect()] == [("a", 2), ("b", 2)]
    rest = od.top_values_with_rest(df, "x", 2).collect()
    assert [r.remaining for r in rest] == [1, 1]


def test_label_codes_start_at_zero_per_column(spark):
    df = spark.createDataFrame([("b", "y"), (None, "x"), ("a", "x")], "p string, q string")
    got = {(r.field, r.label): r.code for r in od.label_codes(df, ["p", "q"]).collect()}
    assert got == {("p", "Unknown"): 0, ("p", "a"): 1, ("p", "b"): 2, ("q", "x"): 0, ("q", "y"): 1}


def test_lag_uses_the_last_observed_year(spark):
    df = spark.createDataFrame(
        [("a", 2020, 3), ("a", 2022, 5), ("b", 2021, 1)], "district string, year int, case_count int"
    )
    got = sm.lag_previous(df).collect()
    assert [(r.district, r.year, r.prev_count) for r in got] == [("a", 2022, 3)]
    cal = {(r.district, r.year): r.prev_count for r in sm.lag_previous(df, calendar=True).collect()}
    assert cal == {("a", 2020): 0, ("a", 2022): 0, ("b", 2021): 0}


def test_mode_and_top_per_group(skewed):
    rows, df = skewed
    got = {r.key: (r.value, r.n) for r in od.mode_per_group(df, "key", "v").collect()}
    counts = {}
    for _, k, x in rows:
        counts.setdefault(k, {}).setdefault(x, 0)
        counts[k][x] += 1
    want = {k: min(c.items(), key=lambda t: (-t[1], t[0])) for k, c in counts.items()}
    assert got == want
    top = od.top_n_per_group(df, "key", "v", 2).filter(F.col("rank") == 1)
    assert {r.key: (r.v, r.n) for r in top.collect()} == want
