"""Place rules one by one on a small gazetteer, and the similarity kernel."""

import json
import random
from difflib import SequenceMatcher

import pandas as pd
import pytest

from casegrid.operators import gazetteer as gz
from casegrid.operators import places as pl
from casegrid.plans.cleaning import clean_extract
from casegrid.sources.readers import read_gazetteer

PLACES = [
    {
        "city": "Pasig City",
        "coordinates": {"latitude": 14.5, "longitude": 121.0},
        "districts": [{"name": "Kapitolyo Heights", "barangays": ["Bagong Ilog"]}],
    },
    {
        "city": "Manila",
        "districts": [
            {"name": "Tondo", "coordinates": {"latitude": 14.6, "longitude": 120.9},
             "barangay_list": [{"name": "Moriones Plaza"}]},
            {"name": "Malate", "coordinates": {"latitude": 14.55, "longitude": 120.99}},
            {"name": "San Rafael Village",
             "coordinates": {"latitude": 14.61, "longitude": 120.95}},
        ],
    },
]
CASES = {
    # text: (city, district, barangay, level, score)
    "Rizal Memorial Coliseum, Pasay": ("Manila City", "Malate", None, "barangay", 1.0),
    "12 X St., Tondo, Mla": ("Manila City", "Tondo", None, "district", 0.95),
    "Sampaloc, Rafael Village": ("Manila City", "San Rafael Village", None, "district", 0.9),
    "Manila, Moriones Plaza": ("Manila City", "Tondo", "Moriones Plaza", "barangay", 0.85),
    "corner store, Bagong Ilog": ("Pasig City", "Kapitolyo Heights", "Bagong Ilog", "barangay",
                                  1.0),
    "qqqq": None,
    "": None,
    None: None,
}


@pytest.fixture(scope="module")
def matched(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("gaz") / "places.json"
    path.write_text(json.dumps(PLACES))
    aliases = gz.alias_table(read_gazetteer(spark, str(path)))
    rows = [(i, t) for i, t in enumerate(CASES)] * 2  # repeated texts get the same answer
    df = spark.createDataFrame(rows, "i int, text string")
    return pl.match_places(df, "text", aliases).collect()


@pytest.mark.parametrize("text", [t for t, want in CASES.items() if want])
def test_rule(matched, text):
    rows = [r for r in matched if r.text == text]
    assert len(rows) == 2
    for r in rows:
        assert (r.city, r.district, r.barangay, r.level, r.score) == CASES[text]


def test_rows_without_a_place_stay(matched):
    rows = [r for r in matched if not r.text or r.text == "qqqq"]
    assert len(rows) == 6
    assert all(r.level == "none" and r.city == "Other/Unknown" and r.score is None for r in rows)


def test_home_hint_without_a_match_is_the_home_city(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("gaz") / "places.json"
    path.write_text(json.dumps([PLACES[0]]))  # no home city in the gazetteer
    aliases = gz.alias_table(read_gazetteer(spark, str(path)))
    df = spark.createDataFrame([("somewhere in Manila",)], "text string")
    r = pl.match_places(df, "text", aliases).first()
    assert (r.city, r.level, r.score, r.latitude) == ("Manila City", "city", 0.55, None)


def test_extract_plan_keeps_dated_rows_and_numbers_them(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("gaz") / "places.json"
    path.write_text(json.dumps(PLACES))
    aliases = gz.alias_table(read_gazetteer(spark, str(path)))
    rows = [
        (0, "1", "14.5", "  fEMALE", "1/14/2020", "12:48 PM", "na", "X St., Tondo, Mla"),
        (1, "2", "teen", "male", "16/01/2022", "1:07", None, "Tondo"),
        (2, "3", "na", None, "2/3/2021", "na", "1/2/2021", None),
    ]
    df = spark.createDataFrame(
        rows, "row_id long, case_id string, age string, gender string, reported_date string, "
              "reported_time string, last_seen_date string, location_text string",
    )
    got = {r.row_id: r for r in clean_extract(df, aliases).collect()}
    assert {k: r.person_id for k, r in got.items()} == {0: "MP-0001", 2: "MP-0002"}
    assert (got[0].gender, got[0].hour, got[0].year, got[0].age_group) == ("Female", 12, 2020, "Old")
    assert (got[0].city, got[0].district, got[0].score) == ("Manila City", "Tondo", 0.95)
    assert (got[2].level, got[2].city, got[2].reported_time) == ("none", "Other/Unknown", None)


def test_kernel_equals_the_full_comparison():
    rng = random.Random(11)

    def word(n):
        return "".join(rng.choice("abcdef ") for _ in range(n)).strip() or "a"

    aliases = pd.DataFrame(
        [(f"{i:04d}", rng.choice(["city", "district", "barangay"]), word(rng.randrange(2, 15)),
          rng.random() < 0.5) for i in range(80)],
        columns=["ordinal", "level", "alias", "home"],
    )
    texts = pd.DataFrame(
        [(word(rng.randrange(3, 40)), rng.random() < 0.5) for _ in range(60)],
        columns=["norm", "hint"],
    )
    got = pl.similarity_kernel(texts, aliases)
    have = {(r.norm, r.hint, r.level): (r.score, r.ordinal) for r in got.itertuples()}
    want = {}
    for t in texts.itertuples():
        for a in aliases.itertuples():
            if t.hint and not a.home:
                continue
            s = 1.0 if a.alias in t.norm else SequenceMatcher(None, a.alias, t.norm).ratio()
            key = (t.norm, t.hint, a.level)
            if s > want.get(key, (0.0, ""))[0]:
                want[key] = (s, a.ordinal)
    # below what a level accepts, a text without the hint need not be compared
    least = {"barangay": 0.7, "district": 0.4, "city": 0.4}

    def deciding(found):
        return {k: v for k, v in found.items() if k[1] or v[0] >= least[k[2]]}

    assert deciding(have) == deciding(want) and set(have) <= set(want)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    texts = spark.createDataFrame(
        [("tondo street", True), ("tonda stret", True), ("kapitolio", False)],
        "norm string, hint boolean",
    )
    aliases = spark.createDataFrame(
        [("1", "district", "tondo", True), ("2", "district", "kapitolyo heights", False),
         ("3", "city", "manila", True), ("4", "city", "pasig city", False)],
        "ordinal string, level string, alias string, home boolean",
    )
    whole = sorted(map(tuple, pl.best_similar(texts, aliases).collect()))
    monkeypatch.setattr(pl, "_TEXT_BLOCK", 1)
    monkeypatch.setattr(pl, "_ALIAS_BLOCK", 2)
    assert sorted(map(tuple, pl.best_similar(texts, aliases).collect())) == whole
