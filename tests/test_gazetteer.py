"""Range texts, nested flattening and exact containment."""

import json
import random

import pytest
from pyspark.sql import functions as F

from casegrid.operators import gazetteer as gz
from casegrid.sources.readers import read_gazetteer

PLACES = [
    {
        "city": "Alpha City",
        "coordinates": {"latitude": 1.0, "longitude": 2.0},
        "districts": [
            {
                "name": "North",
                "coordinates": {"latitude": 3.0, "longitude": 4.0},
                "barangays": ["Barangays 1-3", "Brgy. 2", "Old Mill", ""],
            },
            {"name": "South", "barangay_range": "1 to 9", "barangays": []},
        ],
    },
    {
        "city": "Manila",
        "districts": [
            {
                "name": "Tondo",
                "coordinates": {"latitude": 5.0, "longitude": 6.0},
                "barangay_list": [
                    {"name": "Barangays 688-744",
                     "coordinates": {"latitude": 7.0, "longitude": 8.0}},
                    {"name": "Pier"},
                ],
            }
        ],
    },
]


@pytest.fixture(scope="module")
def gaz(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("gaz") / "places.json"
    path.write_text(json.dumps(PLACES))
    return read_gazetteer(spark, str(path))


@pytest.mark.parametrize(
    "text,names",
    [
        ("Barangays 1-3", ["Barangay 1", "Barangay 2", "Barangay 3"]),
        ("Barangays 662 & 664-a", ["Barangay 662", "Barangay 664-A"]),
        ("Brgys. 1 to 2, 7 and 9",
         ["Barangay 1", "Barangay 2", "Barangay 7", "Barangay 9"]),
        ("Barangays 5-4", ["Barangays 5-4"]),
        ("San Roque and 12", ["Barangay 12"]),
        ("Old Mill", ["Old Mill"]),
        ("  ", []),
    ],
)
def test_expand_ranges(spark, text, names):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(gz.expand_ranges("t")).first()[0] == names


def test_flatten(gaz):
    rows = gz.flatten_districts(gaz).orderBy("city_pos", "district_pos").collect()
    assert [(r.city, r.district) for r in rows] == [
        ("Alpha City", "North"), ("Alpha City", "South"), ("Manila", "Tondo"),
    ]
    assert rows[1].coordinates.latitude == 1.0  # the city's position stands in
    coords = gz.district_coordinates(gaz, "Manila").collect()
    assert [tuple(r) for r in coords] == [("Tondo", 5.0, 6.0)]


def test_units_expand_texts_but_not_objects(gaz):
    rows = gz.flatten_units(gaz).orderBy("city_pos", "district_pos", "unit_pos").collect()
    assert [(r.barangay, r.latitude) for r in rows] == [
        ("Barangay 1", 3.0), ("Barangay 2", 3.0), ("Barangay 3", 3.0), ("Old Mill", 3.0),
        ("Barangays 688-744", 7.0), ("Pier", 5.0),
    ]


def test_alias_order_and_forms(gaz):
    rows = gz.place_entries(gaz).orderBy("ordinal").collect()
    assert [r.level for r in rows] == ["barangay"] * 6 + ["district"] * 3 + ["city"] * 2
    alias = {(r.level, r.barangay or r.district or r.city): r.aliases for r in rows}
    assert alias["district", "South"] == [
        "south", "south alpha city", "alpha city south", "1 to 9",
    ]
    assert set(alias["barangay", "Barangay 1"]) == {
        "barangay 1", "barangay 1 north", "barangay 1 alpha city", "1", "1 north",
        "1 alpha city",
    }
    assert rows[-1].latitude is None  # a city without position keeps NULL


def test_containment_equals_a_direct_search(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    texts = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 12)))) for i in range(150)]
    aliases = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 3))) for _ in range(40)}
                     | {w[:2] for w in words})
    t = spark.createDataFrame(texts, "i int, text string")
    a = spark.createDataFrame([(x,) for x in aliases], "alias string")
    want = {(i, x) for i, text in texts for x in aliases if x in text}
    for merge in (False, True):
        got = gz.contained_aliases(t, "i", "text", a, merge=merge)
        rows = [(r.i, r.alias) for r in got.select("i", "alias").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    empty = gz.contained_aliases(t, "i", "text", a.filter(F.lit(False)))
    assert empty.count() == 0


def test_a_piece_that_most_aliases_share_is_the_key_of_few(spark):
    names = [(f"barangay {n} tondo{n % 9}",) for n in range(400)] + [("barangay",)]
    keyed = gz._rarest_pieces(spark.createDataFrame(names, "alias string"))
    assert keyed.filter("_gram = 'bara'").count() <= 1
    assert keyed.groupBy("_gram").count().agg({"count": "max"}).first()[0] <= 60


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize("merge", [False, True])
def test_containment_reads_each_text_once_and_keeps_rows_of_any_id(spark, many, merge):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    texts = [(1, "an old ring road"), (1, "goldring 77"), (None, "oldring"), (2, "s tring"), (3, "")]
    names = ["old", "ring", "old ring", "tring", "absent"] + [f"{n}x{n}" for n in range(100) if many]
    want = sorted((str(i), x) for i, text in texts for x in names if x in text)
    t = spark.createDataFrame(texts, "i int, text string").mapInPandas(counted, "i int, text string")
    a = spark.createDataFrame([(x,) for x in names], "alias string")
    assert (gz._rarest_pieces(a).select("_gram").distinct().count() > gz.FEW_PIECES) == many
    got = gz.contained_aliases(t, "i", "text", a, merge=merge).select("i", "alias").collect()
    assert sorted((str(r.i), r.alias) for r in got) == want
    assert read.value == len(texts)


@pytest.mark.parametrize("first", [False, True])
def test_what_grows_with_the_texts_is_not_broadcast(spark, first):
    """A written text is a few bytes, as in a file of many equal ones; its row is not."""
    t = spark.range(300).selectExpr("id", "concat('unit ', id, ' old town') as text")
    a = spark.range(100).selectExpr("concat('', id) as alias", "id as ordinal")
    found = gz.first_contained_alias if first else gz.contained_aliases
    got = found(t, "id", "text", a)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_row" not in plan  # the texts
    assert "explode(sequence(0" not in plan  # a copy of every word or alias for each part
    hits = {(i, n) for i in range(300) for n in range(100) if str(n) in str(i)}
    rows = [(r.id, int(r.alias)) for r in got.collect()]
    assert set(rows) == ({(i, min(n for j, n in hits if j == i)) for i in range(300)} if first else hits)
    assert len(rows) == len(set(rows))
