"""Edge values of the column expressions."""

import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F

from casegrid.functions import text as tx
from casegrid.functions import values as v


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x")).alias("y")).collect()]


def test_age_cut_is_right_closed(spark):
    got = one(spark, [0.0, 12.0, 12.5, 17.0, 18.0, 100.0, 101.0, None], v.age_cut, "double")
    assert got == [
        None, "Child (0-12)", "Teen (13-17)", "Teen (13-17)", "Young Adult (18-30)",
        "Senior (51+)", None, None,
    ]


def test_smart_age_group(spark):
    ages = ["13", "14.5", "17", "24.5", " Senior ", "teen", "na", "60", None, "adult older", "13d"]
    assert one(spark, ages, v.smart_age_group) == [
        "Young Teen", "Old", "Teen", "Old", "Old", "Teen", "Unknown", "Old", "Unknown", "Old",
        "Unknown",
    ]


def test_report_age_group(spark):
    ages = ["young adult", "teenager", "19", "60", "1.5", None, "12", "children"]
    assert one(spark, ages, v.report_age_group) == [
        "Adult", "Teen", "Teen", "Senior", "Unknown", "Unknown", "Child", "Child",
    ]


def test_dates(spark):
    texts = ["1/14/2020", "16/01/2022", "na", " 01/24/2020 ", "2021-05-06 07:08:09", None]
    assert one(spark, texts, v.parse_date) == [
        date(2020, 1, 14), None, None, date(2020, 1, 24), date(2021, 5, 6), None,
    ]
    assert one(spark, texts[:3], v.parse_date_robust) == [
        date(2020, 1, 14), date(2022, 1, 16), None,
    ]


def test_hours(spark):
    texts = ["12:48 PM", "12:13 AM", "1:07", "na", "11:59 pm", "23:10", None]
    assert one(spark, texts, v.parse_hour) == [12, 0, 1, None, 23, 23, None]


def test_numbers(spark):
    got = one(spark, ["12", " 3.5 ", "1e2", "12d", "abc", "", None, "-.5"], v.coerce_numeric)
    assert got == [12.0, 3.5, 100.0, None, None, None, None, -0.5]


def fold(text):
    """The folding rule on its own, from the Unicode database."""
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


@pytest.mark.parametrize("block", [0x80, 0x2000, 0xFB00, 0x1D400, 0x3300])
def test_ascii_fold_follows_unicode(spark, block):
    chars = [chr(c) for c in range(block, block + 0x300) if not 0xD800 <= c <= 0xDFFF]
    chars = [c for c in chars if unicodedata.category(c) != "Cn"]
    texts = ["a" + c + "b" for c in chars]
    assert one(spark, texts, tx.ascii_fold) == [fold(t) for t in texts]


def test_normalize_text(spark):
    texts = ["Sta. Cruz, Mla", "Brgy. 12", "Barangays 7", None, "  Ñuñoa\t№5 ", "costa mlab"]
    assert one(spark, texts, tx.normalize_text) == [
        "santa cruz manila", "barangay 12", "barangay 7", "", "nunoa no5", "costa mlab",
    ]


def test_case_rules(spark):
    assert one(spark, [" fEMALE ", " male", "", None], tx.capitalize_first) == [
        "Female", "Male", "", None,
    ]
    names = ["juan o'neil 3rd", " ANA-MARIA "]
    assert one(spark, names, tx.title_case) == [n.strip().title() for n in names]


def test_keyword_filter_excludes_first(spark):
    places = ["Tondo, Manila", "Pasay, Metro Manila", None, "", "Baguio"]
    assert one(spark, places, tx.keyword_match) == [True, False, False, False, False]


def test_city_words_are_ordered(spark):
    places = ["Quezon City, Metro Manila", "Las Pinas City", "NA", "Cebu", None, "Parañaque"]
    assert one(spark, places, tx.city_from_text) == [
        "Manila", "Las Piñas", "Unknown", "Other/Unknown", "Unknown", "Parañaque",
    ]


def test_tail_phrases(spark):
    places = ["12 Main St, Tondo, Manila", "Manila", " , ", None]
    assert one(spark, places, tx.tail_phrases) == [
        ["tondo manila", "manila"], ["manila", "manila"], [], [],
    ]


def test_labels(spark):
    assert one(spark, [0.0005, 0.005, 0.04, 0.5], v.significance, "double") == [
        "***", "**", "*", "",
    ]
    assert one(spark, [0, 10, 11, 12], v.cluster_color, "int") == [
        "red", "cadetblue", "red", "blue",
    ]
    assert one(spark, [12.345, None], v.percent_label, "double") == ["12.3%", None]
    assert one(spark, [0.5, 1.5, 2.5], lambda c: v.round_even(c, 0), "double") == [0.0, 2.0, 2.0]
