"""Filters, null handling and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import values as v
from ..operators import forecast as fc
from ..operators import layers
from ..operators import quality as q
from ..operators.ordering import position_code
from . import bindings as b
from .registry import query, rounded

# --- filters -------------------------------------------------------------------------


@query("coord_bounds_count", "WITH " + b.GAPPY + """
SELECT count(*) AS total, count(*) FILTER (latitude < 14 OR latitude > 15 OR
       longitude < 120.5 OR longitude > 121.5) AS invalid,
       count(*) FILTER (latitude < 14 OR latitude > 15 OR
       longitude < 120.5 OR longitude > 121.5) = 0 AS valid FROM gappy""")
def coord_bounds_count(spark, sf):
    return q.coordinate_check(b.gappy(spark, sf))


@query("dropna_any", "WITH " + b.GAPPY + """
SELECT * FROM gappy WHERE case_id IS NOT NULL AND age IS NOT NULL AND gender IS NOT NULL
  AND reported_date IS NOT NULL AND reported_time IS NOT NULL AND latitude IS NOT NULL
  AND longitude IS NOT NULL AND district IS NOT NULL AND location_text IS NOT NULL""")
def dropna_any(spark, sf):
    return q.handle_missing(b.gappy(spark, sf), "drop")


@query("missing_untouched", "WITH " + b.GAPPY + """
SELECT * FROM gappy""")
def missing_untouched(spark, sf):
    """The strategy that is accepted and does nothing."""
    return q.handle_missing(b.gappy(spark, sf), "fill")


@query("dropna_subset", "WITH " + b.GAPPY + """
SELECT * FROM gappy WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND reported_date IS NOT NULL""")
def dropna_subset(spark, sf):
    return q.drop_missing(b.gappy(spark, sf), ["latitude", "longitude", "reported_date"])


@query("smart_fill", "WITH " + b.GAPPY + """, kept AS (
  SELECT * FROM gappy WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    AND reported_date IS NOT NULL)
SELECT row_id, case_id, coalesce(age, (SELECT median(age) FROM kept)) AS age,
  coalesce(gender, 'Unknown') AS gender, reported_date,
  coalesce(reported_time, '00:00') AS reported_time, latitude, longitude,
  coalesce(district, 'Unknown') AS district, location_text FROM kept""")
def smart_fill(spark, sf):
    return q.handle_missing(b.gappy(spark, sf), "smart")


@query("filter_year", "WITH " + b.CASES + """
SELECT row_id, year, CASE WHEN year = 1998 THEN 'at' WHEN year < 1998 THEN 'before'
  ELSE 'after' END AS side FROM cases WHERE year BETWEEN 1996 AND 1999""")
def filter_year(spark, sf):
    year = F.col("year")
    return b.cases(spark, sf).filter((year >= 1996) & (year <= 1999)).select(
        "row_id", "year",
        F.when(year == 1998, "at").when(year < 1998, "before").otherwise("after").alias("side"),
    )


@query("filter_known_city", "WITH " + b.DIRTY + """
SELECT row_id, district FROM dirty WHERE district IS NOT NULL AND district <> 'NATION_3'""")
def filter_known_city(spark, sf):
    d = F.col("district")
    return b.dirty(spark, sf).filter(d.isNotNull() & (d != "NATION_3")).select(
        "row_id", "district"
    )


@query("missing_coord_counts", "WITH " + b.GAPPY + """
SELECT count(*) FILTER (latitude IS NULL) AS missing_lat,
  count(*) FILTER (longitude IS NULL) AS missing_lon,
  count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS missing_either,
  count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS complete FROM gappy""")
def missing_coord_counts(spark, sf):
    return q.missing_coordinate_counts(b.gappy(spark, sf))


_INCLUDE, _EXCLUDE = ("the", "ción", "ü"), ("qc", "thand", "rizal", "ñas")


@query("keyword_filter", """
SELECT doc_id, (contains(lower(text), 'the') OR contains(lower(text), 'ción')
    OR contains(lower(text), 'ü'))
  AND NOT (contains(lower(text), 'qc') OR contains(lower(text), 'thand')
    OR contains(lower(text), 'rizal') OR contains(lower(text), 'ñas')) AS kept
FROM documents""")
def keyword_filter(spark, sf):
    match = tx.keyword_match("text", include=_INCLUDE, exclude=_EXCLUDE)
    return b.documents(spark, sf).select("doc_id", match.alias("kept"))


@query("filter_report", """
WITH k AS (SELECT coalesce(contains(lower(location_text), 'asia')
    OR contains(lower(location_text), 'nation_1'), false) AND NOT
    coalesce(contains(lower(location_text), 'street'), false) AS kept FROM place_texts)
SELECT count(*) AS original, count(*) FILTER (NOT kept) AS removed,
       count(*) FILTER (kept) AS remaining FROM k""".replace(
    "WITH k", "WITH " + b.PLACE_TEXTS + ", k"))
def filter_report(spark, sf):
    return q.keyword_filter_report(
        b.place_texts(spark, sf), "location_text", include=("asia", "nation_1"),
        exclude=("street",),
    )


@query("na_to_null", "WITH " + b.DIRTY + """
SELECT row_id, CASE WHEN reported_time <> 'na' THEN reported_time END AS reported_time,
  CASE WHEN lower(trim(gender)) <> 'na' THEN gender END AS gender FROM dirty""")
def na_to_null(spark, sf):
    return b.dirty(spark, sf).select(
        "row_id", tx.na_to_null("reported_time").alias("reported_time"),
        tx.na_to_null("gender", ignore_case=True).alias("gender"),
    )


@query("coerce_numeric", "WITH " + b.DIRTY + """
SELECT row_id, TRY_CAST(age AS DOUBLE) AS age, TRY_CAST(latitude AS DOUBLE) AS latitude
FROM dirty""")
def coerce_numeric(spark, sf):
    return b.dirty(spark, sf).select(
        "row_id", v.coerce_numeric("age").alias("age"),
        v.coerce_numeric("latitude").alias("latitude"),
    )


@query("standardize_coords", "WITH " + b.DIRTY + """
SELECT row_id, TRY_CAST(latitude AS DOUBLE) AS latitude,
  TRY_CAST(longitude AS DOUBLE) AS longitude,
  (SELECT count(*) FROM dirty) - (SELECT count(*) FROM dirty
     WHERE TRY_CAST(latitude AS DOUBLE) IS NOT NULL
       AND TRY_CAST(longitude AS DOUBLE) IS NOT NULL) AS removed
FROM dirty WHERE TRY_CAST(latitude AS DOUBLE) IS NOT NULL
  AND TRY_CAST(longitude AS DOUBLE) IS NOT NULL""")
def standardize_coords(spark, sf):
    raw = b.dirty(spark, sf)
    kept = q.standardize_coordinates(raw)
    removed = raw.agg(F.count(F.lit(1))).scalar() - kept.agg(F.count(F.lit(1))).scalar()
    return kept.select("row_id", "latitude", "longitude", removed.alias("removed"))


# --- text ------------------------------------------------------------------------------


@query("normalize_text", f"""
SELECT doc_id, {b.norm_sql('text')} AS norm FROM documents""")
def normalize_text(spark, sf):
    return b.documents(spark, sf).select("doc_id", tx.normalize_text("text").alias("norm"))


@query("capitalize", "WITH " + b.DIRTY + """
SELECT row_id, upper(trim(gender)[1]) || lower(trim(gender)[2:]) AS gender FROM dirty""")
def capitalize(spark, sf):
    return b.dirty(spark, sf).select("row_id", tx.capitalize_first("gender").alias("gender"))


@query("title_case", """
SELECT p_partkey, array_to_string(list_transform(
  regexp_extract_all(lower(trim('  ' || p_name || '''s 3rd ' || p_type || '-X ')),
                     '[\\p{L}]+|[^\\p{L}]+'),
  lambda w: upper(w[1]) || w[2:]), '') AS title FROM part""")
def title_case(spark, sf):
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit("'s 3rd "), F.col("p_type"), F.lit("-X "))
    return b.table(spark, sf, "part").select("p_partkey", tx.title_case(raw).alias("title"))


@query("first_segment", "WITH " + b.DIRTY + """
SELECT row_id, trim(split_part(location_text, ',', 1)) AS first_part FROM dirty""")
def first_segment(spark, sf):
    return b.dirty(spark, sf).select(
        "row_id", tx.first_segment("location_text").alias("first_part")
    )


@query("tail_phrases", "WITH " + b.PLACE_TEXTS + f""", parts AS (
  SELECT row_id, list_filter(list_transform(string_split(location_text, ','),
         lambda x: trim(x)), lambda x: x <> '') AS p FROM place_texts)
SELECT row_id, {b.norm_sql("array_to_string(p[-2:], ' ')")} AS last_two,
       {b.norm_sql("p[-1]")} AS last_one FROM parts""")
def tail_phrases(spark, sf):
    tails = b.place_texts(spark, sf).withColumn("t", tx.tail_phrases("location_text"))
    return tails.select("row_id", F.get("t", F.lit(0)).alias("last_two"),
                        F.get("t", F.lit(1)).alias("last_one"))


_WORDS = ("nation", "asia", "africa", "middle east", "asía", "europe", "america")


@query("city_from_text", "WITH " + b.PLACE_TEXTS + """, t AS (
  SELECT row_id, location_text AS raw,
         regexp_replace(lower(location_text), 'city|\\.', '', 'g') AS x FROM place_texts)
SELECT row_id, CASE WHEN lower(trim(raw)) = 'na' THEN 'Unknown'
  WHEN contains(x, 'nation') THEN 'Nation' WHEN contains(x, 'asia') THEN 'Asia'
  WHEN contains(x, 'africa') THEN 'Africa' WHEN contains(x, 'middle east') THEN 'Middle East'
  WHEN contains(x, 'asía') THEN 'Asia' WHEN contains(x, 'europe') THEN 'Europe'
  WHEN contains(x, 'america') THEN 'America' ELSE 'Other/Unknown' END AS city FROM t""")
def city_from_text(spark, sf):
    city = tx.city_from_text("location_text", _WORDS, {"asía": "Asia"})
    return b.place_texts(spark, sf).select("row_id", city.alias("city"))


@query("district_priority", "WITH " + b.PLACE_TEXTS + f""", t AS (
  SELECT row_id, {b.norm_sql('location_text')} AS x FROM place_texts)
SELECT row_id, CASE WHEN contains(x, 'nation 2') THEN 'NATION_2'
  WHEN contains(x, 'nation 17') THEN 'NATION_17' WHEN contains(x, 'europe') THEN 'EUROPE' END
  AS district FROM t""")
def district_priority(spark, sf):
    texts = b.place_texts(spark, sf).select(
        "row_id", tx.normalize_text("location_text").alias("x"),
        tx.tail_phrases("location_text").alias("tails"),
    )
    rules = (*b.HOME_KEYWORDS, ("europe", "EUROPE"))
    return texts.select("row_id", tx.district_from_keyword("x", "tails", rules).alias("district"))


@query("city_label", """
SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 THEN 'Other/Unknown'
  WHEN lower(trim(n_name)) = 'nation_4' THEN 'NATION_4 City' ELSE n_name END AS city
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def city_label(spark, sf):
    s, n = b.table(spark, sf, "supplier"), b.table(spark, sf, "nation")
    city = F.when(F.col("s_nationkey") % 3 != 0, F.col("n_name"))
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        "s_suppkey", tx.city_label(city, "NATION_4").alias("city")
    )


@query("popup_text", "WITH " + b.CASES + """
SELECT row_id, '<b>Case #' || row_id || '</b><br>Date: ' || reported_date || '<br>Age: ' ||
  CAST(age AS INTEGER) || '<br>Gender: ' || gender || '<br>' AS popup FROM cases""")
def popup_text(spark, sf):
    head = F.concat(F.lit("Case #"), F.col("row_id"))
    popup = tx.popup_text(head, Date="reported_date", Age=F.col("age").cast("int"),
                          Gender="gender")
    return b.cases(spark, sf).select("row_id", popup.alias("popup"))


# --- dates and ages ----------------------------------------------------------------------


@query("parse_date", "WITH " + b.DIRTY + f"""
SELECT row_id, {b.MONTH_FIRST} AS reported_date FROM dirty""")
def parse_date(spark, sf):
    return b.dirty(spark, sf).select("row_id", v.parse_date("reported_date").alias("reported_date"))


@query("parse_date_robust", "WITH " + b.DIRTY + f"""
SELECT row_id, {b.EITHER_FIRST} AS reported_date FROM dirty""")
def parse_date_robust(spark, sf):
    return b.dirty(spark, sf).select(
        "row_id", v.parse_date_robust("reported_date").alias("reported_date")
    )


@query("date_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(quarter(ts) AS INTEGER) AS quarter, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(ts) AS INTEGER) AS day_of_year, strftime(ts, '%B') AS month_name FROM events""")
def date_parts(spark, sf):
    events = b.table(spark, sf, "events")
    return events.select("event_id", *[c.alias(n) for n, c in v.date_parts("ts").items()])


@query("parse_hour", "WITH " + b.DIRTY + """
SELECT row_id, CAST(hour(coalesce(try_strptime(reported_time, '%I:%M %p'),
  try_strptime(reported_time, '%H:%M'))) AS INTEGER) AS hour FROM dirty""")
def parse_hour(spark, sf):
    return b.dirty(spark, sf).select("row_id", v.parse_hour("reported_time").alias("hour"))


@query("cyclical_features", """
WITH p AS (SELECT event_id, month(ts) AS m, isodow(ts) - 1 AS d FROM events)
SELECT event_id, round(sin(2 * pi() * m / 12), 6) + 0.0 AS month_sin,
  round(cos(2 * pi() * m / 12), 6) + 0.0 AS month_cos,
  round(sin(2 * pi() * d / 7), 6) + 0.0 AS dow_sin,
  round(cos(2 * pi() * d / 7), 6) + 0.0 AS dow_cos FROM p""")
def cyclical_features(spark, sf):
    out = fc.temporal_features(b.table(spark, sf, "events"), "ts")
    return rounded(out.select("event_id", "month_sin", "month_cos", "dow_sin", "dow_cos"))


@query("age_group_cut", "WITH " + b.CASES + """
SELECT row_id, CASE WHEN age > 0 AND age <= 12 THEN 'Child (0-12)'
  WHEN age > 12 AND age <= 17 THEN 'Teen (13-17)' WHEN age > 17 AND age <= 30
  THEN 'Young Adult (18-30)' WHEN age > 30 AND age <= 50 THEN 'Adult (31-50)'
  WHEN age > 50 AND age <= 100 THEN 'Senior (51+)' END AS age_group FROM cases""")
def age_group_cut(spark, sf):
    return b.cases(spark, sf).select("row_id", v.age_cut("age").alias("age_group"))


SMART_AGE = """CASE lower(trim(age)) WHEN 'adult' THEN 'Adult' WHEN 'senior' THEN 'Old'
  WHEN 'teen' THEN 'Teen' WHEN 'young adult' THEN 'Young Adult' ELSE
  CASE WHEN TRY_CAST(age AS DOUBLE) IS NULL THEN 'Unknown'
    WHEN TRY_CAST(age AS DOUBLE) < 13 THEN 'Child'
    WHEN TRY_CAST(age AS DOUBLE) BETWEEN 13 AND 14 THEN 'Young Teen'
    WHEN TRY_CAST(age AS DOUBLE) BETWEEN 15 AND 17 THEN 'Teen'
    WHEN TRY_CAST(age AS DOUBLE) BETWEEN 18 AND 24 THEN 'Young Adult'
    WHEN TRY_CAST(age AS DOUBLE) BETWEEN 25 AND 59 THEN 'Adult' ELSE 'Old' END END"""


@query("smart_bin_age", "WITH " + b.DIRTY + f"""
SELECT row_id, {SMART_AGE} AS age_group FROM dirty""")
def smart_bin_age(spark, sf):
    return b.dirty(spark, sf).select("row_id", v.smart_age_group("age").alias("age_group"))


REPORT_AGE = """CASE WHEN contains(lower(age), 'teen') THEN 'Teen'
  WHEN contains(lower(age), 'senior') THEN 'Senior' WHEN contains(lower(age), 'adult')
  THEN 'Adult' WHEN contains(lower(age), 'child') THEN 'Child'
  WHEN regexp_full_match(trim(age), '[0-9]+') THEN
    CASE WHEN CAST(age AS INTEGER) < 13 THEN 'Child' WHEN CAST(age AS INTEGER) < 20 THEN 'Teen'
         WHEN CAST(age AS INTEGER) < 60 THEN 'Adult' ELSE 'Senior' END
  ELSE 'Unknown' END"""


@query("clean_age_group", "WITH " + b.DIRTY + f"""
SELECT row_id, {REPORT_AGE} AS age_group FROM dirty""")
def clean_age_group(spark, sf):
    return b.dirty(spark, sf).select("row_id", v.report_age_group("age").alias("age_group"))


# --- labels --------------------------------------------------------------------------------


@query("weighted_points", "WITH " + b.POINTS + """
SELECT row_id, latitude, longitude, greatest(latitude, 0.1) AS weight FROM points""")
def weighted_points(spark, sf):
    return layers.weighted_points(b.points(spark, sf), "latitude", "row_id")


@query("rate_ratio", "WITH " + b.CASES + """, c AS (
  SELECT district, year, count(*) AS n, count(*) FILTER (month < 7) AS prev FROM cases
  GROUP BY district, year)
SELECT district, year, round(n / (prev + 1.0), 6) AS rate_ratio FROM c""")
def rate_ratio(spark, sf):
    df = b.cases(spark, sf).groupBy("district", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("month") < 7).alias("prev")
    )
    return df.select("district", "year", F.round(v.rate_ratio("n", "prev"), 6).alias("rate_ratio"))


@query("signif_stars", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * l_tax AS p,
  CASE WHEN l_discount * l_tax < 0.001 THEN '***' WHEN l_discount * l_tax < 0.01 THEN '**'
       WHEN l_discount * l_tax < 0.05 THEN '*' ELSE '' END AS stars FROM lineitem""")
def signif_stars(spark, sf):
    p = F.col("l_discount") * F.col("l_tax")
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", p.alias("p"),
        v.significance(p).alias("stars"),
    )


@query("risk_color", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN abs(l_quantity - 25) <= 1 THEN 'green' WHEN abs(l_quantity - 25) <= 2 THEN 'orange'
       ELSE 'red' END AS error_color,
  CASE WHEN l_quantity - 25 > 1 THEN 'red' WHEN l_quantity - 25 > 0 THEN 'orange'
       WHEN l_quantity - 25 < -1 THEN 'green' ELSE 'blue' END AS change_color FROM lineitem""")
def risk_color(spark, sf):
    base = F.lit(25)
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        v.error_color("l_quantity", base).alias("error_color"),
        v.change_color("l_quantity", base).alias("change_color"),
    )


@query("split_marker", "WITH " + b.CASES + """
SELECT year, count(*) AS n, CASE WHEN year < 2000 THEN 'TRAIN' ELSE 'TEST' END AS marker
FROM cases GROUP BY year""")
def split_marker(spark, sf):
    counts = b.cases(spark, sf).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("marker", v.split_marker("year", 2000))


@query("r2_verdict", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount * 5 > 0.3
  THEN 'strong' WHEN l_discount * 5 > 0.15 THEN 'moderate' ELSE 'weak' END AS verdict
FROM lineitem""")
def r2_verdict(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        v.r2_verdict(F.col("l_discount") * 5).alias("verdict"),
    )


@query("gender_position", """
SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1
  WHEN 'HOUSEHOLD' THEN 2 END AS INTEGER) AS position FROM customer""")
def gender_position(spark, sf):
    code = position_code("c_mktsegment", ("BUILDING", "MACHINERY", "HOUSEHOLD"))
    return b.table(spark, sf, "customer").select("c_custkey", code.cast("int").alias("position"))

