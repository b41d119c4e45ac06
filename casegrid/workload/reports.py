"""Cleaning plans, trend report, map and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gazetteer as gz
from ..operators import layers as ly
from ..operators.joins import attach_actuals
from ..operators.summaries import location_centroid
from ..plans.cleaning import clean_cases, clean_extract, cleaning_report, stateless_clean
from ..plans.reports import trend_report
from ..plans.evaluation import long_table
from ..plans.study import hotspot_study
from . import bindings as b
from .registry import query, rounded
from .scalars import SMART_AGE

_KEPT = b.GAPPY + """, uniq AS (
  SELECT * FROM gappy QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY row_id) = 1),
 kept AS (SELECT * FROM uniq WHERE latitude IS NOT NULL AND longitude IS NOT NULL
          AND reported_date IS NOT NULL)"""


@query("clean_cases", f"""WITH {_KEPT}, filled AS (
  SELECT row_id, case_id, coalesce(age, (SELECT median(age) FROM kept)) AS age,
    coalesce(gender, 'Unknown') AS gender, reported_date,
    coalesce(reported_time, '00:00') AS reported_time, latitude, longitude,
    coalesce(district, 'Unknown') AS district, location_text FROM kept)
SELECT *, CAST(year(reported_date) AS INTEGER) AS year,
  CAST(month(reported_date) AS INTEGER) AS month,
  CAST(isodow(reported_date) - 1 AS INTEGER) AS day_of_week,
  CAST(quarter(reported_date) AS INTEGER) AS quarter,
  CASE WHEN age > 0 AND age <= 12 THEN 'Child (0-12)' WHEN age > 12 AND age <= 17
    THEN 'Teen (13-17)' WHEN age > 17 AND age <= 30 THEN 'Young Adult (18-30)'
    WHEN age > 30 AND age <= 50 THEN 'Adult (31-50)' WHEN age > 50 AND age <= 100
    THEN 'Senior (51+)' END AS age_group,
  CAST(dense_rank() OVER (ORDER BY gender) - 1 AS INTEGER) AS gender_code,
  CAST(dense_rank() OVER (ORDER BY district) - 1 AS INTEGER) AS district_code FROM filled""")
def clean_cases_query(spark, sf):
    return clean_cases(b.gappy(spark, sf))


@query("cleaning_report", f"""WITH {_KEPT}
SELECT (SELECT count(*) FROM gappy) AS initial_rows,
  (SELECT count(*) FROM gappy) - (SELECT count(*) FROM uniq) AS duplicates_removed,
  (SELECT count(*) FROM uniq) - count(*) AS missing_dropped,
  count(*) FILTER (age IS NULL) AS filled_age,
  count(*) FILTER (gender IS NULL) AS filled_gender,
  count(*) FILTER (district IS NULL) AS filled_district,
  count(*) FILTER (reported_time IS NULL) AS filled_reported_time,
  count(*) AS final_rows FROM kept""")
def cleaning_report_query(spark, sf):
    return cleaning_report(b.gappy(spark, sf))


@query("stateless_clean", "WITH " + b.DIRTY + f"""
SELECT row_id, upper(trim(gender)[1]) || lower(trim(gender)[2:]) AS gender,
  {b.MONTH_FIRST} AS reported_date, CAST(year({b.MONTH_FIRST}) AS INTEGER) AS year,
  CASE WHEN reported_time <> 'na' THEN reported_time END AS reported_time,
  {SMART_AGE} AS age_group, CAST(hour(coalesce(try_strptime(reported_time, '%I:%M %p'),
  try_strptime(reported_time, '%H:%M'))) AS INTEGER) AS hour FROM dirty""")
def stateless_clean_query(spark, sf):
    return stateless_clean(b.dirty(spark, sf)).select(
        "row_id", "gender", "reported_date", "year", "reported_time", "age_group", "hour"
    )


@query("clean_cases_geo", b.edit_match_tables("dirty", b.DIRTY) + f""",
 c AS (
  SELECT row_id, case_id, age, upper(trim(gender)[1]) || lower(trim(gender)[2:]) AS gender,
    {b.MONTH_FIRST} AS reported_date, CASE WHEN reported_time <> 'na' THEN reported_time END AS reported_time,
    location_text, {SMART_AGE} AS age_group, CAST(year({b.MONTH_FIRST}) AS INTEGER) AS year,
    CAST(hour(coalesce(try_strptime(reported_time, '%I:%M %p'),
      try_strptime(reported_time, '%H:%M'))) AS INTEGER) AS hour
  FROM dirty)
SELECT q.*, m.district, {b.MATCHED}, printf('MP-%04d', row_number() OVER (ORDER BY row_id)) AS person_id
FROM c q LEFT JOIN m ON m.raw = q.location_text WHERE reported_date IS NOT NULL""")
def clean_cases_geo(spark, sf):
    """Raw extract to cleaned cases with matched places and ids."""
    aliases = gz.alias_table(b.region_gazetteer(spark, sf))
    return clean_extract(
        b.dirty(spark, sf), aliases, home_city=b.HOME_CITY, keywords=b.HOME_KEYWORDS,
        venues=b.HOME_VENUES, similarity="edit",
    )


_SEASON = "['Summer', 'Summer', 'Fall', 'Fall', 'Fall', 'Winter', 'Winter', 'Winter', " \
          "'Spring', 'Spring', 'Spring', 'Summer']"


@query("trend_report", "WITH " + b.CASES + f""", y AS (
  SELECT year, count(*) AS cases FROM cases GROUP BY year),
 g AS (SELECT *, lag(cases) OVER (ORDER BY year) AS prev FROM y),
 m AS (SELECT month, count(*) AS n FROM cases GROUP BY month)
SELECT 'cases' AS section, CAST(year AS VARCHAR) AS item, CAST(cases AS DOUBLE) AS value FROM g
UNION ALL SELECT 'growth_pct', CAST(year AS VARCHAR),
  round((cases - prev) * 100.0 / prev, 6) FROM g
UNION ALL SELECT 'season_peak', 'peak_month',
  CAST((SELECT month FROM m ORDER BY n DESC, month LIMIT 1) AS DOUBLE)
UNION ALL SELECT 'season_peak', 'lowest_month',
  CAST((SELECT month FROM m ORDER BY n, month LIMIT 1) AS DOUBLE)
UNION ALL SELECT 'season', {_SEASON}[month], CAST(sum(n) AS DOUBLE) FROM m GROUP BY 2""")
def trend_report_query(spark, sf):
    return rounded(trend_report(b.cases(spark, sf)))


@query("hotspot_study")
def hotspot_study_query(spark, sf):
    """Raw cases to the forecast layer in one go, all its tables."""
    return long_table(hotspot_study(b.gappy(spark, sf)))


# --- map and chart tables --------------------------------------------------------------------


@query("heat_points", "WITH " + b.GAPPY + """
SELECT latitude, longitude, count(*) AS weight FROM gappy
WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY latitude, longitude""")
def heat_points(spark, sf):
    return ly.heat_points(b.gappy(spark, sf))


@query("case_scatter", f"""WITH {b.POINTS}
SELECT row_id, latitude, longitude, cluster, district FROM points""")
def case_scatter(spark, sf):
    return b.points(spark, sf).select("row_id", "latitude", "longitude", "cluster", "district")


def _layer_sql(source: str, value: str) -> str:
    return f"""SELECT 'point' AS kind, district AS name, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, CAST(round(greatest({value}, 0.1), 6) AS DOUBLE) AS weight
  FROM {source}
UNION ALL SELECT 'center', NULL, round(avg(latitude), 6), round(avg(longitude), 6), NULL
  FROM {source}
UNION ALL SELECT * FROM (SELECT 'marker', district, round(latitude, 6), round(longitude, 6),
  CAST(round({value}, 6) AS DOUBLE) FROM {source} ORDER BY {value} DESC, district LIMIT 10)"""


@query("prediction_layer", "WITH " + b.CASES + """, p AS (
  SELECT district, avg(latitude) AS latitude, avg(longitude) AS longitude,
    avg(age) - 50.0 AS predicted_cases FROM cases GROUP BY district)
""" + _layer_sql("p", "predicted_cases"))
def prediction_layer(spark, sf):
    p = location_centroid(b.cases(spark, sf)).withColumn(
        "predicted_cases", F.col("age") - 50.0
    )
    return rounded(ly.map_layer(p, "predicted_cases"))


@query("actual_layer", "WITH " + b.CASES + """, p AS (
  SELECT district, avg(latitude) AS latitude, avg(longitude) AS longitude,
    count(*) AS actual_cases FROM cases WHERE year = 2000 GROUP BY district)
""" + _layer_sql("p", "actual_cases"))
def actual_layer(spark, sf):
    return rounded(ly.actual_layer(b.cases(spark, sf), 2000))


@query("district_labels", "WITH " + b.GAPPY + """
SELECT district, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
  count(case_id) AS case_count, district || '<br>(' || count(case_id) || ' cases)' AS label
FROM gappy WHERE district IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
GROUP BY district""")
def district_labels(spark, sf):
    return rounded(ly.district_labels(b.gappy(spark, sf)))


@query("pred_vs_actual", "WITH " + b.CASES + """, d AS (
  SELECT district, count(*) FILTER (year = 1999) / 3.0 AS p,
    count(*) FILTER (year = 2000) AS actual_cases FROM cases GROUP BY district),
 r AS (SELECT *, round_even(p * 100, 0) / 100 AS pr FROM d)
SELECT district, round(p, 6) AS predicted_cases, actual_cases,
  round(pr - actual_cases, 2) AS error, round(abs(pr - actual_cases), 2) AS abs_error,
  CASE WHEN abs(p - actual_cases) <= 1 THEN 'green' WHEN abs(p - actual_cases) <= 2
    THEN 'orange' ELSE 'red' END AS color FROM r""")
def pred_vs_actual(spark, sf):
    cases = b.cases(spark, sf)
    p = cases.groupBy("district").agg(
        (F.count_if(F.col("year") == 1999) / F.lit(3.0)).alias("predicted_cases")
    )
    both = attach_actuals(p, cases.filter(F.col("year") == 2000))
    return rounded(ly.predicted_vs_actual(both))


@query("chart_bundle", f"WITH {b.CASES}" + """
SELECT 'gender' AS chart, gender AS item, count(*) AS n FROM cases GROUP BY gender
UNION ALL SELECT 'age', o.c, (SELECT count(*) FROM cases WHERE age > o.lo AND age <= o.hi)
  FROM (VALUES ('Child (0-12)', 0, 12), ('Teen (13-17)', 12, 17),
    ('Young Adult (18-30)', 17, 30), ('Adult (31-50)', 30, 50), ('Senior (51+)', 50, 100))
    AS o(c, lo, hi)
UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(*) FROM cases GROUP BY year
UNION ALL SELECT 'month', ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep',
  'Oct', 'Nov', 'Dec'][month], count(*) FROM cases GROUP BY month
UNION ALL SELECT * FROM (SELECT 'location', district, count(*) AS n FROM cases GROUP BY district
  ORDER BY n DESC, district LIMIT 15)
UNION ALL SELECT 'cluster', CAST(person % 5 AS VARCHAR), count(*) FROM cases GROUP BY 2""")
def chart_bundle(spark, sf):
    df = b.cases(spark, sf).withColumn("cluster", F.col("person") % 5)
    return ly.chart_bundle(df, label="cluster")
