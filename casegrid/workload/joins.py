"""Lookups, the gazetteer and place matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..operators import gazetteer as gz
from ..operators import joins as jn
from ..operators import summaries as sm
from ..operators.places import match_places
from ..operators.similar import alike
from . import bindings as b
from .registry import query, rounded

_CENTROID = """cent AS (SELECT district, avg(latitude) AS latitude,
  avg(longitude) AS longitude, avg(age) AS age FROM cases GROUP BY district)"""


@query("prev_year_join", f"""WITH {b.CASES}, {_CENTROID}, prev AS (
  SELECT district, count(case_id) AS n FROM cases WHERE year = 2000 GROUP BY district)
SELECT cent.district, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
  round(age, 6) AS age, coalesce(n, 0) AS prev_count, 2001 AS year
FROM cent LEFT JOIN prev ON cent.district = prev.district""")
def prev_year_join(spark, sf):
    c = b.cases(spark, sf)
    return rounded(jn.previous_year_join(sm.location_centroid(c), sm.panel(c), 2001))


@query("actuals_lookup", """
WITH a AS (SELECT o_custkey, count(o_orderkey) AS n FROM orders
           WHERE o_orderdate >= DATE '2001-01-01' GROUP BY o_custkey)
SELECT c_custkey AS person, c_acctbal AS predicted_cases, coalesce(n, 0) AS actual_cases
FROM customer LEFT JOIN a ON c_custkey = o_custkey""")
def actuals_lookup(spark, sf):
    predictions = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("person"), F.col("c_acctbal").alias("predicted_cases")
    )
    test = b.table(spark, sf, "orders").filter(
        F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    ).select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("case_id"))
    return jn.attach_actuals(predictions, test, "person")


@query("geo_fill", f"""WITH {b.GAPPY}, d AS (
  SELECT district, round(avg(latitude), 4) AS la, round(avg(longitude), 4) AS lo FROM gappy
  WHERE district IS NOT NULL AND district <> 'NATION_5' GROUP BY district),
 f AS (SELECT row_id, g.district, la IS NOT NULL AND (latitude IS NULL OR longitude IS NULL)
   AS gap, latitude, longitude, la, lo FROM gappy g LEFT JOIN d ON g.district = d.district),
 o AS (SELECT row_id, district, CASE WHEN gap THEN la ELSE latitude END AS latitude,
   CASE WHEN gap THEN lo ELSE longitude END AS longitude FROM f)
SELECT * FROM o WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def geo_fill(spark, sf):
    g = b.gappy(spark, sf).select("row_id", "district", "latitude", "longitude")
    known = g.filter(F.col("district") != "NATION_5")  # one district has no position
    districts = known.groupBy("district").agg(
        F.round(F.avg("latitude"), 4).alias("latitude"),
        F.round(F.avg("longitude"), 4).alias("longitude"),
    )
    return jn.fill_coordinates(g, districts)


_ALIASES = f"""alias_forms AS (
  SELECT 'city' AS level, r_name AS city, CAST(NULL AS VARCHAR) AS district,
    unnest([r_name, 'city of ' || r_name, r_name || ' city']) AS form FROM region
  UNION ALL
  SELECT 'district', r_name, n_name, unnest([n_name, n_name || ' ' || r_name,
    r_name || ' ' || n_name, 'zone ' || n_nationkey])
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'barangay', r_name, n_name, unnest(['barangay ' || u, 'barangay ' || u || ' ' || n_name,
    'barangay ' || u || ' ' || r_name, '' || u, u || ' ' || n_name, u || ' ' || r_name])
  FROM (SELECT *, unnest(range(n_nationkey * 10 + 1, n_nationkey * 10 + 11)) AS u
        FROM nation JOIN region ON n_regionkey = r_regionkey)),
 aliases AS (SELECT DISTINCT level, city, district, {b.norm_sql('form')} AS alias
             FROM alias_forms),
 normed AS (SELECT row_id, {b.norm_sql('location_text')} AS norm FROM place_texts)"""


def _normed(spark, sf):
    return b.place_texts(spark, sf).select(
        "row_id", normalize_text("location_text").alias("norm")
    )


def _aliases(spark, sf):
    return gz.alias_table(b.region_gazetteer(spark, sf)).select(
        "ordinal", "level", "city", "district", "alias"
    )


_CONTAINS = f"""WITH {b.PLACE_TEXTS}, {_ALIASES}
SELECT row_id, norm, level, city, district, alias FROM normed, aliases
WHERE contains(norm, alias)"""


@query("alias_contains_join", _CONTAINS)
def alias_contains_join(spark, sf):
    """City, district and barangay aliases inside place texts."""
    return gz.contained_aliases(
        _normed(spark, sf), "row_id", "norm", _aliases(spark, sf)
    ).drop("ordinal")


@query("alias_contains_equijoin", _CONTAINS)
def alias_contains_equijoin(spark, sf):
    """The same with the planner's broadcast ruled out: pieces meet in a shuffle."""
    aliases = _aliases(spark, sf)
    return gz.contained_aliases(
        _normed(spark, sf), "row_id", "norm", aliases, merge=True
    ).drop("ordinal")


@query("alias_contains_documents", f"""
WITH w AS (SELECT DISTINCT p_name AS alias FROM part UNION
           SELECT DISTINCT lower(p_type) FROM part UNION
           SELECT DISTINCT split_part(p_name, ' ', 1) FROM part UNION
           SELECT DISTINCT split_part(p_name, ' ', 2) FROM part),
 d AS (SELECT doc_id, {b.norm_sql('text')} AS norm FROM documents)
SELECT doc_id, alias FROM d, w WHERE contains(norm, alias)""")
def alias_contains_documents(spark, sf):
    """Part words looked for in the whole document texts."""
    part = b.table(spark, sf, "part")
    words = F.array(
        "p_name", F.lower("p_type"), F.split_part("p_name", F.lit(" "), F.lit(1)),
        F.split_part("p_name", F.lit(" "), F.lit(2)),
    )
    aliases = part.select(F.explode(words).alias("alias")).distinct()
    docs = b.documents(spark, sf).select("doc_id", normalize_text("text").alias("norm"))
    return gz.contained_aliases(docs, "doc_id", "norm", aliases).select("doc_id", "alias")


@query("first_contained_alias", f"""WITH {b.PLACE_TEXTS}, {_ALIASES}, hits AS (
  SELECT row_id, level, city, district FROM normed, aliases WHERE contains(norm, alias))
SELECT row_id, level, hits.city, hits.district FROM hits
LEFT JOIN nation ON n_name = hits.district JOIN region ON r_name = hits.city
QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY
  CASE level WHEN 'barangay' THEN 0 WHEN 'district' THEN 1 ELSE 2 END,
  r_regionkey, n_nationkey) = 1""")
def first_contained_alias(spark, sf):
    return gz.first_contained_alias(
        _normed(spark, sf), "row_id", "norm", _aliases(spark, sf)
    ).select("row_id", "level", "city", "district")


@query("fuzzy_location_match")
def fuzzy_location_match(spark, sf):
    aliases = gz.alias_table(b.region_gazetteer(spark, sf))
    return match_places(
        b.place_texts(spark, sf), "location_text", aliases, home_city=b.HOME_CITY,
        keywords=b.HOME_KEYWORDS, venues=b.HOME_VENUES,
    )


@query("fuzzy_location_levenshtein", b.edit_match_sql("place_texts", b.PLACE_TEXTS))
def fuzzy_location_levenshtein(spark, sf):
    """The whole rule order with edit distance as the similarity."""
    aliases = gz.alias_table(b.region_gazetteer(spark, sf))
    return match_places(
        b.place_texts(spark, sf), "location_text", aliases, home_city=b.HOME_CITY,
        keywords=b.HOME_KEYWORDS, venues=b.HOME_VENUES, similarity="edit",
    )


@query("edit_similarity_join", f"""WITH {b.PLACE_TEXTS}, {_ALIASES}
SELECT norm, alias, round(max(1.0 - levenshtein(norm, alias) / greatest(length(norm), length(alias))), 9) AS score
FROM normed, aliases WHERE norm <> '' AND alias <> ''
  AND 1.0 - levenshtein(norm, alias) / greatest(length(norm), length(alias)) >= 0.55
GROUP BY norm, alias""")
def edit_similarity_join(spark, sf):
    """Every place text and alias at least 0.55 alike by edit distance."""
    texts = _normed(spark, sf).select("norm").distinct()
    found = alike(texts, "norm", "norm", _aliases(spark, sf).select("alias").distinct(), "alias", 0.55)
    return found.groupBy("norm", "alias").agg(F.round(F.max("score"), 9).alias("score"))


# --- forecast grid ---------------------------------------------------------------------------


@query("forecast_grid", f"""WITH {b.CASES}, hist AS (
  SELECT person AS place, * FROM cases WHERE year < 1997),
 keys AS (SELECT DISTINCT person AS place FROM cases WHERE year <= 1997),
 cent AS (SELECT place, avg(latitude) AS la, avg(longitude) AS lo, avg(age) AS ag,
   count(*) FILTER (year = 1996) AS prev FROM hist GROUP BY place),
 overall AS (SELECT avg(latitude) AS la, avg(longitude) AS lo, avg(age) AS ag FROM hist)
SELECT keys.place, 1997 AS year, coalesce(prev, 0) AS prev_count,
  round(CASE WHEN cent.place IS NULL THEN overall.la ELSE cent.la END, 6) AS latitude,
  round(CASE WHEN cent.place IS NULL THEN overall.lo ELSE cent.lo END, 6) AS longitude,
  round(CASE WHEN cent.place IS NULL THEN overall.ag ELSE cent.ag END, 6) AS age
FROM keys LEFT JOIN cent ON keys.place = cent.place, overall""")
def forecast_grid(spark, sf):
    c = b.cases(spark, sf).withColumnRenamed("person", "place")
    history, test = c.filter(F.col("year") < 1997), c.filter(F.col("year") == 1997)
    return rounded(jn.forecast_grid(history, test, 1997, location="place"))
