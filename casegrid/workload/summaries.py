"""Aggregations, windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as tx
from ..functions import values as v
from ..operators import ordering as od
from ..operators import quality as q
from ..operators import summaries as sm
from . import bindings as b
from .registry import query, rounded
from .scalars import REPORT_AGE

_PANEL = b.CASES + """, panel AS (
  SELECT district, year, count(case_id) AS case_count, avg(latitude) AS latitude,
         avg(longitude) AS longitude, avg(age) AS age FROM cases GROUP BY district, year)"""
_LAG = _PANEL + """, lagged AS (
  SELECT *, lag(case_count) OVER (PARTITION BY district ORDER BY year) AS prev_count
  FROM panel)"""
_ROUND_PANEL = """district, year, case_count, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, round(age, 6) AS age"""

# --- panels ------------------------------------------------------------------------------


@query("panel_loc_year", f"WITH {_PANEL} SELECT {_ROUND_PANEL} FROM panel")
def panel_loc_year(spark, sf):
    return rounded(sm.panel(b.cases(spark, sf)))


@query("panel_loc_month", "WITH " + b.CASES + """
SELECT district, month, count(case_id) AS case_count, round(avg(latitude), 6) AS latitude,
  round(avg(longitude), 6) AS longitude, round(avg(age), 6) AS age
FROM cases GROUP BY district, month""")
def panel_loc_month(spark, sf):
    return rounded(sm.panel(b.cases(spark, sf), period="month"))


@query("panel_centroid", "WITH " + b.CASES + """
SELECT district, year, count(*) AS case_count, round(avg(latitude), 6) AS lat_mean,
  round(avg(longitude), 6) AS lon_mean FROM cases GROUP BY district, year""")
def panel_centroid(spark, sf):
    return rounded(sm.panel_centroid(b.cases(spark, sf)))


@query("location_centroid", "WITH " + b.CASES + """
SELECT district, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
  round(avg(age), 6) AS age FROM cases GROUP BY district""")
def location_centroid(spark, sf):
    return rounded(sm.location_centroid(b.cases(spark, sf)))


@query("actual_year_counts", "WITH " + b.CASES + """
SELECT district, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
  count(*) AS actual_cases FROM cases WHERE year = 2000 GROUP BY district""")
def actual_year_counts(spark, sf):
    return rounded(sm.actual_year_counts(b.cases(spark, sf), 2000))


@query("lag_prev_year", f"""WITH {_LAG}
SELECT {_ROUND_PANEL}, prev_count FROM lagged WHERE prev_count IS NOT NULL""")
def lag_prev_year(spark, sf):
    return rounded(sm.lag_previous(sm.panel(b.cases(spark, sf))))


@query("lag_calendar_year", """
WITH p AS (SELECT o_custkey AS person, CAST(year(o_orderdate) AS INTEGER) AS year,
  count(*) AS n FROM orders GROUP BY 1, 2)
SELECT a.person, a.year, a.n AS case_count, coalesce(z.n, 0) AS prev_count
FROM p a LEFT JOIN p z ON a.person = z.person AND z.year = a.year - 1""")
def lag_calendar_year(spark, sf):
    frame = sm.panel(b.cases(spark, sf), location="person")
    return sm.lag_previous(frame, location="person", calendar=True).select(
        "person", "year", "case_count", "prev_count"
    )


# --- counts --------------------------------------------------------------------------------


@query("value_counts", "WITH " + b.DIRTY + """
SELECT district, count(*) AS n FROM dirty WHERE district IS NOT NULL GROUP BY district""")
def value_counts(spark, sf):
    return od.value_counts(b.dirty(spark, sf), "district")


@query("value_counts_with_null", "WITH " + b.DIRTY + """
SELECT age, count(*) AS n FROM dirty GROUP BY age""")
def value_counts_with_null(spark, sf):
    return od.value_counts(b.dirty(spark, sf), "age", keep_null=True)


@query("nunique", "WITH " + b.DIRTY + """
SELECT count(DISTINCT district) AS districts, count(DISTINCT case_id) AS persons FROM dirty""")
def nunique(spark, sf):
    return b.dirty(spark, sf).agg(
        F.count_distinct("district").alias("districts"),
        F.count_distinct("case_id").alias("persons"),
    )


@query("age_summary", "WITH " + b.CASES + """
SELECT round(avg(age), 6) AS mean, min(age) AS min, max(age) AS max, median(age) AS median
FROM cases""")
def age_summary(spark, sf):
    return rounded(sm.numeric_summary(b.cases(spark, sf), "age"), 6, "mean")


@query("date_range", "WITH " + b.GAPPY + """
SELECT min(reported_date) AS earliest, max(reported_date) AS latest FROM gappy""")
def date_range(spark, sf):
    return b.gappy(spark, sf).agg(
        F.min("reported_date").alias("earliest"), F.max("reported_date").alias("latest")
    )


@query("data_summary", "WITH " + b.GAPPY + """, g AS (
  SELECT gender AS k, count(*) AS n FROM gappy WHERE gender IS NOT NULL GROUP BY gender),
 t AS (SELECT district AS k, count(*) AS n FROM gappy WHERE district IS NOT NULL
       GROUP BY district ORDER BY n DESC, k LIMIT 10)
SELECT count(*) AS total_records, 9 AS n_columns, count(*) FILTER (age IS NULL) AS missing_age,
  min(reported_date) AS earliest, max(reported_date) AS latest,
  count(DISTINCT district) AS unique_locations, round(avg(age), 6) AS age_mean,
  median(age) AS age_median, min(age) AS age_min, max(age) AS age_max,
  (SELECT string_agg(k || '=' || n, ';' ORDER BY k) FROM g) AS genders,
  (SELECT string_agg(k || '=' || n, ';' ORDER BY k) FROM t) AS top_places FROM gappy""")
def data_summary(spark, sf):
    df = b.gappy(spark, sf).drop("row_id")

    def flat(col):
        pairs = F.transform(
            F.array_sort(F.map_entries(col)),
            lambda e: F.concat(e["key"], F.lit("="), e["value"]),
        )
        return F.array_join(pairs, ";")

    s = q.data_summary(df)
    return rounded(
        s.select(
            "total_records", F.size("columns").alias("n_columns"),
            s.missing_values["age"].alias("missing_age"), "earliest", "latest",
            "unique_locations", "age_mean", "age_median", "age_min", "age_max",
            flat("gender_distribution").alias("genders"),
            flat("top_locations").alias("top_places"),
        ),
        6, "age_mean",
    )


_COLUMNS = ["case_id", "age", "gender", "reported_date", "reported_time", "latitude",
            "longitude", "district", "location_text"]


def _per_column(expr: str, source: str, cols=_COLUMNS) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {expr.format(c=c)} FROM {source}" for c in cols
    )


@query("null_counts", "WITH " + b.GAPPY + " " + _per_column(
    "count(*) FILTER ({c} IS NULL) AS missing", "gappy"))
def null_counts(spark, sf):
    return q.null_counts(b.gappy(spark, sf).drop("row_id"))


_MISSING = "({c} IS NULL OR lower(trim({c})) = 'na')"


@query("missing_audit", "WITH " + b.DIRTY + " " + _per_column(
    f"count(*) FILTER {_MISSING} AS missing", "dirty"))
def missing_audit(spark, sf):
    return q.missing_audit(b.dirty(spark, sf).drop("row_id"))


_CELLS = " + ".join(
    f"CASE WHEN {_MISSING.format(c=c)} THEN 1 ELSE 0 END" for c in _COLUMNS
)


@query("pct_empty", "WITH " + b.DIRTY + f"""
SELECT CAST(sum({_CELLS}) AS BIGINT) AS missing_cells, count(*) * 9 AS total_cells,
  round(sum({_CELLS}) * 100.0 / (count(*) * 9), 6) AS pct_empty FROM dirty""")
def pct_empty(spark, sf):
    return rounded(q.percent_empty(b.dirty(spark, sf).drop("row_id")))


_TYPES = {"age": "double", "reported_date": "date", "latitude": "double", "longitude": "double"}


@query("column_profile", "WITH " + b.GAPPY + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{_TYPES.get(c, "string")}' AS data_type,
        count(*) FILTER ({c} IS NULL) AS missing,
        round_even(count(*) FILTER ({c} IS NULL) * 100.0 / count(*) * 100, 0) / 100
        AS missing_pct FROM gappy""" for c in _COLUMNS))
def column_profile(spark, sf):
    return q.column_profile(b.gappy(spark, sf).drop("row_id"))


@query("stage_counts", "WITH " + b.GAPPY + """
SELECT 'raw' AS stage, count(*) AS n, count(*) > 0 AS ready FROM gappy UNION ALL
SELECT 'clean', count(*), count(*) > 0 FROM gappy WHERE latitude IS NOT NULL
  AND longitude IS NOT NULL AND reported_date IS NOT NULL""")
def stage_counts(spark, sf):
    raw = b.gappy(spark, sf)
    return q.stage_counts(raw, q.drop_missing(raw, ["latitude", "longitude", "reported_date"]))


# --- time ------------------------------------------------------------------------------------


@query("yearly_counts", "WITH " + b.CASES + " SELECT year, count(*) AS n FROM cases GROUP BY year")
def yearly_counts(spark, sf):
    return sm.yearly_counts(b.cases(spark, sf))


@query("monthly_counts", "WITH " + b.CASES + """
SELECT month, count(*) AS n, ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep',
  'Oct', 'Nov', 'Dec'][month] AS month_name FROM cases GROUP BY month""")
def monthly_counts(spark, sf):
    return sm.monthly_counts(b.cases(spark, sf))


_FILLED = """filled AS (
  SELECT CAST(m AS INTEGER) AS month, (SELECT count(*) FROM events WHERE month(ts) = m) AS n
  FROM (SELECT unnest(range(1, 13)) AS m))"""


@query("monthly_filled", f"WITH {_FILLED} SELECT month, n FROM filled")
def monthly_filled(spark, sf):
    events = b.table(spark, sf, "events").select(F.month("ts").alias("month"))
    return sm.monthly_filled(events)


@query("month_intensity", "WITH " + b.CASES + """, c AS (
  SELECT month, count(*) AS n FROM cases GROUP BY month)
SELECT month, n, round(n * 1.0 / (SELECT max(n) FROM c), 6) AS intensity FROM c""")
def month_intensity(spark, sf):
    return rounded(sm.month_intensity(b.cases(spark, sf)))


@query("monthly_timeline", "WITH " + b.GAPPY + """
SELECT CAST(date_trunc('month', reported_date) AS DATE) AS month_start, count(*) AS n
FROM gappy WHERE reported_date IS NOT NULL GROUP BY 1""")
def monthly_timeline(spark, sf):
    return sm.monthly_timeline(b.gappy(spark, sf))


@query("year_month_counts", "WITH " + b.CASES + """
SELECT year, month, count(*) AS n FROM cases GROUP BY year, month""")
def year_month_counts(spark, sf):
    return sm.crosstab_counts(b.cases(spark, sf), "year", "month")


@query("crosstab_year_city", "WITH " + b.GAPPY + """
SELECT CAST(year(reported_date) AS INTEGER) AS year, district, count(*) AS n FROM gappy
WHERE reported_date IS NOT NULL AND district IS NOT NULL AND district <> 'NATION_3'
GROUP BY 1, 2""")
def crosstab_year_city(spark, sf):
    df = b.gappy(spark, sf).filter(F.col("district") != "NATION_3")
    return sm.crosstab_counts(df.withColumn("year", F.year("reported_date")), "year", "district")


_TOP10 = """top10 AS (SELECT district FROM cases GROUP BY district
  ORDER BY count(*) DESC, district LIMIT 10)"""


@query("crosstab_loc_gender", f"""WITH {b.CASES}, {_TOP10}
SELECT district, gender, count(*) AS n FROM cases
WHERE district IN (SELECT district FROM top10) GROUP BY district, gender""")
def crosstab_loc_gender(spark, sf):
    top = od.topk_semi(b.cases(spark, sf), "district", 10)
    return sm.crosstab_counts(top, "district", "gender")


@query("topk_semi", f"""WITH {b.CASES}, {_TOP10}
SELECT row_id, district FROM cases WHERE district IN (SELECT district FROM top10)""")
def topk_semi(spark, sf):
    return od.topk_semi(b.cases(spark, sf).select("row_id", "district"), "district", 10)


@query("hour_histogram", """
WITH h AS (SELECT CAST(hour(ts) AS DOUBLE) AS v FROM events),
 r AS (SELECT min(v) AS lo, max(v) AS hi FROM h)
SELECT CAST(least(floor((v - lo) / ((hi - lo) / 24)), 23) AS INTEGER) AS bin, count(*) AS n
FROM h, r GROUP BY 1""")
def hour_histogram(spark, sf):
    events = b.table(spark, sf, "events").select(F.hour("ts").alias("hour"))
    return sm.equal_width_histogram(events, "hour", 24)


@query("hour_kde", """
WITH h AS (SELECT CAST(hour(ts) AS DOUBLE) AS v, count(*) AS n FROM events GROUP BY 1),
 s AS (SELECT count(*) AS total,
         stddev_samp(hour(ts)) * pow(count(*), -0.2) AS bw FROM events),
 g AS (SELECT CAST(unnest(range(0, 24)) AS DOUBLE) AS grid_point)
SELECT grid_point, round(sum(n * exp(-0.5 * ((grid_point - v) / bw) * ((grid_point - v) / bw)))
  / (any_value(total) * any_value(bw) * sqrt(2 * pi())), 9) AS density
FROM h, s, g GROUP BY grid_point""")
def hour_kde(spark, sf):
    events = b.table(spark, sf, "events").select(F.hour("ts").alias("hour"))
    return rounded(sm.gaussian_density(events, "hour", list(range(24))), 9, "density")


@query("age_histogram", "WITH " + b.CASES + """, r AS (
  SELECT min(age) AS lo, max(age) AS hi FROM cases)
SELECT CAST(least(floor((age - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n
FROM cases, r GROUP BY 1""")
def age_histogram(spark, sf):
    return sm.equal_width_histogram(b.cases(spark, sf), "age", 20)


_CUT = """CASE WHEN age > 0 AND age <= 12 THEN 'Child (0-12)'
  WHEN age > 12 AND age <= 17 THEN 'Teen (13-17)' WHEN age > 17 AND age <= 30
  THEN 'Young Adult (18-30)' WHEN age > 30 AND age <= 50 THEN 'Adult (31-50)'
  WHEN age > 50 AND age <= 100 THEN 'Senior (51+)' END"""
_CUT_LABELS = "[" + ", ".join(f"'{x}'" for x in K.AGE_CUT_LABELS) + "]"


@query("age_group_counts", "WITH " + b.CASES + f""", c AS (
  SELECT {_CUT} AS category, count(*) AS n FROM cases GROUP BY 1),
 o AS (SELECT unnest({_CUT_LABELS}) AS category, unnest([0, 1, 2, 3, 4]) AS position)
SELECT CAST(position AS INTEGER) AS position, o.category, coalesce(n, 0) AS n
FROM o LEFT JOIN c ON o.category = c.category""")
def age_group_counts(spark, sf):
    return sm.age_group_counts(b.cases(spark, sf))


@query("location_completeness", "WITH " + b.PLACE_TEXTS + """
SELECT count(*) FILTER (lower(location_text) <> 'na') AS known,
  count(*) FILTER (lower(location_text) = 'na') AS unknown FROM place_texts""")
def location_completeness(spark, sf):
    return sm.known_unknown(b.place_texts(spark, sf), tx.is_missing("location_text"))


@query("gender_share", "WITH " + b.DIRTY + """, c AS (
  SELECT gender, count(*) AS n FROM dirty WHERE gender IS NOT NULL GROUP BY gender)
SELECT gender, n, round(n * 100.0 / (SELECT sum(n) FROM c), 6) AS share_pct FROM c""")
def gender_share(spark, sf):
    return rounded(sm.share_of_total(b.dirty(spark, sf), "gender"))


@query("window_count", "WITH " + b.CASES + """
SELECT count(*) AS n FROM cases WHERE year BETWEEN 1996 AND 1999""")
def window_count(spark, sf):
    return b.cases(spark, sf).filter(F.col("year").between(1996, 1999)).agg(
        F.count(F.lit(1)).alias("n")
    )


_REPORT_AGE_ORDER = "['Child', 'Teen', 'Adult', 'Senior']"


@query("yearly_report", "WITH " + b.DIRTY + f""", r AS (
  SELECT CAST(c.year AS VARCHAR) AS year, c.month, dirty.district,
    {REPORT_AGE.replace('(age', '(dirty.age')} AS age_group, trim(dirty.gender) AS gender
  FROM dirty JOIN cases c ON c.row_id = dirty.row_id),
 s AS (SELECT 'all' AS scope, * FROM r UNION ALL SELECT year, * FROM r),
 scopes AS (SELECT DISTINCT scope FROM s),
 months AS (SELECT scope, 'month' AS section, CAST(m AS VARCHAR) AS item,
    (SELECT count(*) FROM s WHERE s.scope = scopes.scope AND s.month = m) AS n
    FROM scopes, (SELECT unnest(range(1, 13)) AS m)),
 ages AS (SELECT scope, 'age_group' AS section, a AS item,
    (SELECT count(*) FROM s WHERE s.scope = scopes.scope AND s.age_group = a) AS n
    FROM scopes, (SELECT unnest({_REPORT_AGE_ORDER}) AS a)),
 genders AS (SELECT scope, 'gender' AS section, gender AS item, count(*) AS n FROM s
    WHERE gender IS NOT NULL GROUP BY scope, gender),
 places AS (SELECT scope, 'location' AS section, district AS item, n FROM (
    SELECT scope, district, count(*) AS n, row_number() OVER (
      PARTITION BY scope ORDER BY count(*) DESC, district) AS rk
    FROM s WHERE district IS NOT NULL GROUP BY scope, district) WHERE rk <= 5)
SELECT * FROM months UNION ALL SELECT * FROM ages UNION ALL SELECT * FROM genders
UNION ALL SELECT * FROM places""")
def yearly_report(spark, sf):
    calendar = b.cases(spark, sf).select("row_id", "year", "month")
    df = b.dirty(spark, sf).join(calendar, "row_id").select(
        "year", "month", "district", v.report_age_group("age").alias("age_group"),
        F.trim("gender").alias("gender"),
    )
    return sm.yearly_report(df)


# --- seasons, growth -----------------------------------------------------------------------------


@query("peak_month", "WITH " + b.CASES + """, c AS (
  SELECT month, count(*) AS n FROM cases GROUP BY month)
SELECT (SELECT month FROM c ORDER BY n DESC, month LIMIT 1) AS peak_month,
       (SELECT month FROM c ORDER BY n, month LIMIT 1) AS lowest_month""")
def peak_month(spark, sf):
    return sm.peak_and_low_month(b.cases(spark, sf))


@query("month_count_map", "WITH " + b.CASES + """, c AS (
  SELECT month, count(*) AS n FROM cases GROUP BY month)
SELECT string_agg(month || '=' || n, ';' ORDER BY month) AS counts FROM c""")
def month_count_map(spark, sf):
    pairs = F.transform(
        F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return sm.month_count_map(b.cases(spark, sf)).select(F.array_join(pairs, ";").alias("counts"))


def _season_sql(names):
    return f"[{', '.join(repr(n) for n in names)}][month]"


@query("season_counts", "WITH " + b.CASES + f"""
SELECT {_season_sql(K.SEASONS)} AS season, count(*) AS n FROM cases GROUP BY 1""")
def season_counts(spark, sf):
    return sm.season_counts(b.cases(spark, sf))


@query("season_counts_northern", "WITH " + b.CASES + f"""
SELECT {_season_sql(K.SEASONS_NORTHERN)} AS season, count(*) AS n FROM cases GROUP BY 1""")
def season_counts_northern(spark, sf):
    return sm.season_counts(b.cases(spark, sf), seasons=K.SEASONS_NORTHERN)


_GROWTH = b.CASES + """, y AS (SELECT year, count(*) AS cases FROM cases GROUP BY year),
 g AS (SELECT *, lag(cases) OVER (ORDER BY year) AS prev FROM y)"""


@query("yoy_growth", f"""WITH {_GROWTH}
SELECT year, cases, round((cases - prev) * 100.0 / prev, 6) AS growth_pct,
  CASE WHEN prev IS NULL THEN 'nan%' ELSE printf('%.1f%%', (cases - prev) * 100.0 / prev) END
  AS growth_label FROM g""")
def yoy_growth(spark, sf):
    return rounded(sm.yearly_growth(b.cases(spark, sf)))


@query("yoy_growth_nofirst", f"""WITH {_GROWTH}
SELECT year, cases, round((cases - prev) * 100.0 / prev, 6) AS growth_pct,
  printf('%.1f%%', (cases - prev) * 100.0 / prev) AS growth_label FROM g
WHERE prev IS NOT NULL""")
def yoy_growth_nofirst(spark, sf):
    return rounded(sm.yearly_growth(b.cases(spark, sf), keep_first=False))


# --- windows, ranks, top-k ----------------------------------------------------------------------


@query("rank_predictions", """
SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank
FROM supplier""")
def rank_predictions(spark, sf):
    s = b.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return od.with_global_row_number(s, [F.desc("s_acctbal"), F.asc("s_suppkey")], "rank")


@query("latest_per_group", f"""WITH {_PANEL}
SELECT {_ROUND_PANEL} FROM panel QUALIFY
  row_number() OVER (PARTITION BY district ORDER BY year DESC) = 1""")
def latest_per_group(spark, sf):
    return rounded(od.latest_per_group(sm.panel(b.cases(spark, sf)), ["district"], "year"))


@query("topn_per_group", "WITH " + b.DIRTY + """, c AS (
  SELECT gender, district, count(*) AS n FROM dirty WHERE district IS NOT NULL
  GROUP BY gender, district)
SELECT gender, district, n, CAST(row_number() OVER (
  PARTITION BY gender ORDER BY n DESC, district) AS INTEGER) AS rank FROM c
QUALIFY rank <= 5""")
def topn_per_group(spark, sf):
    return od.top_n_per_group(b.dirty(spark, sf), "gender", "district", 5)


@query("mode_per_group", """
WITH c AS (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_quantity AS value, n FROM c QUALIFY row_number() OVER (
  PARTITION BY l_returnflag ORDER BY n DESC, l_quantity) = 1""")
def mode_per_group(spark, sf):
    return od.mode_per_group(b.table(spark, sf, "lineitem"), "l_returnflag", "l_quantity")


_FIRST = """ QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY row_id) = 1"""


@query("dedup_first", f"WITH {b.DIRTY} SELECT * FROM dirty{_FIRST}")
def dedup_first(spark, sf):
    return od.dedup_first(b.dirty(spark, sf), ["case_id"], "row_id")


@query("dedup_keep_null_ids", f"""WITH {b.DIRTY}
SELECT row_id, case_id FROM dirty WHERE case_id IS NULL UNION ALL
SELECT row_id, case_id FROM (SELECT * FROM dirty WHERE case_id IS NOT NULL{_FIRST})""")
def dedup_keep_null_ids(spark, sf):
    df = b.dirty(spark, sf).select("row_id", "case_id")
    return od.dedup_first(df, ["case_id"], "row_id", null_key="distinct")


@query("dedup_whole_row", """
SELECT min(l_orderkey * 10 + l_linenumber) AS row_id, l_partkey, l_quantity, l_returnflag
FROM lineitem GROUP BY l_partkey, l_quantity, l_returnflag""")
def dedup_whole_row(spark, sf):
    df = b.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        "l_partkey", "l_quantity", "l_returnflag",
    )
    return od.dedup_first(df, None, "row_id")


@query("sort_multi", "WITH " + b.CASES + """, p AS (
  SELECT district, year, count(*) AS n FROM cases GROUP BY district, year)
SELECT *, row_number() OVER (ORDER BY district, year) AS position FROM p""")
def sort_multi(spark, sf):
    p = b.cases(spark, sf).groupBy("district", "year").agg(F.count(F.lit(1)).alias("n"))
    return od.with_global_row_number(p, ["district", "year"], "position")


@query("sort_desc", "WITH " + b.GAPPY + """
SELECT row_id, reported_date, row_number() OVER (ORDER BY reported_date NULLS LAST, row_id)
  AS position FROM gappy""")
def sort_desc(spark, sf):
    df = b.gappy(spark, sf).select("row_id", "reported_date")
    return od.with_global_row_number(df, [F.asc_nulls_last("reported_date"), "row_id"], "position")


@query("topn_hotspots", f"""WITH {_LAG}
SELECT district || ':' || year AS place, case_count, prev_count FROM lagged
WHERE prev_count IS NOT NULL ORDER BY case_count DESC, place LIMIT 10""")
def topn_hotspots(spark, sf):
    frame = sm.lag_previous(sm.panel(b.cases(spark, sf))).select(
        F.concat("district", F.lit(":"), "year").alias("place"), "case_count", "prev_count"
    )
    return od.top_n(frame, "case_count", 10, "place")


@query("top_locations", "WITH " + b.CASES + """, c AS (
  SELECT district, count(*) AS n FROM cases GROUP BY district)
SELECT district, n, greatest((SELECT count(*) FROM c) - 15, 0) AS remaining FROM c
ORDER BY n DESC, district LIMIT 15""")
def top_locations(spark, sf):
    return od.top_values_with_rest(b.cases(spark, sf), "district", 15)


@query("preview", "WITH " + b.CASES + " SELECT * FROM cases ORDER BY row_id LIMIT 10")
def preview(spark, sf):
    return b.cases(spark, sf).orderBy("row_id").limit(10)


@query("top_risk", "WITH " + b.CASES + """
SELECT district, count(*) AS n FROM cases GROUP BY district ORDER BY n DESC, district LIMIT 1""")
def top_risk(spark, sf):
    return od.top_values(b.cases(spark, sf), "district", 1)


# --- sets, codes -------------------------------------------------------------------------------


@query("union_train_test", "WITH " + b.CASES + """
SELECT district, year, case_id FROM cases WHERE year <= 2000""")
def union_train_test(spark, sf):
    c = b.cases(spark, sf).select("district", "year", "case_id")
    return c.filter(F.col("year") < 2000).unionByName(c.filter(F.col("year") == 2000))


@query("union_distinct_keys", "WITH " + b.DIRTY + """
SELECT DISTINCT district FROM dirty""")
def union_distinct_keys(spark, sf):
    d = b.dirty(spark, sf)
    known = d.filter(F.col("gender").isNotNull()).select("district")
    return known.union(d.filter(F.col("gender").isNull()).select("district")).distinct()


@query("distinct_sorted", "WITH " + b.CASES + """
SELECT DISTINCT year FROM cases""")
def distinct_sorted(spark, sf):
    return b.cases(spark, sf).select("year").distinct().orderBy("year")


@query("label_encode", "WITH " + b.DIRTY + """, f AS (
  SELECT row_id, coalesce(gender, 'Unknown') AS gender,
         coalesce(district, 'Unknown') AS district FROM dirty)
SELECT *, CAST(dense_rank() OVER (ORDER BY gender) - 1 AS INTEGER) AS gender_code,
  CAST(dense_rank() OVER (ORDER BY district) - 1 AS INTEGER) AS district_code FROM f""")
def label_encode(spark, sf):
    df = b.dirty(spark, sf).select("row_id", "gender", "district")
    return od.label_encode(df, ["gender", "district"])
