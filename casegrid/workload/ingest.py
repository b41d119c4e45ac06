"""Scans, sinks, schema checks and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import coalesce_key, fill_missing_id, fill_year, round_even
from ..operators import gazetteer as gz
from ..operators import quality as q
from ..operators.layers import prediction_change
from ..operators.ordering import surrogate_id, with_global_row_number
from ..operators.summaries import panel
from ..session import scratch_path
from ..sources import readers, schemas, writers
from . import bindings as b
from .registry import query, rounded

_FILE_NAMES = {
    "case_id": "Person ID", "gender": "Gender", "age": "Age",
    "reported_date": "Date Reported Missing", "reported_time": "Time Reported Missing",
    "location_text": "Location last seen", "latitude": "Latitude", "longitude": "Longitude",
    "district": "Barangay District",
}


def _case_file(spark, sf):
    """The dirty cases written as a raw case file."""
    path = scratch_path(spark, "cases-csv")
    raw = b.dirty(spark, sf).select(
        *[F.col(c).alias(n) for c, n in _FILE_NAMES.items()],
        F.concat(F.lit('say "hi", '), F.col("row_id")).alias("Post URL"),
    )
    writers.write_csv(raw, path, list(schemas.RAW_CASE_COLUMNS))
    return path


_SCAN_SQL = "WITH " + b.DIRTY + """
SELECT case_id, gender, age, reported_date, reported_time, location_text, latitude,
       longitude, district, 'say "hi", ' || row_id AS post_url FROM dirty"""


@query("scan_cases_csv", _SCAN_SQL)
def scan_cases_csv(spark, sf):
    return readers.read_cases(spark, _case_file(spark, sf)).drop("row_id")


@query("scan_cases_order", "WITH " + b.DIRTY + """
SELECT row_number() OVER (ORDER BY row_id % 3 <> 0, row_id) AS place,
  'say "hi", ' || row_id AS post_url, location_text FROM dirty""")
def scan_cases_order(spark, sf):
    """Row ids over two folders of unequal size: the order of files and lines."""
    path = scratch_path(spark, "cases-in-order")
    raw = b.dirty(spark, sf).select(
        *[F.col(c).alias(n) for c, n in _FILE_NAMES.items()],
        F.concat(F.lit('say "hi", '), F.col("row_id")).alias("Post URL"), "row_id",
    )
    for folder, rows in (("a", raw.filter("row_id % 3 = 0")), ("b", raw.filter("row_id % 3 <> 0"))):
        writers.write_csv(
            rows.orderBy("row_id").drop("row_id"), f"{path}/{folder}", list(schemas.RAW_CASE_COLUMNS)
        )
    found = readers.read_cases(spark, f"{path}/*").select("row_id", "post_url", "location_text")
    return with_global_row_number(found, ["row_id"], "place").drop("row_id")


@query("load_validate", "WITH " + b.DIRTY + """, c AS (
  SELECT TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon FROM dirty),
 bad AS (SELECT count(*) FILTER (lat < 14 OR lat > 15 OR lon < 120.5 OR lon > 121.5) AS n FROM c)
SELECT 'schema' AS "check", true AS ok, CAST(NULL AS VARCHAR) AS detail
UNION ALL
SELECT 'coordinates', n = 0, CASE WHEN n > 0 THEN n || ' outside bounds' END FROM bad""")
def load_validate(spark, sf):
    _, report = readers.load_and_validate(spark, _case_file(spark, sf))
    return report


@query("sink_roundtrip", "WITH " + b.GAPPY + """
SELECT row_id, case_id, age, gender, reported_date, latitude, longitude, district FROM gappy""")
def sink_roundtrip(spark, sf):
    columns = ["row_id", "case_id", "age", "gender", "reported_date", "latitude",
               "longitude", "district"]
    path = scratch_path(spark, "cleaned-csv")
    df = b.gappy(spark, sf)
    writers.write_csv(df, path, columns)
    return readers.read_csv(spark, path, df.select(*columns).schema)


@query("parquet_sink_by_year", "WITH " + b.CASES + """
SELECT case_id, district, CAST(year AS INTEGER) AS year FROM cases WHERE year = 1997""")
def parquet_sink_by_year(spark, sf):
    path = scratch_path(spark, "cleaned-parquet")
    writers.write_parquet(b.cases(spark, sf), path, ["year"])
    kept = spark.read.parquet(path).filter(F.col("year") == 1997)
    return kept.select("case_id", "district", "year")


@query("metrics_json", "WITH " + b.CASES + """
SELECT '{"dataset":{"records":' || count(*) || ',"first_year":' || min(year) ||
       ',"last_year":' || max(year) || '},"places":{"districts":' ||
       count(DISTINCT district) || '}}' AS document FROM cases""")
def metrics_json(spark, sf):
    stats = b.cases(spark, sf).agg(
        F.count(F.lit(1)).alias("records"), F.min("year").alias("first_year"),
        F.max("year").alias("last_year"), F.count_distinct("district").alias("districts"),
    )
    path = scratch_path(spark, "metrics-json")
    document = writers.metric_document(
        stats, dataset=["records", "first_year", "last_year"], places=["districts"]
    )
    document.write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "document")


@query("scan_predictions_csv", "WITH " + b.CASES + """
SELECT district, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
       CAST(count(*) AS DOUBLE) AS predicted_cases,
       CAST(count(*) FILTER (year = 2000) AS DOUBLE) AS prev_count
FROM cases GROUP BY district""")
def scan_predictions_csv(spark, sf):
    out = b.cases(spark, sf).groupBy(F.col("district").alias("Barangay District")).agg(
        F.round(F.avg("latitude"), 6).alias("Latitude"),
        F.round(F.avg("longitude"), 6).alias("Longitude"),
        F.count(F.lit(1)).cast("double").alias("Predicted_Cases"),
        F.count_if(F.col("year") == 2000).cast("double").alias("Prev_Year_Count"),
    )
    path = scratch_path(spark, "predictions-csv")
    writers.write_csv(out, path)
    return readers.read_predictions(spark, path)


@query("valid_coord_export", "WITH " + b.GAPPY + """
SELECT row_id, latitude, longitude FROM gappy
WHERE latitude IS NOT NULL AND longitude IS NOT NULL""")
def valid_coord_export(spark, sf):
    path = scratch_path(spark, "located-csv")
    located = writers.complete_coordinates(b.gappy(spark, sf))
    writers.write_csv(located, path, ["row_id", "latitude", "longitude"])
    return readers.read_csv(spark, path, "row_id bigint, latitude double, longitude double")


@query("schema_check", """
SELECT c AS column_name, c <> 'post_url' AS present,
       CASE WHEN c <> 'post_url' THEN 'string' END AS data_type,
       (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey
                                    JOIN nation ON c_nationkey = n_nationkey) AS n_rows
FROM (SELECT unnest(['case_id', 'gender', 'age', 'reported_date', 'reported_time',
  'location_text', 'latitude', 'longitude', 'district', 'post_url']) AS c)""")
def schema_check(spark, sf):
    df = b.dirty(spark, sf)
    rows = df.agg(F.count(F.lit(1))).scalar()
    return q.schema_check(df, schemas.CANONICAL_REQUIRED).withColumn("n_rows", rows)


# --- nested places -----------------------------------------------------------------

@query("gazetteer_flatten", """
SELECT s_suppkey AS city_pos, s_name AS city, CAST(p AS INTEGER) AS district_pos,
       CASE p WHEN 0 THEN n_name ELSE 'Harbor' END AS district,
       CASE p WHEN 0 THEN s_acctbal ELSE s_acctbal / 2 END AS latitude,
       CASE p WHEN 0 THEN s_acctbal + 1 ELSE s_acctbal / 4 END AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey,
     (SELECT unnest([0, 1]) AS p)""")
def gazetteer_flatten(spark, sf):
    path = scratch_path(spark, "gazetteer-json")
    b.supplier_gazetteer(spark, sf).write.json(path)
    back = spark.read.schema(b.supplier_gazetteer(spark, sf).schema).json(path)
    return gz.flatten_districts(back).select(
        "city_pos", "city", "district_pos", "district",
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
    )


@query("gazetteer_file", """
SELECT dense_rank() OVER (ORDER BY r_regionkey) - 1 AS city_pos, r_name AS city,
  row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) - 1 AS district_pos,
  n_name AS district, 'zone ' || n_nationkey AS barangay_range,
  CAST(n_nationkey + 0.5 AS DOUBLE) AS latitude, CAST(n_nationkey + 100.5 AS DOUBLE) AS longitude
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def gazetteer_file(spark, sf):
    """A nested place file: one JSON array with the regions, a handful of rows."""
    path = scratch_path(spark, "gazetteer-file")
    places = b.region_gazetteer(spark, sf)
    entry = F.struct("city_pos", *[c for c in places.columns if c != "city_pos"])
    whole = places.agg(F.array_sort(F.collect_list(entry)).alias("a"))
    bare = F.transform("a", lambda e: e.dropFields("city_pos"))
    whole.select(F.to_json(bare).alias("value")).write.text(path)
    found = gz.flatten_districts(readers.read_gazetteer(spark, path))
    return found.select(
        F.col("city_pos").cast("long"), "city", F.col("district_pos").cast("long"), "district",
        "barangay_range", F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
    )


@query("gazetteer_districts", """
SELECT n_name AS district, s_acctbal AS latitude, s_acctbal + 1 AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_name = 'Supplier#000000007'
UNION ALL
SELECT 'Harbor', s_acctbal / 2, s_acctbal / 4
FROM supplier WHERE s_name = 'Supplier#000000007'""")
def gazetteer_districts(spark, sf):
    return gz.district_coordinates(b.supplier_gazetteer(spark, sf), "Supplier#000000007")


_UNITS = """units AS (
  SELECT s_suppkey AS city_pos, s_name AS city, n_name AS district,
         'Barangay ' || (s_suppkey + i) AS barangay, s_acctbal AS latitude,
         s_acctbal + 1 AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey, (SELECT unnest([0, 1, 2]) AS i)
  UNION ALL
  SELECT s_suppkey, s_name, n_name, 'Barangay ' || (s_suppkey + 7) || '-A', s_acctbal,
         s_acctbal + 1
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT s_suppkey, s_name, n_name, 'Old Town ' || (s_suppkey % 5), s_acctbal, s_acctbal + 1
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT s_suppkey, s_name, 'Harbor', 'Barangays 1-' || (s_suppkey % 4 + 2), 1.5,
         CAST(s_suppkey AS DOUBLE) FROM supplier
  UNION ALL
  SELECT s_suppkey, s_name, 'Harbor', 'Pier', s_acctbal / 2, s_acctbal / 4 FROM supplier)"""


@query("explode_nested", "WITH " + _UNITS + " SELECT * FROM units")
def explode_nested(spark, sf):
    return gz.flatten_units(b.supplier_gazetteer(spark, sf)).select(
        "city_pos", "city", "district", "barangay", "latitude", "longitude"
    )


@query("expand_ranges", """
SELECT p_partkey, 'Barangay ' || (p_partkey + i) AS unit
FROM part, (SELECT unnest(range(0, 6)) AS i) WHERE i <= p_size % 6
UNION ALL SELECT p_partkey, 'Barangay ' || p_size || '-B' FROM part
UNION ALL SELECT p_partkey, 'Barangay ' || (p_size + 60) FROM part""")
def expand_ranges(spark, sf):
    part = b.table(spark, sf, "part")
    k, n = F.col("p_partkey"), F.col("p_size")
    text = F.concat(
        F.lit("Barangays "), k, F.lit(" to "), k + n % 6, F.lit(" & "), n, F.lit("-b, "),
        F.col("p_name"), F.lit(" and  brgy. "), n + 60,
    )
    return part.select("p_partkey", F.explode(gz.expand_ranges(text)).alias("unit"))


_N = b.norm_sql


@query("alias_table", "WITH " + _UNITS + f""", num AS (
  SELECT *, trim(replace(barangay, 'Barangay', '')) AS number FROM units),
 forms AS (
  SELECT 'city' AS level, s_name AS city, CAST(NULL AS VARCHAR) AS district,
         CAST(NULL AS VARCHAR) AS barangay, unnest([s_name, 'city of ' || s_name,
         s_name || ' city']) AS form FROM supplier
  UNION ALL
  SELECT 'district', s_name, n_name, NULL, unnest([n_name, n_name || ' ' || s_name,
         s_name || ' ' || n_name, 'Zone ' || (s_suppkey % 9)])
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT 'district', s_name, 'Harbor', NULL, unnest(['Harbor', 'Harbor ' || s_name,
         s_name || ' Harbor']) FROM supplier
  UNION ALL
  SELECT 'barangay', city, district, barangay, unnest([barangay,
         barangay || ' ' || district, barangay || ' ' || city, 'barangay ' || number, number,
         number || ' ' || district, number || ' ' || city]) FROM num)
SELECT DISTINCT level, city, district, barangay, {_N('form')} AS alias FROM forms""")
def alias_table(spark, sf):
    return gz.alias_table(b.supplier_gazetteer(spark, sf)).select(
        "level", "city", "district", "barangay", "alias"
    )


# --- projections -------------------------------------------------------------------

@query("project_drop", "WITH " + b.CASES + """
SELECT * EXCLUDE (latitude, longitude) FROM cases""")
def project_drop(spark, sf):
    return b.cases(spark, sf).drop("latitude", "longitude")


@query("project_select", "WITH " + b.CASES + """
SELECT district, year, case_id FROM cases""")
def project_select(spark, sf):
    return b.cases(spark, sf).select("district", "year", "case_id")


@query("project_rename", "WITH " + b.DIRTY + """
SELECT case_id, age, gender, latitude FROM dirty""")
def project_rename(spark, sf):
    extract = b.dirty(spark, sf).select(
        F.col("case_id").alias("Person ID"), F.col("age").alias("AGE"),
        F.col("gender").alias("GENDER"), F.col("latitude").alias("Latitude"),
    )
    return readers.canonical(extract)


@query("surrogate_id", "WITH " + b.GAPPY + """
SELECT printf('MP-%04d', row_number() OVER (ORDER BY row_id)) AS person_id, row_id
FROM gappy WHERE reported_date IS NOT NULL""")
def surrogate_ids(spark, sf):
    kept = b.gappy(spark, sf).filter(F.col("reported_date").isNotNull())
    return surrogate_id(kept.select("row_id"), ["row_id"])


@query("fill_unknown_id", "WITH " + b.DIRTY + """
SELECT row_id, coalesce(case_id, printf('UNK-%04d', row_id)) AS case_id FROM dirty""")
def fill_unknown_id(spark, sf):
    return b.dirty(spark, sf).select("row_id", fill_missing_id("case_id", "row_id").alias("case_id"))


@query("coalesce_key", "WITH " + b.DIRTY + """
SELECT row_id, trim(coalesce(district, CASE WHEN row_id % 3 = 0 THEN ' ' || location_text END,
       'Unknown')) AS district_key FROM dirty""")
def coalesce_key_query(spark, sf):
    unit = F.when(F.col("row_id") % 3 == 0, F.concat(F.lit(" "), F.col("location_text")))
    return b.dirty(spark, sf).select("row_id", coalesce_key("district", unit).alias("district_key"))


@query("fill_year", "WITH " + b.GAPPY + """
SELECT row_id, CAST(coalesce(CASE WHEN row_id % 4 = 0 THEN 1990 END, year(reported_date))
       AS INTEGER) AS year FROM gappy""")
def fill_year_query(spark, sf):
    given = F.when(F.col("row_id") % 4 == 0, F.lit(1990))
    return b.gappy(spark, sf).select(
        "row_id", fill_year(given, "reported_date").alias("year")
    )


@query("round_display", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round_even(l_extendedprice / 8 * 100, 0) / 100 AS price_2,
       round_even(l_quantity * l_discount / 7 * 1000000, 0) / 1000000 AS quantity_6 FROM lineitem""")
def round_display(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        round_even(F.col("l_extendedprice") / 8, 2).alias("price_2"),
        round_even(F.col("l_quantity") * F.col("l_discount") / 7, 6).alias("quantity_6"),
    )


_PRED = b.CASES + """, pred AS (
  SELECT district, year, count(*) AS n,
         count(*) FILTER (month < 7) AS prev_count FROM cases GROUP BY district, year)"""


@query("pred_change_table", "WITH " + _PRED + """
SELECT district, year, prev_count, n / 7.0 AS predicted_cases,
       round(round_even(n / 7.0 * 100, 0) / 100 - prev_count, 6) AS change_cases,
       CASE WHEN prev_count <> 0 THEN
         round_even((round_even(n / 7.0 * 100, 0) / 100 - prev_count) * 100.0 / prev_count * 10, 0) / 10 END
         AS change_pct,
       CASE WHEN n / 7.0 - prev_count > 1 THEN 'red' WHEN n / 7.0 - prev_count > 0 THEN 'orange'
            WHEN n / 7.0 - prev_count < -1 THEN 'green' ELSE 'blue' END AS color
FROM pred""")
def pred_change_table(spark, sf):
    df = b.cases(spark, sf).groupBy("district", "year").agg(
        (F.count(F.lit(1)) / F.lit(7.0)).alias("predicted_cases"),
        F.count_if(F.col("month") < 7).alias("prev_count"),
    )
    return rounded(prediction_change(df), 6, "change_cases")


@query("panel_partitions", "WITH " + b.CASES + """
SELECT district, year, count(case_id) AS case_count FROM cases
WHERE year BETWEEN 1996 AND 1998 GROUP BY district, year""")
def panel_partitions(spark, sf):
    """Panel from a year-partitioned table: only three partitions are read."""
    path = scratch_path(spark, "cases-by-year")
    writers.write_parquet(b.cases(spark, sf), path, ["year"])
    kept = spark.read.parquet(path).filter(F.col("year").between(1996, 1998))
    return panel(kept).select("district", "year", "case_count")
