"""The given tables seen as cases, points and places, in Spark and in SQL.

cases   orders with their customer and nation: id and row order are the order
        key, the place is the nation, gender the market segment, age the
        customer key modulo 103, the position (account balance, order price)
dirty   the same rows as a raw file would hold them: text dates in two
        notations, text times, words among the ages, missing markers, NULLs
points  two components of the embeddings with their label
places  place texts of the customers; a region is a city, a nation a district
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


# --- cases -----------------------------------------------------------------------

def cases(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("o_orderkey").alias("row_id"),
            F.col("o_orderkey").alias("case_id"),
            F.col("o_custkey").alias("person"),
            F.col("o_orderdate").cast("date").alias("reported_date"),
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            F.col("n_name").alias("district"),
            F.col("c_mktsegment").alias("gender"),
            (F.col("o_custkey") % 103).cast("double").alias("age"),
            F.col("c_acctbal").alias("latitude"),
            F.col("o_totalprice").alias("longitude"),
        )
    )


CASES = """cases AS (
  SELECT o_orderkey AS row_id, o_orderkey AS case_id, o_custkey AS person,
         CAST(o_orderdate AS DATE) AS reported_date,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         n_name AS district, c_mktsegment AS gender,
         CAST(o_custkey % 103 AS DOUBLE) AS age,
         c_acctbal AS latitude, o_totalprice AS longitude
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey)"""


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Cases as text, the way a raw file holds them."""
    p, r = F.col("person"), F.col("row_id")
    d, m, y = F.dayofmonth("reported_date"), F.col("month"), F.col("year")
    minute = F.lpad((r % 60).cast("string"), 2, "0")
    h24 = r % 24
    h12 = F.when(h24 % 12 == 0, 12).otherwise(h24 % 12)
    age = (p % 103).cast("string")
    return cases(spark, sf).select(
        "row_id",
        F.when(p % 50 != 0, p).cast("string").alias("case_id"),
        F.when(p % 17 == 0, "na").when(p % 17 == 1, " Adult ").when(p % 17 == 2, "teen")
        .when(p % 17 == 3, "Senior").when(p % 17 == 4, None)
        .when(p % 17 == 5, F.concat(age, F.lit(".5"))).when(p % 17 == 6, "young adult")
        .otherwise(age).alias("age"),
        F.when(p % 13 == 0, None).when(p % 13 == 1, "na")
        .otherwise(F.concat(F.lit("  "), F.lower("gender"), F.lit(" "))).alias("gender"),
        F.when(r % 23 == 0, "na").when(r % 23 == 1, None)
        .when(r % 9 == 0, F.concat_ws("/", d, m, y))
        .otherwise(F.concat_ws("/", m, d, y)).alias("reported_date"),
        F.when(r % 19 == 0, "na").when(r % 19 == 1, None)
        .when(r % 2 == 0, F.concat(h24.cast("string"), F.lit(":"), minute))
        .otherwise(
            F.concat(
                h12.cast("string"), F.lit(":"), minute,
                F.when(h24 < 12, " AM").otherwise(" PM"),
            )
        ).alias("reported_time"),
        F.when(r % 29 == 0, "n.a.").when(r % 31 == 0, None)
        .otherwise(
            F.concat((13 + p % 3).cast("string"), F.lit("."),
                     F.lpad((p % 1000).cast("string"), 3, "0"))
        ).alias("latitude"),
        F.when(r % 41 == 0, None)
        .otherwise(
            F.concat((120 + p % 2).cast("string"), F.lit("."),
                     F.lpad((r % 1000).cast("string"), 3, "0"))
        ).alias("longitude"),
        F.when(r % 37 != 0, F.col("district")).alias("district"),
        F.concat(F.lit("Street "), (p % 100).cast("string"), F.lit(", "), F.col("district"))
        .alias("location_text"),
    )


DIRTY = CASES + """, dirty AS (
  SELECT row_id,
    CASE WHEN person % 50 <> 0 THEN CAST(person AS VARCHAR) END AS case_id,
    CASE WHEN person % 17 = 0 THEN 'na' WHEN person % 17 = 1 THEN ' Adult '
         WHEN person % 17 = 2 THEN 'teen' WHEN person % 17 = 3 THEN 'Senior'
         WHEN person % 17 = 4 THEN NULL
         WHEN person % 17 = 5 THEN CAST(person % 103 AS VARCHAR) || '.5'
         WHEN person % 17 = 6 THEN 'young adult'
         ELSE CAST(person % 103 AS VARCHAR) END AS age,
    CASE WHEN person % 13 = 0 THEN NULL WHEN person % 13 = 1 THEN 'na'
         ELSE '  ' || lower(gender) || ' ' END AS gender,
    CASE WHEN row_id % 23 = 0 THEN 'na' WHEN row_id % 23 = 1 THEN NULL
         WHEN row_id % 9 = 0 THEN day(reported_date) || '/' || month || '/' || year
         ELSE month || '/' || day(reported_date) || '/' || year END AS reported_date,
    CASE WHEN row_id % 19 = 0 THEN 'na' WHEN row_id % 19 = 1 THEN NULL
         WHEN row_id % 2 = 0
           THEN (row_id % 24) || ':' || lpad(CAST(row_id % 60 AS VARCHAR), 2, '0')
         ELSE (CASE WHEN row_id % 12 = 0 THEN 12 ELSE row_id % 12 END) || ':' ||
              lpad(CAST(row_id % 60 AS VARCHAR), 2, '0') ||
              CASE WHEN row_id % 24 < 12 THEN ' AM' ELSE ' PM' END END AS reported_time,
    CASE WHEN row_id % 29 = 0 THEN 'n.a.' WHEN row_id % 31 = 0 THEN NULL
         ELSE (13 + person % 3) || '.' || lpad(CAST(person % 1000 AS VARCHAR), 3, '0')
         END AS latitude,
    CASE WHEN row_id % 41 = 0 THEN NULL
         ELSE (120 + person % 2) || '.' || lpad(CAST(row_id % 1000 AS VARCHAR), 3, '0')
         END AS longitude,
    CASE WHEN row_id % 37 <> 0 THEN district END AS district,
    'Street ' || (person % 100) || ', ' || district AS location_text
  FROM cases)"""


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty cases with typed numbers and dates; the gaps are NULLs."""
    from ..functions.values import coerce_numeric, parse_date_robust

    return dirty(spark, sf).withColumns(
        {
            "age": coerce_numeric("age"),
            "latitude": coerce_numeric("latitude"),
            "longitude": coerce_numeric("longitude"),
            "reported_date": parse_date_robust("reported_date"),
        }
    )


MONTH_FIRST = "CAST(try_strptime(reported_date, '%m/%d/%Y') AS DATE)"
EITHER_FIRST = (
    "CAST(coalesce(try_strptime(reported_date, '%m/%d/%Y'), "
    "try_strptime(reported_date, '%d/%m/%Y')) AS DATE)"
)
GAPPY = DIRTY + f""", gappy AS (
  SELECT row_id, case_id, TRY_CAST(age AS DOUBLE) AS age, gender,
         {EITHER_FIRST} AS reported_date, reported_time,
         TRY_CAST(latitude AS DOUBLE) AS latitude,
         TRY_CAST(longitude AS DOUBLE) AS longitude, district, location_text
  FROM dirty)"""


# --- points ----------------------------------------------------------------------

def points(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled points in the plane; label 9 counts as noise."""
    e = table(spark, sf, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding")[0].cast("double").alias("latitude"),
        F.col("embedding")[1].cast("double").alias("longitude"),
        F.when(F.col("label") == 9, -1).otherwise(F.col("label")).cast("bigint").alias("cluster"),
        F.concat(F.lit("G"), (F.col("vec_id") % 3).cast("string")).alias("gender"),
        F.concat(F.lit("A"), (F.col("vec_id") % 4).cast("string"), F.lit(" (x)"))
        .alias("age_group"),
        F.concat(F.lit("P"), (F.col("vec_id") % 7).cast("string")).alias("district"),
        (F.col("vec_id") % 80).cast("double").alias("age"),
    )


POINTS = """points AS (
  SELECT vec_id AS row_id, CAST(embedding[1] AS DOUBLE) AS latitude,
         CAST(embedding[2] AS DOUBLE) AS longitude,
         CAST(CASE WHEN label = 9 THEN -1 ELSE label END AS BIGINT) AS cluster,
         'G' || (vec_id % 3) AS gender, 'A' || (vec_id % 4) || ' (x)' AS age_group,
         'P' || (vec_id % 7) AS district, CAST(vec_id % 80 AS DOUBLE) AS age
  FROM embeddings)"""

# --- places ----------------------------------------------------------------------

HOME_CITY = "ASIA"
HOME_KEYWORDS = (("nation 2", "NATION_2"), ("nation 17", "NATION_17"))
HOME_VENUES = (
    {
        "aliases": ("building street7", "machinery street3"), "city": "ASIA", "district": "NATION_9",
        "latitude": 14.5, "longitude": 120.5, "level": "barangay", "score": 1.0,
    },
    {
        "aliases": ("furniture street1",), "city": "EUROPE", "district": None,
        "latitude": 1.25, "longitude": 2.5, "level": "city", "score": 0.99,
    },
)


def place_texts(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    k = F.col("c_custkey")
    full = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return full.select(
        k.alias("row_id"),
        F.when(k % 7 == 0, F.concat_ws(", ", "c_name", "n_name", "r_name"))
        .when(k % 7 == 1, F.concat(F.lit("Brgy. "), k % 300, F.lit(", "), F.col("n_name")))
        .when(k % 7 == 2, F.concat(F.lit("near "), F.translate("r_name", "AI", "ei")))
        .when(k % 7 == 3, "na")
        .when(k % 7 == 4, F.concat(F.col("c_mktsegment"), F.lit(" street"), k % 40))
        .when(k % 7 == 5, F.concat(F.initcap("r_name"), F.lit(" City")))
        .otherwise(F.concat(F.lit("Unit "), k % 90, F.lit(", Asía")))
        .alias("location_text"),
    )


PLACE_TEXTS = """place_texts AS (
  SELECT c_custkey AS row_id,
    CASE c_custkey % 7
      WHEN 0 THEN c_name || ', ' || n_name || ', ' || r_name
      WHEN 1 THEN 'Brgy. ' || (c_custkey % 300) || ', ' || n_name
      WHEN 2 THEN 'near ' || translate(r_name, 'AI', 'ei')
      WHEN 3 THEN 'na'
      WHEN 4 THEN c_mktsegment || ' street' || (c_custkey % 40)
      WHEN 5 THEN array_to_string(list_transform(string_split(lower(r_name), ' '),
                    lambda w: upper(w[1]) || w[2:]), ' ') || ' City'
      ELSE 'Unit ' || (c_custkey % 90) || ', Asía' END AS location_text
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""


def norm_sql(x: str) -> str:
    """SQL spelling of the text normalisation."""
    x = f"lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g'))"
    x = f"regexp_replace({x}, '\\bsta\\.?\\b', 'santa', 'g')"
    x = f"regexp_replace({x}, '\\bmla\\b', 'manila', 'g')"
    x = f"regexp_replace({x}, '[^0-9a-z]+', ' ', 'g')"
    return f"trim(replace(replace({x}, 'brgy', 'barangay'), 'barangays', 'barangay'))"


_POINT = "struct<latitude:double,longitude:double>"


def region_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as cities, their nations as districts, ten numbered units each.

    Regions and nations are small fixed tables, so one array holds a region.
    """
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    lo = F.col("n_nationkey") * 10 + 1
    district = F.struct(
        F.col("n_nationkey").alias("_k"),
        F.col("n_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("zone "), F.col("n_nationkey")).alias("barangay_range"),
        F.struct(
            (F.col("n_nationkey") + 0.5).alias("latitude"),
            (F.col("n_nationkey") + 100.5).alias("longitude"),
        ).alias("coordinates"),
        F.array(F.concat(F.lit("Barangays "), lo, F.lit("-"), lo + 9)).alias("barangays"),
        F.lit(None).cast(f"array<struct<name:string,coordinates:{_POINT}>>")
        .alias("barangay_list"),
    )
    nested = nation.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(district)).alias("d"))
    return region.join(nested, region.r_regionkey == nested.n_regionkey).select(
        F.col("r_regionkey").alias("city_pos"),
        F.col("r_name").alias("city"),
        F.struct(
            F.col("r_regionkey").cast("double").alias("latitude"),
            (F.col("r_regionkey") + 100.0).alias("longitude"),
        ).alias("coordinates"),
        F.transform("d", lambda x: x.dropFields("_k")).alias("districts"),
    )


def _sql_text(value) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


#: Columns of a matched place of `q.location_text` beside the rows q themselves.
MATCHED = f"""CASE WHEN m.city IS NULL THEN 'Other/Unknown'
    WHEN lower(m.city) = '{HOME_CITY.lower()}' THEN '{HOME_CITY} City' ELSE m.city END AS city,
  m.barangay, m.latitude, m.longitude, coalesce(m.level, 'none') AS level, m.score"""


def edit_match_sql(rows: str, with_sql: str) -> str:
    """SQL of the place matcher by edit distance over `rows` (row_id, location_text, ...)."""
    return edit_match_tables(rows, with_sql) + f"""
SELECT q.*, m.district, {MATCHED} FROM {rows} q LEFT JOIN m ON m.raw = q.location_text"""


def edit_match_tables(rows: str, with_sql: str) -> str:
    """The matched places m (raw, ...): all texts against all aliases, the rules as one CASE."""
    ordinal = "printf('%d-%012d-%06d-%06d', {}, r_regionkey, {}, {})"
    home = HOME_CITY.lower()
    words = [w for w, _ in HOME_KEYWORDS]
    rules = ", ".join(f"({i}, '{w}', '{d.lower()}')" for i, (w, d) in enumerate(HOME_KEYWORDS))
    venue = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains(norm, '{a}')" for a in v["aliases"]) + f" THEN {i}"
        for i, v in enumerate(HOME_VENUES)
    ) + " END"
    venues = " UNION ALL ".join(
        f"SELECT {i} AS venue, {_sql_text(v['city'])} AS city, {_sql_text(v['district'])} AS district, "
        f"CAST({v['latitude']} AS DOUBLE) AS latitude, CAST({v['longitude']} AS DOUBLE) AS longitude, "
        f"{_sql_text(v['level'])} AS level, CAST({v['score']} AS DOUBLE) AS score"
        for i, v in enumerate(HOME_VENUES)
    )
    return f"""WITH {with_sql},
 nat AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS dpos
         FROM nation JOIN region ON n_regionkey = r_regionkey),
 forms AS (
  SELECT {ordinal.format(2, 0, 0)} AS ordinal, 'city' AS level, r_name AS city, CAST(NULL AS VARCHAR) AS district,
    CAST(NULL AS VARCHAR) AS barangay, CAST(r_regionkey AS DOUBLE) AS latitude,
    CAST(r_regionkey + 100 AS DOUBLE) AS longitude,
    unnest([r_name, 'city of ' || r_name, r_name || ' city']) AS form
  FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
  UNION ALL
  SELECT {ordinal.format(1, "dpos", 0)}, 'district', r_name, n_name, NULL,
    n_nationkey + CAST(0.5 AS DOUBLE), n_nationkey + CAST(100.5 AS DOUBLE),
    unnest([n_name, n_name || ' ' || r_name, r_name || ' ' || n_name, 'zone ' || n_nationkey]) FROM nat
  UNION ALL
  SELECT {ordinal.format(0, "dpos", "upos")}, 'barangay', r_name, n_name, 'Barangay ' || u,
    n_nationkey + CAST(0.5 AS DOUBLE), n_nationkey + CAST(100.5 AS DOUBLE),
    unnest(['barangay ' || u, 'barangay ' || u || ' ' || n_name, 'barangay ' || u || ' ' || r_name,
            '' || u, u || ' ' || n_name, u || ' ' || r_name])
  FROM (SELECT *, n_nationkey * 10 + 1 + upos AS u FROM (SELECT *, unnest(range(10)) AS upos FROM nat))),
 e AS MATERIALIZED (
  SELECT DISTINCT * EXCLUDE (form), {norm_sql('form')} AS alias, lower(city) = '{home}' AS home FROM forms),
 place AS (SELECT DISTINCT ordinal, level, city, district, barangay, latitude, longitude FROM e),
 seg AS (
  SELECT raw, {norm_sql('raw')} AS norm,
    list_filter(list_transform(string_split(raw, ','), lambda x: trim(x)), lambda x: x <> '') AS s
  FROM (SELECT DISTINCT location_text AS raw FROM {rows} WHERE location_text IS NOT NULL)),
 t AS MATERIALIZED (
  SELECT raw, norm, {norm_sql("array_to_string(s[-2:], ' ')")} AS two, {norm_sql("coalesce(s[-1], '')")} AS one,
    contains(norm, '{home}') OR {" OR ".join(f"contains(norm, '{w}')" for w in words)} AS hint,
    {venue} AS venue
  FROM seg WHERE norm <> ''),
 kw AS (
  SELECT raw, arg_min(ordinal, (pos, ordinal)) AS o FROM t
  JOIN (VALUES {rules}) r(pos, word, name) ON contains(norm, word) OR contains(two, word) OR contains(one, word)
  JOIN e ON e.home AND level = 'district' AND lower(district) = name WHERE hint GROUP BY raw),
 r4 AS (
  SELECT raw, min(ordinal) AS o FROM t JOIN e ON e.home AND level = 'district' AND (
    contains(norm, alias) OR two <> '' AND (contains(two, alias) OR contains(alias, two))
    OR one <> '' AND (contains(one, alias) OR contains(alias, one))) WHERE hint GROUP BY raw),
 r5 AS (
  SELECT raw, min(ordinal) AS o FROM t JOIN e ON e.home AND level <> 'city'
    AND (contains(two, alias) OR contains(one, alias)) WHERE hint GROUP BY raw),
 sc AS (
  SELECT raw, level, ordinal, CASE WHEN contains(norm, alias) THEN CAST(1.0 AS DOUBLE)
    ELSE CAST(1.0 AS DOUBLE) - levenshtein(norm, alias) / greatest(length(norm), length(alias)) END AS score
  FROM t JOIN e ON NOT hint OR e.home),
 bl AS (SELECT raw, level, max(score) AS score, arg_min(ordinal, (-score, ordinal)) AS o FROM sc GROUP BY raw, level),
 b AS (
  SELECT raw, max(score) FILTER (level = 'barangay') AS bs, max(o) FILTER (level = 'barangay') AS bo,
    max(score) FILTER (level = 'district') AS ds, max(o) FILTER (level = 'district') AS d_o,
    max(score) FILTER (level = 'city') AS cs, max(o) FILTER (level = 'city') AS co
  FROM bl GROUP BY raw),
 hc AS (SELECT min(ordinal) AS o FROM e WHERE home AND level = 'city'),
 j AS (
  SELECT t.raw, t.venue, CASE
      WHEN kw.o IS NOT NULL THEN {{'o': kw.o, 's': CAST(0.95 AS DOUBLE)}}
      WHEN r4.o IS NOT NULL THEN {{'o': r4.o, 's': CAST(0.9 AS DOUBLE)}}
      WHEN r5.o IS NOT NULL THEN {{'o': r5.o, 's': CAST(0.85 AS DOUBLE)}}
      WHEN bs >= 0.7 THEN {{'o': bo, 's': bs}} WHEN ds >= 0.55 THEN {{'o': d_o, 's': ds}}
      WHEN cs >= 0.55 THEN {{'o': co, 's': cs}}
      WHEN hint THEN {{'o': hc.o, 's': CAST(0.55 AS DOUBLE)}}
      WHEN ds >= 0.4 AND ds >= coalesce(cs, 0) THEN {{'o': d_o, 's': ds}}
      WHEN cs >= 0.4 THEN {{'o': co, 's': cs}} END AS p
  FROM t LEFT JOIN kw USING (raw) LEFT JOIN r4 USING (raw) LEFT JOIN r5 USING (raw) LEFT JOIN b USING (raw), hc),
 m AS (
  SELECT raw, city, district, CAST(NULL AS VARCHAR) AS barangay, latitude, longitude, v.level, v.score
  FROM j JOIN ({venues}) v ON v.venue = j.venue
  UNION ALL
  SELECT raw, city, district, barangay, latitude, longitude, level, round(p.s, 3)
  FROM j JOIN place ON ordinal = p.o WHERE venue IS NULL)"""


def supplier_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Each supplier as a city with two districts and a few units; grows with the table."""
    s, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    k = F.col("s_suppkey")

    def point(lat, lon):
        return F.struct(lat.alias("latitude"), lon.alias("longitude"))

    units = f"array<struct<name:string,coordinates:{_POINT}>>"
    none = F.lit(None)
    first = F.struct(
        F.col("n_name").alias("name"),
        none.cast("string").alias("description"),
        F.concat(F.lit("Zone "), k % 9).alias("barangay_range"),
        point(F.col("s_acctbal"), F.col("s_acctbal") + 1).alias("coordinates"),
        F.array(
            F.concat(F.lit("Barangays "), k, F.lit("-"), k + 2, F.lit(" and "), k + 7,
                     F.lit("-a, North")),
            F.concat(F.lit("Brgy. "), k + 1),
            F.concat(F.lit("Old Town "), k % 5),
        ).alias("barangays"),
        none.cast(units).alias("barangay_list"),
    )
    second = F.struct(
        F.lit("Harbor").alias("name"),
        none.cast("string").alias("description"),
        none.cast("string").alias("barangay_range"),
        none.cast(_POINT).alias("coordinates"),
        none.cast("array<string>").alias("barangays"),
        F.array(
            F.struct(F.concat(F.lit("Barangays 1-"), k % 4 + 2).alias("name"),
                     point(F.lit(1.5), k.cast("double")).alias("coordinates")),
            F.struct(F.lit("Pier").alias("name"), none.cast(_POINT).alias("coordinates")),
        ).alias("barangay_list"),
    )
    return s.join(nation, s.s_nationkey == nation.n_nationkey).select(
        k.alias("city_pos"),
        F.col("s_name").alias("city"),
        point(F.col("s_acctbal") / 2, F.col("s_acctbal") / 4).alias("coordinates"),
        F.array(first, second).alias("districts"),
    )
