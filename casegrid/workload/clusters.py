"""Cluster statistics, quality measures, K-means and DBSCAN."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import cluster_color
from ..operators import cluster_search as cs
from ..operators import clusters as cl
from ..operators import scaling as sc
from ..operators.dbscan import cluster_centers, dbscan, dbscan_grid_labels
from ..operators.kmeans import best_k, certificate, fit_kmeans, k_sweep, label_with_centers
from ..operators.labellings import score_labellings
from ..operators.ordering import top_n_per_group
from ..operators.summaries import category_counts, location_centroid
from ..plans.evaluation import demographic_clusters as demographic_plan
from ..plans.evaluation import evaluate_clustering, long_table
from ..session import scratch_path
from . import bindings as b
from .registry import query, rounded

_XY = ["latitude", "longitude"]
_IN = b.POINTS + ", inp AS (SELECT * FROM points WHERE cluster <> -1)"


def _flat_map(col):
    pairs = F.transform(
        F.array_sort(F.map_entries(col)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.array_join(pairs, ";")


@query("cluster_statistics", f"""WITH {_IN}, g AS (
  SELECT cluster, gender AS k, count(*) AS n FROM inp GROUP BY 1, 2),
 a AS (SELECT cluster, age_group AS k, count(*) AS n FROM inp GROUP BY 1, 2),
 d AS (SELECT cluster, district AS k, count(*) AS n FROM inp GROUP BY 1, 2
       QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, district) = 1)
SELECT i.cluster, count(*) AS size, round(avg(latitude), 6) AS center_lat,
  round(avg(longitude), 6) AS center_lon,
  round(count(*) * 100.0 / (SELECT count(*) FROM points), 6) AS share_pct,
  printf('%.1f%%', count(*) * 100.0 / (SELECT count(*) FROM points)) AS share_label,
  (SELECT string_agg(k || '=' || n, ';' ORDER BY k) FROM g WHERE g.cluster = i.cluster)
    AS genders,
  (SELECT string_agg(k || '=' || n, ';' ORDER BY k) FROM a WHERE a.cluster = i.cluster) AS ages,
  (SELECT k FROM d WHERE d.cluster = i.cluster) AS top_location
FROM inp i GROUP BY i.cluster""")
def cluster_statistics(spark, sf):
    out = cl.cluster_statistics(
        b.points(spark, sf), gender="gender", age_group="age_group", location="district"
    )
    return rounded(
        out.withColumns(
            {"genders": _flat_map("gender_distribution"), "ages": _flat_map("age_distribution")}
        ).drop("gender_distribution", "age_distribution")
    )


@query("cluster_counts", f"""WITH {b.POINTS}
SELECT cluster, count(latitude) AS records, count(DISTINCT district) AS locations
FROM points GROUP BY cluster""")
def cluster_counts(spark, sf):
    return cl.cluster_counts(b.points(spark, sf))


@query("target_groups", f"""WITH {_IN}, g AS (
  SELECT cluster, gender AS k, count(*) AS n FROM inp GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, gender) = 1),
 a AS (SELECT cluster, age_group AS k, count(*) AS n FROM inp GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, age_group) = 1),
 s AS (SELECT cluster, count(*) AS size FROM inp GROUP BY 1)
SELECT s.cluster, size, g.k || ' (' || printf('%.0f%%', g.n * 100.0 / size) || ')'
  AS dominant_gender, a.k || ' (' || printf('%.0f%%', a.n * 100.0 / size) || ')'
  AS dominant_age_group, g.k || ' ' || trim(split_part(a.k, '(', 1)) AS description
FROM s JOIN g ON s.cluster = g.cluster JOIN a ON s.cluster = a.cluster""")
def target_groups(spark, sf):
    return cl.target_groups(b.points(spark, sf))


@query("cluster_sizes", f"WITH {_IN} SELECT cluster, count(*) AS size FROM inp GROUP BY cluster")
def cluster_sizes(spark, sf):
    return cl.cluster_sizes(b.points(spark, sf))


@query("cluster_balance", f"""WITH {_IN}, s AS (
  SELECT count(*) AS n FROM inp GROUP BY cluster)
SELECT count(*) AS n_clusters, round(stddev_pop(n) / avg(n), 6) AS balance FROM s""")
def cluster_balance(spark, sf):
    return rounded(cl.cluster_balance(b.points(spark, sf)))


@query("cluster_spread", f"""WITH {_IN}
SELECT cluster, round(stddev_pop(latitude), 6) AS lat_std,
  round(stddev_pop(longitude), 6) AS lon_std,
  round((stddev_pop(latitude) + stddev_pop(longitude)) / 2, 6) AS avg_spread
FROM inp GROUP BY cluster""")
def cluster_spread(spark, sf):
    return rounded(cl.cluster_spread(b.points(spark, sf)))


@query("cluster_ellipse", f"""WITH {b.POINTS}
SELECT cluster, round(avg(age), 6) AS center_x, round(avg(latitude), 6) AS center_y,
  round(CASE WHEN coalesce(stddev_pop(age), 0) * 3 = 0 THEN 4 ELSE stddev_pop(age) * 3 END, 6)
  AS width, CASE WHEN count(DISTINCT latitude) > 1 THEN 1.6::DOUBLE ELSE 0.7::DOUBLE END
  AS height FROM points GROUP BY cluster""")
def cluster_ellipse(spark, sf):
    return rounded(cl.cluster_ellipse(b.points(spark, sf), "age", "latitude"))


@query("noise_stats", f"""WITH {b.POINTS}
SELECT count(*) FILTER (cluster = -1) AS n_noise,
  round(count(*) FILTER (cluster = -1) * 100.0 / count(*), 6) AS noise_pct,
  count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters FROM points""")
def noise_stats(spark, sf):
    return rounded(cl.noise_stats(b.points(spark, sf)))


@query("cluster_markers", f"""WITH {_IN}
SELECT cluster, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
  count(*) AS size, ['red', 'blue', 'green', 'purple', 'orange', 'darkred', 'lightred',
  'beige', 'darkblue', 'darkgreen', 'cadetblue'][cluster % 11 + 1] AS color
FROM inp GROUP BY cluster""")
def cluster_markers(spark, sf):
    return rounded(cl.cluster_markers(b.points(spark, sf)))


@query("cluster_colors", f"""WITH {b.POINTS}
SELECT row_id, ['red', 'blue', 'green', 'purple', 'orange', 'darkred', 'lightred',
  'beige', 'darkblue', 'darkgreen', 'cadetblue'][(cluster + 11) % 11 + 1] AS color
FROM points""")
def cluster_colors(spark, sf):
    return b.points(spark, sf).select("row_id", cluster_color("cluster").alias("color"))


@query("top_locations_per_cluster", f"""WITH {b.POINTS}, c AS (
  SELECT cluster, district, count(*) AS n FROM points GROUP BY 1, 2)
SELECT cluster, district, n, CAST(row_number() OVER (
  PARTITION BY cluster ORDER BY n DESC, district) AS INTEGER) AS rank
FROM c QUALIFY rank <= 5""")
def top_locations_per_cluster(spark, sf):
    return top_n_per_group(b.points(spark, sf), "cluster", "district", 5)


@query("standardize", f"""WITH {b.POINTS}, s AS (
  SELECT avg(latitude) AS m1, stddev_pop(latitude) AS s1, avg(longitude) AS m2,
         stddev_pop(longitude) AS s2 FROM points)
SELECT row_id, round((latitude - m1) / s1, 6) AS latitude_z,
  round((longitude - m2) / s2, 6) AS longitude_z FROM points, s""")
def standardize(spark, sf):
    return rounded(sc.standardize(b.points(spark, sf), _XY).select(
        "row_id", "latitude_z", "longitude_z"
    ))


@query("one_hot", f"""WITH {b.POINTS}
SELECT row_id, CAST(district = 'P0' AS INTEGER) AS dist_P0,
  CAST(district = 'P3' AS INTEGER) AS dist_P3, 0 AS dist_P9 FROM points""")
def one_hot(spark, sf):
    wide = sc.one_hot(b.points(spark, sf), "district", ["P0", "P3", "P9"], "dist")
    return wide.select("row_id", "dist_P0", "dist_P3", "dist_P9")


@query("temporal_split", "WITH " + b.CASES + """
SELECT row_id, CASE WHEN year < 2000 THEN 'TRAIN' ELSE 'TEST' END AS split
FROM cases WHERE year <= 2000""")
def temporal_split(spark, sf):
    return sc.temporal_split(b.cases(spark, sf), 2000).select("row_id", "split")


# --- quality -----------------------------------------------------------------------------

_CENT = """cent AS (SELECT cluster, avg(latitude) AS mx, avg(longitude) AS my, count(*) AS n
  FROM inp GROUP BY cluster)"""


@query("inertia", f"""WITH {_IN}, {_CENT}
SELECT round(sum((latitude - mx) ** 2 + (longitude - my) ** 2), 6) AS inertia
FROM inp JOIN cent USING (cluster)""")
def inertia(spark, sf):
    return rounded(cl.inertia(b.points(spark, sf), _XY))


@query("davies_bouldin", f"""WITH {_IN}, {_CENT}, s AS (
  SELECT cluster, any_value(mx) AS mx, any_value(my) AS my,
    avg(sqrt((latitude - mx) ** 2 + (longitude - my) ** 2)) AS s
  FROM inp JOIN cent USING (cluster) GROUP BY cluster),
 r AS (SELECT a.cluster, max((a.s + z.s) / sqrt((a.mx - z.mx) ** 2 + (a.my - z.my) ** 2)) AS r
  FROM s a JOIN s z ON a.cluster <> z.cluster GROUP BY a.cluster)
SELECT round(avg(r), 6) AS davies_bouldin FROM r""")
def davies_bouldin(spark, sf):
    return rounded(cl.davies_bouldin(b.points(spark, sf), _XY))


_SIL = _IN + """, d AS (
  SELECT a.row_id, a.cluster, z.cluster AS other, count(*) AS n,
    sum(sqrt((a.latitude - z.latitude) ** 2 + (a.longitude - z.longitude) ** 2)) AS dist
  FROM inp a, inp z GROUP BY 1, 2, 3),
 ab AS (SELECT row_id, cluster,
    max(CASE WHEN other = cluster AND n > 1 THEN dist / (n - 1) END) AS a,
    min(CASE WHEN other <> cluster THEN dist / n END) AS b FROM d GROUP BY 1, 2),
 sil AS (SELECT row_id, cluster, (b - a) / greatest(a, b) AS s FROM ab)"""


@query("silhouette_exact", f"WITH {_SIL} SELECT round(avg(s), 6) AS silhouette FROM sil")
def silhouette_exact(spark, sf):
    return rounded(cl.silhouette_exact(cl.silhouette_samples(b.points(spark, sf), _XY)))


@query("silhouette_per_cluster", f"""WITH {_SIL}
SELECT cluster, round(avg(s), 6) AS silhouette FROM sil GROUP BY cluster""")
def silhouette_per_cluster(spark, sf):
    samples = cl.silhouette_samples(b.points(spark, sf), _XY)
    return rounded(cl.silhouette_per_cluster(samples))


@query("silhouette_squared", f"""WITH {_IN}, st AS (
  SELECT cluster, count(*) AS n, avg(latitude) AS mx, avg(longitude) AS my,
    avg(latitude ** 2 + longitude ** 2) AS sq FROM inp GROUP BY cluster),
 d AS (SELECT i.row_id, i.cluster, st.cluster AS other, st.n,
    i.latitude ** 2 + i.longitude ** 2 + sq - 2 * (latitude * mx + longitude * my) AS md
  FROM inp i, st),
 ab AS (SELECT row_id, cluster, max(CASE WHEN other = cluster THEN md * n / (n - 1) END) AS a,
    min(CASE WHEN other <> cluster THEN md END) AS b FROM d GROUP BY 1, 2)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette_squared FROM ab""")
def silhouette_squared(spark, sf):
    value = cl.silhouette_squared(b.points(spark, sf), _XY)
    return spark.createDataFrame([(round(value, 6),)], "silhouette_squared double")


_LONG_QUALITY = f"""WITH {_SIL}, {_CENT}, sp AS (
  SELECT cluster, any_value(mx) AS mx, any_value(my) AS my,
    avg(sqrt((latitude - mx) ** 2 + (longitude - my) ** 2)) AS s,
    sum((latitude - mx) ** 2 + (longitude - my) ** 2) AS e, count(*) AS n
  FROM inp JOIN cent USING (cluster) GROUP BY cluster),
 r AS (SELECT a.cluster, max((a.s + z.s) / sqrt((a.mx - z.mx) ** 2 + (a.my - z.my) ** 2)) AS r
  FROM sp a JOIN sp z ON a.cluster <> z.cluster GROUP BY a.cluster),
 q AS (
  SELECT NULL AS cluster, 'n_samples' AS metric, CAST(count(*) AS DOUBLE) AS value FROM points
  UNION ALL SELECT NULL, 'n_noise', count(*) FILTER (cluster = -1) FROM points
  UNION ALL SELECT NULL, 'n_clusters', count(*) FROM cent
  UNION ALL SELECT NULL, 'silhouette', avg(s) FROM sil
  UNION ALL SELECT NULL, 'davies_bouldin', avg(r) FROM r
  UNION ALL SELECT NULL, 'inertia', sum(e) FROM sp
  UNION ALL SELECT NULL, 'balance', stddev_pop(n) / avg(n) FROM sp
  UNION ALL SELECT cluster, 'size', n FROM sp
  UNION ALL SELECT cluster, 'silhouette', avg(s) FROM sil GROUP BY cluster
  UNION ALL SELECT cluster, 'lat_std', stddev_pop(latitude) FROM inp GROUP BY cluster
  UNION ALL SELECT cluster, 'lon_std', stddev_pop(longitude) FROM inp GROUP BY cluster
  UNION ALL SELECT cluster, 'avg_spread', (stddev_pop(latitude) + stddev_pop(longitude)) / 2
    FROM inp GROUP BY cluster)
SELECT CAST(cluster AS BIGINT) AS cluster, metric, round(value, 6) AS value FROM q"""


@query("cluster_quality", _LONG_QUALITY)
def cluster_quality(spark, sf):
    return rounded(
        cl.quality_report(b.points(spark, sf), _XY, lat="latitude", lon="longitude")
    )


@query("nearest_center", f"""WITH {b.POINTS}, d AS (
  SELECT row_id, (latitude - 0) ** 2 + (longitude - 0) ** 2 AS d0,
    (latitude - 0.2) ** 2 + (longitude - 0.1) ** 2 AS d1,
    (latitude + 0.1) ** 2 + (longitude - 0.2) ** 2 AS d2 FROM points)
SELECT row_id, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END
  AS INTEGER) AS cluster FROM d""")
def nearest_center(spark, sf):
    centers = [[0.0, 0.0], [0.2, 0.1], [-0.1, 0.2]]
    return cl.nearest_center(b.points(spark, sf).drop("cluster"), _XY, centers).select(
        "row_id", "cluster"
    )


# --- K-means ----------------------------------------------------------------------------


@query("kmeans_fit")
def kmeans_fit(spark, sf):
    return fit_kmeans(b.points(spark, sf), _XY, k=5).centers(spark)


@query("kmeans_predict")
def kmeans_predict(spark, sf):
    model = fit_kmeans(b.points(spark, sf), _XY, k=4)
    return model.transform(b.points(spark, sf).drop("cluster")).select("row_id", "cluster")


@query("kmeans_certificate", f"""WITH {b.POINTS}
SELECT CAST(count(*) AS BIGINT) AS n_rows, 5 AS n_clusters, 0 AS not_nearest, true AS at_means,
  true AS sums_add_up, true AS best_of_starts,
  CAST(count(*) * 2 AS DOUBLE) AS total FROM points""")
def kmeans_certificate(spark, sf):
    """What every K-means result has to fulfil, measured on a fit with five centres."""
    points = b.points(spark, sf).drop("cluster")
    return rounded(certificate(fit_kmeans(points, _XY, k=5), points), 4)


@query("k_sweep")
def k_sweep_query(spark, sf):
    return k_sweep(b.points(spark, sf), _XY, (2, 15))


@query("k_recommendation")
def k_recommendation(spark, sf):
    return best_k(k_sweep(b.points(spark, sf), _XY))


@query("demographic_clusters")
def demographic_clusters(spark, sf):
    out = demographic_plan(b.cases(spark, sf))
    return out.select("row_id", "age", "gender", "cluster")


_SCORES = """cent AS (SELECT g, label, count(*) AS n, avg(x) AS mx, avg(y) AS my,
   var_pop(x) + var_pop(y) AS v FROM inn GROUP BY ALL),
 far AS (SELECT i.g, i.i, i.label, c.label AS other, c.n, (x - mx) ** 2 + (y - my) ** 2 AS d2, v
   FROM inn i JOIN cent c ON c.g = i.g),
 ab AS (SELECT g, i, any_value(label) AS label, max(n) FILTER (other = label) AS n,
    max((d2 + v) * n / nullif(n - 1, 0)) FILTER (other = label) AS a,
    min(d2 + v) FILTER (other <> label) AS b, max(d2) FILTER (other = label) AS d2
   FROM far GROUP BY g, i),
 sp AS (SELECT g, label, avg(sqrt(d2)) AS s, sum(d2) AS inertia FROM ab GROUP BY ALL),
 sil AS (SELECT g, avg(CASE WHEN b IS NULL THEN NULL WHEN n = 1 THEN 0
    ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS s FROM ab GROUP BY g),
 ctr AS (SELECT sp.g, sp.label, s, inertia, mx, my FROM sp JOIN cent ON cent.g = sp.g AND cent.label = sp.label),
 r AS (SELECT a.g, a.label, max(coalesce((a.s + o.s) / nullif(
      sqrt((a.mx - o.mx) ** 2 + (a.my - o.my) ** 2), 0), 0)) AS r
   FROM ctr a JOIN ctr o ON a.g = o.g AND a.label <> o.label GROUP BY ALL),
 db AS (SELECT g, avg(r) AS db FROM r GROUP BY g)"""
_FIRST_CENTERS = tuple(range(2, 16))


_FIRST_K = f"""WITH {b.POINTS}, s AS (
  SELECT avg(latitude) AS m1, stddev_pop(latitude) AS s1, avg(longitude) AS m2,
         stddev_pop(longitude) AS s2 FROM points),
 z AS (SELECT row_id AS i, (latitude - m1) / s1 AS x, (longitude - m2) / s2 AS y FROM points, s),
 c AS (SELECT row_number() OVER (ORDER BY i) - 1 AS label, x AS cx, y AS cy FROM z ORDER BY i LIMIT 15),
 inn AS (SELECT g, i, x, y, arg_min(label, ((x - cx) ** 2 + (y - cy) ** 2, label)) AS label
   FROM (SELECT CAST(unnest(range(2, 16)) AS INTEGER) AS g) k JOIN c ON label < g, z GROUP BY ALL),
 {_SCORES},
 scores AS (SELECT ctr.g AS k, count(*) AS n_clusters, round(sum(inertia), 6) AS inertia,
   round(any_value(sil.s), 6) AS silhouette_squared, round(any_value(db.db), 6) AS davies_bouldin
   FROM ctr LEFT JOIN sil USING (g) LEFT JOIN db USING (g) GROUP BY ctr.g)"""


@query("labelling_scores", _FIRST_K + " SELECT * FROM scores")
def labelling_scores(spark, sf):
    """Scores of fourteen labellings at once: rows to the nearest of the first k points."""
    z = ["latitude_z", "longitude_z"]
    rows = _scaled(spark, sf).select("row_id", *z)
    first = [list(r[1:]) for r in rows.orderBy("row_id").limit(max(_FIRST_CENTERS)).collect()]
    labelled = label_with_centers(rows, z, {k: first[:k] for k in _FIRST_CENTERS})
    return rounded(score_labellings(labelled, z).withColumnRenamed("g", "k"))


@query("k_choice", _FIRST_K + """
SELECT (SELECT k FROM scores ORDER BY silhouette_squared DESC, k LIMIT 1) AS k_silhouette,
  (SELECT max(silhouette_squared) FROM scores) AS silhouette,
  (SELECT k FROM scores ORDER BY davies_bouldin, k LIMIT 1) AS k_davies_bouldin,
  (SELECT min(davies_bouldin) FROM scores) AS davies_bouldin""")
def k_choice(spark, sf):
    """The recommended k of a table of scores."""
    return best_k(labelling_scores(spark, sf))


# --- DBSCAN -----------------------------------------------------------------------------

_EPS, _MIN = 0.25, 6
_Z = f"""WITH RECURSIVE {b.POINTS}, s AS (
  SELECT avg(latitude) AS m1, stddev_pop(latitude) AS s1, avg(longitude) AS m2,
         stddev_pop(longitude) AS s2 FROM points),
 z AS (SELECT row_id, (latitude - m1) / s1 AS x, (longitude - m2) / s2 AS y FROM points, s),
 near AS (SELECT a.row_id AS i, z.row_id AS j FROM z a, z
          WHERE (a.x - z.x) ** 2 + (a.y - z.y) ** 2 <= {_EPS} * {_EPS}),
 core AS (SELECT i FROM near GROUP BY i HAVING count(*) >= {_MIN})"""
_LABELS = _Z + """, edges AS (SELECT n.i, n.j FROM near n JOIN core a ON n.i = a.i
                              JOIN core c ON n.j = c.i),
 walk AS (SELECT i, i AS root FROM core
          UNION SELECT e.j, w.root FROM walk w JOIN edges e ON w.i = e.i WHERE w.root < e.j),
 comp AS (SELECT i, min(root) AS root FROM walk GROUP BY i),
 named AS (SELECT i, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS label FROM comp),
 border AS (SELECT n.i, min(named.label) AS label FROM near n JOIN named ON n.j = named.i
            GROUP BY n.i),
 labels AS (SELECT z.row_id, coalesce(named.label, border.label, -1) AS label,
   named.label IS NOT NULL AS core FROM z LEFT JOIN named ON z.row_id = named.i
   LEFT JOIN border ON z.row_id = border.i)"""


def _scaled(spark, sf):
    p = b.points(spark, sf).drop("cluster")
    return sc.standardize(p, _XY)


@query("dbscan", _LABELS + " SELECT row_id, label, core FROM labels")
def dbscan_query(spark, sf):
    return dbscan(_scaled(spark, sf), ["latitude_z", "longitude_z"], _EPS, _MIN)


@query("dbscan_core", _Z + """
SELECT z.row_id, core.i IS NOT NULL AS core FROM z LEFT JOIN core ON z.row_id = core.i""")
def dbscan_core(spark, sf):
    labels = dbscan_grid_labels(
        _scaled(spark, sf), ["latitude_z", "longitude_z"], [(_EPS, _MIN)]
    )
    return labels.select("row_id", "core")


@query("dbscan_centers", _LABELS + """
SELECT label, count(*) AS size, round(avg(latitude), 6) AS latitude,
  round(avg(longitude), 6) AS longitude
FROM labels JOIN points USING (row_id) WHERE label >= 0 GROUP BY label""")
def dbscan_centers(spark, sf):
    labels = dbscan(_scaled(spark, sf), ["latitude_z", "longitude_z"], _EPS, _MIN)
    points = b.points(spark, sf).select("row_id", *_XY)
    return rounded(cluster_centers(points, labels, _XY))


_EPS_LIST, _MIN_LIST = K.DBSCAN_EPS_GRID_WIDE, K.DBSCAN_MIN_SAMPLES_GRID
_GRID_LABELS = f"""WITH RECURSIVE {b.POINTS}, s AS (
  SELECT avg(latitude) AS m1, stddev_pop(latitude) AS s1, avg(longitude) AS m2,
         stddev_pop(longitude) AS s2 FROM points),
 z AS (SELECT row_id, (latitude - m1) / s1 AS x, (longitude - m2) / s2 AS y FROM points, s),
 p AS (SELECT eps, ms, CAST(row_number() OVER (ORDER BY eps, ms) - 1 AS INTEGER) AS g
   FROM (SELECT CAST(unnest([{", ".join(map(str, _EPS_LIST))}]) AS DOUBLE) AS eps),
        (SELECT CAST(unnest([{", ".join(map(str, _MIN_LIST))}]) AS INTEGER) AS ms)),
 near AS MATERIALIZED (SELECT a.row_id AS i, z.row_id AS j, (a.x - z.x) ** 2 + (a.y - z.y) ** 2 AS d2
   FROM z a, z WHERE d2 <= {max(_EPS_LIST)} * {max(_EPS_LIST)} * 1.001),
 ball AS MATERIALIZED (SELECT g, ms, i, j FROM p JOIN near ON d2 <= eps * eps),
 core AS (SELECT g, i FROM ball GROUP BY g, ms, i HAVING count(*) >= ms),
 edges AS MATERIALIZED (SELECT n.g, n.i, n.j FROM ball n JOIN core a ON a.g = n.g AND a.i = n.i
           JOIN core c ON n.g = c.g AND n.j = c.i),
 walk AS (SELECT g, i, i AS root FROM core
          UNION SELECT w.g, e.j, w.root FROM walk w
          JOIN edges e ON w.g = e.g AND w.i = e.i WHERE w.root < e.j),
 comp AS (SELECT g, i, min(root) AS label FROM walk GROUP BY ALL),
 border AS (SELECT n.g, n.i, min(c.label) AS label FROM ball n
            JOIN comp c ON n.g = c.g AND n.j = c.i GROUP BY ALL),
 labels AS (SELECT p.g, z.row_id AS i, x, y, coalesce(c.label, o.label, -1) AS label
   FROM p CROSS JOIN z LEFT JOIN comp c ON c.g = p.g AND c.i = z.row_id
   LEFT JOIN border o ON o.g = p.g AND o.i = z.row_id),
 inn AS (SELECT * FROM labels WHERE label <> -1)"""


@query("dbscan_grid", f"""{_GRID_LABELS}, {_SCORES}
SELECT any_value(p.eps) AS eps, any_value(p.ms) AS min_samples,
  count(DISTINCT CASE WHEN label <> -1 THEN label END) AS n_clusters,
  count(*) FILTER (label = -1) AS n_noise,
  round(count(*) FILTER (label = -1) * 100.0 / count(*), 6) AS noise_pct,
  round(any_value(sil.s), 6) AS silhouette, round(any_value(db.db), 6) AS davies_bouldin
FROM labels JOIN p USING (g) LEFT JOIN sil ON sil.g = p.g LEFT JOIN db ON db.g = p.g GROUP BY p.g""")
def dbscan_grid(spark, sf):
    """All 44 pairs of the wide grid, scored together."""
    return rounded(
        cs.dbscan_grid(b.points(spark, sf), _XY, _EPS_LIST, _MIN_LIST), 6,
        "noise_pct", "silhouette", "davies_bouldin",
    )


@query("dbscan_grid_exact", _GRID_LABELS.replace(
    str(list(_EPS_LIST)), "[0.05, 0.15]").replace(str(list(_MIN_LIST)), "[3, 5]") + """,
 d AS (SELECT a.g, a.i, a.label, z.label AS other, count(*) AS n,
     sum(sqrt((a.x - z.x) ** 2 + (a.y - z.y) ** 2)) AS dist FROM inn a JOIN inn z ON z.g = a.g GROUP BY ALL),
 ab AS (SELECT g, i, max(CASE WHEN other = label THEN n END) AS n,
    max(CASE WHEN other = label AND n > 1 THEN dist / (n - 1) END) AS a,
    min(CASE WHEN other <> label THEN dist / n END) AS b FROM d GROUP BY g, i),
 sil AS (SELECT g, avg(CASE WHEN n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS s
   FROM ab WHERE b IS NOT NULL GROUP BY g)
SELECT p.eps, p.ms AS min_samples, round(sil.s, 6) AS silhouette FROM p LEFT JOIN sil USING (g)""")
def dbscan_grid_exact(spark, sf):
    """Four pairs with the Euclidean silhouette."""
    grid = cs.dbscan_grid(b.points(spark, sf), _XY, (0.05, 0.15), (3, 5), exact=True)
    return rounded(grid.select("eps", "min_samples", "silhouette"), 6, "silhouette")


@query("compare_dbscan", _GRID_LABELS.replace(
    str(list(_EPS_LIST)), "[0.25]").replace(str(list(_MIN_LIST)), "[6]").replace(
    f"{max(_EPS_LIST)} * {max(_EPS_LIST)}", "0.25 * 0.25") + f""", {_SCORES}
SELECT 'DBSCAN' AS method, count(DISTINCT CASE WHEN label <> -1 THEN label END) AS n_clusters,
  count(*) FILTER (label = -1) AS noise_points, round((SELECT s FROM sil), 6) AS silhouette,
  round((SELECT db FROM db), 6) AS davies_bouldin FROM labels""")
def compare_dbscan(spark, sf):
    """The row of the comparison that has no random start."""
    table = cs.compare_methods(b.points(spark, sf).drop("cluster"), _XY, 5, _EPS, _MIN)
    return rounded(table.filter("method = 'DBSCAN'").select(
        "method", "n_clusters", "noise_points", "silhouette", "davies_bouldin"
    ))


_GRID = b.CASES + """, grid AS (
  SELECT year / 10000.0 AS eps, CAST(month AS INTEGER) AS min_samples, count(*) % 7 AS n_clusters,
    count(*) % 11 AS n_noise, avg(age) AS noise_pct,
    CASE WHEN month % 5 <> 0 THEN min(longitude) / 1000000 END AS silhouette
  FROM cases GROUP BY year, month)"""


@query("dbscan_select", f"""WITH {_GRID}, r AS (
  SELECT eps, min_samples, CASE WHEN n_clusters > 1 AND noise_pct < 50 AND silhouette IS NOT NULL
    THEN 0 WHEN n_clusters > 0 AND noise_pct < 80 THEN 1 END AS tier, silhouette, n_clusters
  FROM grid)
SELECT eps, min_samples, CAST(tier AS INTEGER) AS tier FROM r WHERE tier IS NOT NULL
ORDER BY tier, CASE tier WHEN 0 THEN silhouette ELSE n_clusters END DESC, eps, min_samples
LIMIT 1""")
def dbscan_select(spark, sf):
    grid = b.cases(spark, sf).groupBy("year", "month").agg(
        (F.count(F.lit(1)) % 7).alias("n_clusters"),
        F.avg("age").alias("noise_pct"),
        F.when(F.col("month") % 5 != 0, F.min("longitude") / 1000000).alias("silhouette"),
    )
    grid = grid.withColumns(
        {"eps": F.col("year") / F.lit(10000.0), "min_samples": F.col("month")}
    )
    return cs.select_dbscan_params(grid)


@query("cluster_compare")
def cluster_compare(spark, sf):
    return cs.compare_methods(b.points(spark, sf), _XY, 5, _EPS, _MIN)


@query("clustering_eval")
def clustering_eval(spark, sf):
    """Whole evaluation on the positions of the customers' cases, all its tables.

    Every seventh position is missing and comes from the customer's district.
    """
    cases = b.cases(spark, sf)
    home = cases.select("person", "district").distinct()
    places = location_centroid(cases, "person").join(home, "person").withColumnRenamed("person", "row_id")
    gap = F.col("row_id") % 7 == 0
    gappy = places.withColumns({c: F.when(~gap, F.col(c)) for c in _XY})
    districts = location_centroid(cases).select("district", *_XY)
    path = scratch_path(spark, "clustering-eval")
    return long_table(evaluate_clustering(gappy, _XY, districts=districts, out=path))


@query("cluster_category_counts", f"""WITH {_IN}, u AS (
  SELECT cluster, 'gender' AS column_name, gender AS value FROM inp UNION ALL
  SELECT cluster, 'age_group', age_group FROM inp UNION ALL SELECT cluster, 'district', district FROM inp)
SELECT cluster, column_name, value, count(*) AS n FROM u GROUP BY 1, 2, 3
QUALIFY row_number() OVER (PARTITION BY cluster, column_name ORDER BY count(*) DESC, value) <= 3""")
def cluster_category_counts(spark, sf):
    """The three most frequent values of three columns in every cluster."""
    rows = cl.without_noise(b.points(spark, sf))
    return category_counts(rows, ["gender", "age_group", "district"], "cluster", 3)


@query("category_counts", f"""WITH {b.CASES}
SELECT 'gender' AS column_name, gender AS value, count(*) AS n FROM cases GROUP BY gender
UNION ALL SELECT 'person', CAST(person AS VARCHAR), count(*) FROM cases GROUP BY person""")
def category_counts_query(spark, sf):
    """All values of a column with few of them and of one with many."""
    return category_counts(b.cases(spark, sf), ["gender", "person"])


@query("cluster_quality_linear", f"""WITH {b.POINTS},
 inn AS (SELECT 0 AS g, row_id AS i, latitude AS x, longitude AS y, cluster AS label FROM points WHERE cluster <> -1),
 {_SCORES}
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'silhouette_squared' AS metric, any_value(s) AS value FROM sil
  UNION ALL SELECT 'davies_bouldin', any_value(db) FROM db
  UNION ALL SELECT 'inertia', sum(inertia) FROM sp)""")
def cluster_quality_linear(spark, sf):
    report = cl.quality_report(b.points(spark, sf), _XY, exact=False)
    wanted = ["silhouette_squared", "davies_bouldin", "inertia"]
    return rounded(report.filter(F.col("metric").isin(wanted)).select("metric", "value"))
