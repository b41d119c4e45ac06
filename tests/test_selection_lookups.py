"""Exact quantiles, lookups with hot keys, similarity join, scores of many labellings."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from casegrid.operators import kmeans, labellings, selection, similar
from casegrid.operators.components import connected_components
from casegrid.operators.dbscan import dbscan
from casegrid.operators.layers import map_layer
from casegrid.operators.lookups import lookup
from casegrid.operators.summaries import category_counts


# --- quantiles -----------------------------------------------------------------------

@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [7.0] * 50 + [8.0] * 50, [0.1 * i for i in range(1001)],
])
def test_medians(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert selection.exact_median(df, "v") == pytest.approx(statistics.median(values), abs=1e-12)


def test_quantiles_by_narrowing(spark, monkeypatch):
    monkeypatch.setattr(selection, "VALUES", 50)
    monkeypatch.setattr(selection, "PARTS", 8)
    draw = random.Random(6)
    values = [draw.gauss(0, 1) for _ in range(5000)] + [0.25] * 3000 + [-1e9, 1e9, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    shares = (0.0, 0.1, 0.25, 0.5, 0.77, 0.999)
    ordered = sorted(values)
    for share, got in zip(shares, selection.exact_quantiles(df, "v", shares), strict=True):
        at = share * (len(values) - 1)
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(values) - 1)]
        assert got == pytest.approx(low + (high - low) * (at - int(at)), abs=1e-12)


def test_quantiles_of_nothing_and_integers(spark):
    assert selection.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", (0.5, 0.9)) == [None, None]
    assert selection.exact_median(spark.range(1_000_000), "id") == 499_999.5


# --- lookups -------------------------------------------------------------------------

@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_equals_a_join(spark, how):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).alias("k"), F.col("id").alias("_hot"),
    )
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k <> 5")
    named = counts.withColumn("value", F.col("k") * 2)
    got = lookup(rows, named, ["k"], "n", 6000, how)
    want = rows.join(named.drop("n"), ["k"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_lookup_of_unknown_keys(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    named = spark.createDataFrame([("a", "x", 5000)], "k string, name string, n long")
    assert sorted(map(tuple, lookup(rows, named, ["k"], "n", 4, "left").collect()), key=repr) == sorted(
        [(None, 1, None), ("a", 2, "x"), ("b", 3, None), (None, 4, None)], key=repr
    )
    assert [tuple(r) for r in lookup(rows, named, ["k"], "n", 4).collect()] == [("a", 2, "x")]


def test_rows_of_a_hot_key_stay_in_many_tasks(spark):
    rows = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    found = lookup(rows, counts.withColumn("v", F.col("k")), ["k"], "n", 40_000)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 4 * statistics.median(sizes)


def test_components_of_hubs(spark):
    """Two stars of many leaves whose hubs are the greatest ids, linked by a chain."""
    star = [(1_000_000, i) for i in range(3000)] + [(1_000_001, 5000 + i) for i in range(3000)]
    chain = [(1_000_000, 9000), (9000, 9001), (9001, 1_000_001), (20_000, 20_001)]
    edges = spark.createDataFrame([(0, a, b) for a, b in star + chain], "g int, u long, v long")
    nodes = edges.select("g", F.col("u").alias("node")).union(edges.select("g", "v")).distinct()
    got = {r.node: r.component for r in connected_components(nodes, edges).collect()}
    assert {c for n, c in got.items() if n < 20_000 or n >= 1_000_000} == {0}
    assert got[20_001] == got[20_000] == 20_000


def test_dbscan_with_a_third_of_the_rows_at_one_place(spark):
    draw = np.random.default_rng(8)
    points = [(i, 0.5, 0.5) for i in range(3000)]
    points += [(3000 + i, *map(float, draw.normal(0.5, 0.002, 2))) for i in range(3000)]
    points += [(6000 + i, *map(float, draw.uniform(3, 9, 2))) for i in range(60)]
    df = spark.createDataFrame(points, "row_id long, x double, y double").repartition(8)
    labels = {r.row_id: r.label for r in dbscan(df, ["x", "y"], 0.05, 5).collect()}
    assert len(labels) == len(points) and {labels[i] for i in range(6000)} == {0}


# --- similarity join -----------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("least", [0.3, 0.4, 0.55, 0.7, 0.9, 1.0])
def test_alike_equals_all_pairs(spark, least):
    draw = random.Random(9)
    words = ["".join(draw.choices("abcd e", k=draw.randint(1, 9))) for _ in range(150)] + ["", "zzzz", "a", "ab"]
    texts, names = sorted(set(words[:90] + ["", "a", "qq"])), sorted(set(words[60:]))
    left = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    right = spark.createDataFrame([(t,) for t in [*names, None]], "n string")
    got = similar.alike(left, "t", "t", right, "n", least).distinct()
    want = {
        (t, n) for t in texts for n in names
        if t and n and 1.0 - distance(t, n) / max(len(t), len(n)) >= least
    }
    assert {(r.t, r.n) for r in got.collect()} == want


def test_alike_refuses_impossible_shares(spark):
    df = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(ValueError):
        similar.alike(df, "t", "t", df.toDF("n"), "n", 0.0)


# --- many labellings -----------------------------------------------------------------

def test_scores_in_pages_equal_one_page(spark):
    draw = np.random.default_rng(2)
    rows = [(g, int(draw.integers(-1, 3 + 9 * g)), *map(float, draw.normal(size=2))) for g in range(3) for _ in range(200)]
    rows += [(7, 0, 1.0, 1.0), (7, 0, 2.0, 1.0), (8, 3, 1.0, 1.0), (8, 4, 1.0, 1.0), (9, -1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "g int, cluster long, x double, y double")
    one = {r.g: r for r in labellings.score_labellings(df, ["x", "y"]).collect()}
    few = {r.g: r for r in labellings.score_labellings(df, ["x", "y"], page=3).collect()}
    assert set(one) == set(few) == {0, 1, 2, 7, 8}
    for g in one:
        assert tuple(one[g]) == pytest.approx(tuple(few[g]), abs=1e-9)
    assert one[7].silhouette_squared is None and one[7].davies_bouldin is None and one[7].inertia == 0.5
    assert one[8].silhouette_squared == 0.0 and one[8].davies_bouldin == 0.0


def test_scores_equal_the_single_ones(spark):
    from casegrid.operators.clusters import davies_bouldin, inertia, silhouette_squared

    draw = np.random.default_rng(3)
    rows = [(0, int(draw.integers(0, 6)), *map(float, draw.normal(size=2))) for _ in range(400)]
    df = spark.createDataFrame(rows, "g int, cluster long, x double, y double")
    row = labellings.score_labellings(df, ["x", "y"]).first()
    assert row.silhouette_squared == pytest.approx(silhouette_squared(df, ["x", "y"]))
    assert row.davies_bouldin == pytest.approx(davies_bouldin(df, ["x", "y"]).first()[0])
    assert row.inertia == pytest.approx(inertia(df, ["x", "y"]).first()[0])


def test_certificate_finds_a_wrong_result(spark):
    from dataclasses import replace

    df = spark.createDataFrame([(float(i % 7), float(i % 11)) for i in range(200)], "x double, y double")
    fitted = kmeans.fit_kmeans(df, ["x", "y"], k=3, n_init=2)
    good = kmeans.certificate(fitted, df).first()
    assert good.not_nearest == 0 and good.at_means and good.sums_add_up and good.best_of_starts
    other = kmeans.certificate(replace(fitted, inertia=fitted.inertia + 1), df.filter("x < 3")).first()
    assert not other.at_means and not other.best_of_starts

def test_rows_meet_only_clusters_that_can_be_nearest(spark):
    r = np.random.default_rng(5)
    xy = r.uniform(-3, 3, (4000, 2))
    rows = [(0, int(np.floor(a * 3) + 9 + 18 * (np.floor(b * 3) + 9)), float(a), float(b)) for a, b in xy]
    rows += [(1, int(a > 0), float(a), float(b)) for a, b in xy]
    df = spark.createDataFrame(rows, "g int, cluster long, x double, y double")
    boxes = {q.g: q for q in labellings.score_labellings(df, ["x", "y"]).collect()}
    whole = {q.g: q for q in labellings.score_labellings(df, ["x", "y"], page=8 * 400).collect()}
    assert boxes[0].n_clusters > 300 and boxes.keys() == whole.keys()
    for g, row in boxes.items():
        assert list(row) == pytest.approx(list(whole[g]), rel=1e-9)
    moments = labellings._moments(df, ["x", "y"], None)
    met = labellings._meet_in_boxes(df, moments, ["x", "y"], labellings.PAGE)
    assert met.filter("g = 0").agg({"*": "count"}).first()[0] == 4000
    # without boxes a row meets all of the 324 clusters
    assert met.filter("g = 0").selectExpr("avg(size(members))").first()[0] < 30


# --- small ones ----------------------------------------------------------------------

def test_category_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("b", "y"), (None, "z"), ("b", None)], "g string, c string")
    assert {tuple(r) for r in category_counts(df, ["c"], "g").collect()} == {
        ("a", "c", "x", 1), ("a", "c", "y", 1), ("b", "c", "y", 2)
    }
    assert {tuple(r) for r in category_counts(df, ["c", "g"], top=1).collect()} == {("c", "y", 3), ("g", "b", 3)}


def test_layers_refuse_an_empty_table(spark):
    empty = spark.createDataFrame([], "district string, latitude double, longitude double, n long")
    with pytest.raises(ValueError):
        map_layer(empty, "n")


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_tiles_find_the_nearest_and_the_worst_of_many_clusters(dims):
    rng = np.random.default_rng(dims)
    m = np.round(rng.normal(size=(500, dims)), 1)  # some centroids are equal
    m[7], s = 40.0, np.abs(rng.normal(size=500)) * (rng.random(500) < 0.7)
    s[3] = 50.0
    lo = rng.normal(size=(150, dims)) * 2
    hi = lo + rng.random((150, dims)) * (rng.random((150, 1)) < 0.8)
    kept = [np.concatenate(x) for x in zip(*labellings._kept_clusters(lo, hi, m, s, 64))]
    for b in range(len(lo)):
        mine = set(kept[1][kept[0] == b])
        for x in (lo[b], hi[b], (lo[b] + hi[b]) / 2):
            assert set(np.argsort(((m - x) ** 2).sum(1) + s, kind="stable")[:2]) <= mine or len(mine) == 500
    assert len(kept[0]) < len(lo) * 250  # not all of them
    found = [labellings._worst_ratios(m, s, part, 64) for part in range(labellings._PARTS)]
    c, ratio = (np.concatenate(x) for x in zip(*found))
    assert sorted(c) == list(range(500))
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(2))
    both = np.where(d > 0, (s[:, None] + s) / np.where(d > 0, d, 1), 0.0)
    np.fill_diagonal(both, -1.0)
    assert np.allclose(ratio, both.max(1)[c])
    alone = labellings._worst_ratios(m[:1], s[:1], 0, 64)[1]
    assert len(alone) == 1 and np.isnan(alone[0])


def test_many_clusters_are_scored_without_all_pairs_of_them(spark):
    rng = np.random.default_rng(4)
    rows = [(g, i % k, *(float(v) for v in rng.normal(size=2)))
            for g, k in ((0, 150), (1, 3), (2, 1)) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, cluster bigint, x double, y double")
    scored = labellings.score_labellings(df, ["x", "y"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "explode(members" not in plan  # every cluster next to every other one
    got = {r.g: r for r in scored.collect()}
    whole = {r.g: r for r in labellings.score_labellings(df, ["x", "y"], page=4096).collect()}
    for g in (0, 1):
        for name in ("inertia", "silhouette_squared", "davies_bouldin"):
            assert got[g][name] == pytest.approx(whole[g][name])
    assert [got[2][c] for c in ("n_clusters", "silhouette_squared", "davies_bouldin")] == [1, None, None]


def test_one_labelling_of_many_clusters_equals_its_evaluator(spark, monkeypatch):
    from casegrid.operators import clusters

    rng = np.random.default_rng(6)
    rows = [(i % 130 - 1, *(float(v) for v in rng.normal(size=2))) for i in range(900)]
    df = spark.createDataFrame(rows, "cluster bigint, x double, y double")
    few = clusters.silhouette_squared(df, ["x", "y"]), clusters.davies_bouldin(df, ["x", "y"]).first()[0]
    monkeypatch.setattr(clusters, "PAGE", 64)
    monkeypatch.setattr(clusters, "BLOCK_ROWS", 64)
    monkeypatch.setattr(clusters, "compare_blocks", None)
    monkeypatch.setattr(clusters, "ClusteringEvaluator", None)
    many = clusters.silhouette_squared(df, ["x", "y"]), clusters.davies_bouldin(df, ["x", "y"]).first()[0]
    assert many == pytest.approx(few)
