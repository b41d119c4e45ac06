"""Quality measures against numpy, K-means invariants, parameter choice."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from casegrid.operators import clusters as cl
from casegrid.operators import cluster_search as cs
from casegrid.operators.kmeans import best_k, fit_kmeans
from casegrid.operators.scaling import Scaler, standardize


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, (240, 2)), 1)  # rounding makes equal points
    label = rng.integers(-1, 4, 240)
    label[0] = 9  # a cluster of one
    df = spark.createDataFrame(
        [(int(i), float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, label))],
        "row_id long, x double, y double, cluster long",
    )
    return x[label >= 0], label[label >= 0], df


def silhouettes(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i, own in enumerate(label):
        n = (label == own).sum()
        if n == 1:
            out.append(0.0)
            continue
        a = d[i, label == own].sum() / (n - 1)
        b = min(d[i, label == o].mean() for o in set(label) - {own})
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("block_rows", [4096, 29])
def test_silhouette(data, block_rows):
    x, label, df = data
    samples = cl.silhouette_samples(df, ["x", "y"], block_rows=block_rows)
    want = silhouettes(x, label)
    assert cl.silhouette_exact(samples).first()[0] == pytest.approx(want.mean())
    per = {r.cluster: r.silhouette for r in cl.silhouette_per_cluster(samples).collect()}
    assert per == pytest.approx({int(c): want[label == c].mean() for c in set(label)})


def test_one_cluster_has_no_score(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 0), (5.0, -1)], "x double, cluster long")
    assert cl.silhouette_exact(cl.silhouette_samples(df, ["x"])).first()[0] is None
    assert cl.davies_bouldin(df, ["x"]).first()[0] is None
    assert cl.cluster_balance(df).first().balance is None


def test_davies_bouldin(data):
    x, label, df = data
    ids = sorted(set(label))
    c = np.array([x[label == i].mean(0) for i in ids])
    s = np.array([np.sqrt(((x[label == i] - c[k]) ** 2).sum(1)).mean()
                  for k, i in enumerate(ids)])
    d = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.where(d > 0, (s[:, None] + s[None]) / d, 0)
    assert cl.davies_bouldin(df, ["x", "y"]).first()[0] == pytest.approx(r.max(1).mean())


def test_noise_share_counts_all_rows(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 1.0), (0, 2.0, 1.0), (1, 1.0, 3.0), (-1, 0.0, 0.0)],
        "cluster long, latitude double, longitude double",
    )
    got = {r.cluster: (r.size, r.share_label) for r in cl.cluster_statistics(df).collect()}
    assert got == {0: (2, "50.0%"), 1: (1, "25.0%")}


def test_kmeans_rows_are_at_their_nearest_center(spark, data):
    _, _, df = data
    fitted = fit_kmeans(df, ["x", "y"], k=4, n_init=3)
    z = ["_z_x", "_z_y"]
    centers = [list(map(float, c)) for c in fitted.model.clusterCenters()]
    out = fitted.transform(df.drop("cluster"))
    scaled = fitted.scaler.transform(out, prefix="_z_").withColumnRenamed("cluster", "given")
    near = cl.nearest_center(scaled, z, centers)
    assert near.filter(F.col("given") != F.col("cluster")).count() == 0
    assert {r[0] for r in out.select("cluster").distinct().collect()} == {0, 1, 2, 3}
    again = near.select(F.col("cluster").cast("long").alias("cluster"), *z)
    assert cl.inertia(again, z).first()[0] == pytest.approx(fitted.inertia, rel=1e-3)


def test_best_k_prefers_small_k_on_a_tie(spark):
    sweep = spark.createDataFrame(
        [(2, 0.5, 1.0), (3, 0.6, 0.9), (4, 0.6, 0.9)],
        "k int, silhouette double, davies_bouldin double",
    )
    assert tuple(best_k(sweep).first()) == (3, 0.6, 3, 0.9)


def test_dbscan_parameter_choice(spark):
    schema = "eps double, min_samples int, n_clusters int, n_noise int, noise_pct double, " \
             "silhouette double"
    grid = [(0.1, 3, 3, 9, 60.0, 0.9), (0.2, 3, 2, 9, 40.0, 0.3), (0.3, 3, 1, 0, 0.0, None)]

    def pick(rows):
        r = cs.select_dbscan_params(spark.createDataFrame(rows, schema)).first()
        return r.eps, r.min_samples

    assert pick(grid) == (0.2, 3)
    assert pick([grid[0], grid[2]]) == (0.1, 3)
    assert pick([(0.1, 3, 0, 9, 100.0, None)]) == (0.05, 3)


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert [tuple(r)[2:] for r in standardize(df, ["x", "y"]).orderBy("x").collect()] == [
        (-1.0, 0.0), (1.0, 0.0),
    ]
    assert Scaler.fit(df, ["x", "y"]).scales == (1.0, 1.0)


def test_silhouette_kernel_works_in_small_tiles(data, monkeypatch):
    """Tiles of distances are bounded, and how many there are changes nothing."""
    x, label, df = data
    monkeypatch.setattr(cl, "_TILE", 300)
    samples = cl.silhouette_samples(df, ["x", "y"], block_rows=100)
    assert cl.silhouette_exact(samples).first()[0] == pytest.approx(silhouettes(x, label).mean())
