"""All fits of a search share their passes, and equal points are one point with a weight."""

import numpy as np
import pytest

from casegrid.operators import kmeans, labellings


def test_weighted_scores_equal_those_of_repeated_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(int(i % 2), int(draw.integers(0, 4)), *map(float, draw.normal(size=2)), int(draw.integers(1, 5)))
            for i in range(200)]
    rows.append((0, 9, 3.0, 3.0, 2))  # equal rows of one cluster
    df = spark.createDataFrame(rows, "g int, cluster long, x double, y double, w long")
    repeated = df.selectExpr("g", "cluster", "x", "y", "explode(sequence(1l, w))")
    want = {r.g: r for r in labellings.score_labellings(repeated, ["x", "y"]).collect()}
    got = {r.g: r for r in labellings.score_labellings(df, ["x", "y"], weight="w").collect()}
    assert set(got) == set(want) == {0, 1}
    for g, r in got.items():
        assert tuple(r) == pytest.approx(tuple(want[g]))


def test_the_fits_of_a_search_share_their_passes(spark, monkeypatch):
    """A pass moves every start of every k; each fit ends where single rounds of numpy end."""
    draw = np.random.default_rng(7)
    x = np.vstack([draw.normal(c, 0.1, (40, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in np.vstack([x, x])], "x double, y double")
    passes = []
    one = kmeans._round
    monkeypatch.setattr(kmeans, "_round", lambda *a: passes.append(len(a[2])) or one(*a))
    found = {r.k: r for r in kmeans.k_sweep(df, ["x", "y"], (2, 4), n_init=3).collect()}
    assert passes[0] == passes[-1] == 9
    z = (np.vstack([x, x]) - x.mean(0)) / x.std(0)
    means = np.array([z.reshape(2, 3, 40, 2)[:, i].reshape(-1, 2).mean(0) for i in range(3)])
    cost = ((z[:, None] - means[None]) ** 2).sum(2).min(1).sum()
    assert found[3].inertia == pytest.approx(cost, rel=1e-3)


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(float(i % 3),) for i in range(30)], "x double")
    fitted = kmeans.fit_kmeans(df, ["x"], k=5, n_init=2)
    assert len(fitted.model.clusterCenters()) == 3 and fitted.inertia == pytest.approx(0.0)


def test_a_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    with pytest.raises(Exception, match="finite"):
        kmeans.fit_kmeans(df, ["x"], k=2, n_init=1)
