"""K-means on standardised features: fits, assignment and the search for k.

All starts of all k move on together: one pass over the points draws the next
seed of every start, and one pass is a round of every fit that still moves.  So
the number of jobs does not grow with the number of fits.  Equal points are one
point with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize
from .clusters import silhouette_exact, silhouette_samples
from .labellings import score_labellings
from .scaling import Scaler

#: Centres that move less than this (in deviations) are at rest.
TOLERANCE = 1e-4
#: Distinct points of one task, where the cores allow it.
_TASK_POINTS = 8_000
#: Partial sums of so many tasks are added by the driver, those of more by Spark first.
_FEW_TASKS = 32
_WEIGHT = "_w"


@dataclass(frozen=True)
class Centers:
    """Centres of a fit in standardised units; the lowest index wins a tie."""

    points: tuple[tuple[float, ...], ...]

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) for c in self.points]


@dataclass(frozen=True)
class FittedKMeans:
    model: Centers
    scaler: Scaler
    inertia: float
    start_costs: tuple[float, ...] = ()

    @property
    def features(self) -> list[str]:
        return list(self.scaler.features)

    def transform(self, df: DataFrame, label="cluster") -> DataFrame:
        """Rows with the label of their nearest centre."""
        z = [f"_z_{c}" for c in self.features]
        scaled = self.scaler.transform(df, prefix="_z_")
        return scaled.withColumn(label, _nearest(z, self.model.points)).drop(*z)

    def centers(self, spark) -> DataFrame:
        """Centres in the original units."""
        rows = [
            (i, *map(float, self.scaler.inverse(center)))
            for i, center in enumerate(self.model.clusterCenters())
        ]
        schema = "cluster int, " + ", ".join(f"`{c}` double" for c in self.features)
        return spark.createDataFrame(rows, schema)


def certificate(fitted: FittedKMeans, df: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """One row of invariants of a fit on the rows it was made from.

    `not_nearest` counts rows whose label is not their nearest centre, `at_means`
    says whether every centre is the mean of its rows (a fit ends when centres
    move less than its own tolerance), `sums_add_up` whether the squared
    distances within clusters and those of the clusters from the overall mean
    make up `total`, and `best_of_starts` whether no start had a lower cost.
    """
    z = [f"_z_{c}" for c in fitted.features]
    centers = [c.tolist() for c in fitted.model.clusterCenters()]
    rows = fitted.scaler.transform(fitted.transform(df), prefix="_z_")
    near = [_squared(z, c) for c in centers]
    best = F.least(*near) if len(near) > 1 else near[0]
    own = F.array(*near)[F.col("cluster")]
    means = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(own > best).alias("not_nearest"),
        F.sum(own).alias("within"), *[F.avg(c).alias(c) for c in z],
    )
    overall = rows.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(z)],
        (sum((F.var_pop(c) for c in z[1:]), F.var_pop(z[0])) * F.count(F.lit(1))).alias("total"),
    )
    drift = F.array(*[_squared(z, c) for c in centers])[F.col("cluster")]
    apart = sum(
        (F.col(c) - F.col(f"m{i}")) * (F.col(c) - F.col(f"m{i}")) for i, c in enumerate(z)
    )
    # a row per centre, and one row
    both = means.join(F.broadcast(overall))
    within, total = F.sum("within"), F.first("total")
    # the within sums are taken around the centres, the between ones around the means
    moved = F.sum(F.col("n") * drift)
    return both.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).cast("int").alias("n_clusters"),
        F.sum("not_nearest").cast("int").alias("not_nearest"),
        (F.max(F.sqrt(drift)) <= tolerance).alias("at_means"),
        (F.abs(within - moved + F.sum(F.col("n") * apart) - total) <= tolerance * total).alias("sums_add_up"),
        F.lit(fitted.inertia <= min(fitted.start_costs)).alias("best_of_starts"),
        total.alias("total"),
    )


def _squared(features: list[str], center) -> Column:
    terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(features, center)]
    return sum(terms[1:], terms[0])


def _nearest(features: list[str], points) -> Column:
    ranked = [
        F.struct(_squared(features, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(points)
    ]
    return F.array_min(F.array(*ranked))["i"]


def _weighted_points(df: DataFrame, scaler: Scaler) -> DataFrame:
    """The distinct standardised points with their number of rows, dealt out to all cores."""
    z = [f"_z_{c}" for c in scaler.features]
    points = scaler.transform(df.select(*scaler.features), prefix="_z_").groupBy(*z).agg(
        F.count(F.lit(1)).cast("double").alias(_WEIGHT)
    )
    points = materialize(points)
    # a set number of partitions: the work of a round does not show in its bytes
    cores = df.sparkSession.sparkContext.defaultParallelism
    return points.repartition(min(2 * cores, 1 + points.count() // _TASK_POINTS), *z)


def _draws(x: np.ndarray, seed: int) -> np.ndarray:
    """A number in (0, 1] per point that depends on the point and the seed only."""
    h = np.full(len(x), (seed * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for column in (x + 0.0).T:  # -0.0 becomes 0.0
        h ^= np.ascontiguousarray(column).view(np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(float) + 1.0) / 2.0**53


def _columns(batch: pd.DataFrame, z: list[str]) -> tuple[np.ndarray, np.ndarray]:
    x = batch[z].to_numpy(float)
    if not np.isfinite(x).all():
        raise ValueError("K-means needs finite features in every row")
    return x, batch[_WEIGHT].to_numpy(float)


def _seed_kernel(z: list[str], starts: list[list], seed: int):
    """The point of the least draw for each start: the next seed, drawn by weight and squared distance."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict = {}
        for batch in batches:
            x, w = _columns(batch, z)
            for i, chosen in enumerate(starts):
                d2 = np.ones(len(x)) if not chosen else np.full(len(x), np.inf)
                for c in chosen:
                    np.minimum(d2, ((x - c) ** 2).sum(1), out=d2)
                # the least of exponential times with these rates falls on a row by its rate
                with np.errstate(divide="ignore"):
                    t = -np.log(_draws(x, (seed + i) * 1009 + len(chosen))) / (w * d2)
                t[d2 <= 0] = np.inf
                at = int(t.argmin()) if len(t) else -1
                if at >= 0 and np.isfinite(t[at]):
                    found = (float(t[at]), x[at].tolist())
                    best[i] = min(best.get(i, found), found)
        yield pd.DataFrame(
            [(i, t, x) for i, (t, x) in best.items()], columns=["start", "t", "x"]
        )

    return run


def _seeds(
    points: DataFrame, z: list[str], k: int, n_init: int, seed: int, tasks: int
) -> list[list]:
    """k-means++ seeds of each start; fewer than k where there are fewer distinct points.

    The first seeds for a larger k are seeds for a smaller one.
    """
    starts: list[list] = [[] for _ in range(n_init)]
    for step in range(k):
        found = points.mapInPandas(
            _seed_kernel(z, starts, seed), "start int, t double, x array<double>"
        )
        if tasks > _FEW_TASKS:
            found = found.groupBy("start").agg(F.min(F.struct("t", "x")).alias("b")).select("start", "b.*")
        drawn: dict = {}
        for r in found.collect():  # one point a start
            one = (r["t"], r["x"])
            drawn[r["start"]] = min(drawn.get(r["start"], one), one)
        for i, (_, x) in drawn.items():
            starts[i].append(list(x))
        if all(len(chosen) <= step for chosen in starts):
            break
    return starts


def _round_kernel(z: list[str], fits: dict):
    """(fit, cluster): weight, sums of the features and squared distances of its points."""
    names = list(fits)
    centers = [np.array(fits[f]) for f in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = [np.zeros((len(c), len(z) + 2)) for c in centers]
        for batch in batches:
            x, w = _columns(batch, z)
            columns = [np.ascontiguousarray(c) for c in x.T]
            for c, total in zip(centers, totals):
                label, near = np.zeros(len(x), np.intp), None
                for j, center in enumerate(c):
                    d2 = (columns[0] - center[0]) ** 2
                    for column, v in zip(columns[1:], center[1:]):
                        d2 += (column - v) ** 2
                    if near is None:
                        near = d2
                    else:
                        label[d2 < near] = j
                        np.minimum(near, d2, out=near)
                for i, value in enumerate((w, w * near, *[w * column for column in columns])):
                    total[:, i] += np.bincount(label, value, len(c))
        yield pd.DataFrame(
            [(f, j, r[0], r[1], r[2:].tolist()) for f, total in enumerate(totals)
             for j, r in enumerate(total) if r[0]],
            columns=["fit", "cluster", "n", "cost", "x"],
        )

    return run


def _round(points: DataFrame, z: list[str], fits: dict, tasks: int) -> dict:
    """fit -> (cost, means of the clusters that have points)."""
    names = list(fits)
    parts = points.mapInPandas(
        _round_kernel(z, fits), "fit int, cluster int, n double, cost double, x array<double>"
    )
    if tasks > _FEW_TASKS:
        parts = parts.groupBy("fit", "cluster").agg(
            F.sum("n").alias("n"), F.sum("cost").alias("cost"),
            F.array(*[F.sum(F.col("x")[i]) for i in range(len(z))]).alias("x"),
        )
    totals: dict = {name: {} for name in names}
    for r in parts.collect():  # a row per centre
        one = totals[names[r["fit"]]]
        one[r["cluster"]] = one.get(r["cluster"], 0.0) + np.array([r["cost"], r["n"], *r["x"]])
    return {
        name: (float(sum(v[0] for v in found.values())),
               {j: (v[2:] / v[1]).tolist() for j, v in found.items()})
        for name, found in totals.items()
    }


def _best_fits(points: DataFrame, z: list[str], ks, n_init: int, max_iter: int, seed: int) -> dict:
    """k -> (cost, centres, costs of all starts): best of several seeded starts for every k."""
    ks = list(ks)
    tasks = points.rdd.getNumPartitions()
    starts = _seeds(points, z, max(ks), n_init, seed, tasks)
    fits = {(k, i): starts[i][:k] for k in ks for i in range(n_init)}
    moving = dict(fits)
    for _ in range(max_iter):
        for name, (_, means) in _round(points, z, moving, tasks).items():
            old = fits[name]
            fits[name] = [means.get(j, c) for j, c in enumerate(old)]
            if max((math.dist(a, b) for a, b in zip(old, fits[name])), default=0.0) <= TOLERANCE:
                del moving[name]
        moving = {name: fits[name] for name in moving}
        if not moving:
            break
    costs = {name: cost for name, (cost, _) in _round(points, z, fits, tasks).items()}
    best = {}
    for k in ks:
        own = tuple(costs[k, i] for i in range(n_init))
        least = min(range(n_init), key=lambda i: (own[i], i))
        best[k] = (own[least], Centers(tuple(map(tuple, fits[k, least]))), own)
    return best


def fit_kmeans(
    df: DataFrame, features, k: int = K.KMEANS_DEFAULTS["k"],
    n_init: int = K.KMEANS_DEFAULTS["n_init"],
    max_iter: int = K.KMEANS_DEFAULTS["max_iter"], seed: int = K.KMEANS_DEFAULTS["seed"],
) -> FittedKMeans:
    scaler = Scaler.fit(df, features)
    points = _weighted_points(df, scaler).persist()
    try:
        z = [f"_z_{c}" for c in scaler.features]
        cost, model, costs = _best_fits(points, z, [k], n_init, max_iter, seed)[k]
    finally:
        points.unpersist()
    return FittedKMeans(model, scaler, cost, costs)


def k_sweep(
    df: DataFrame, features, k_range=(2, 10), n_init: int = K.KMEANS_DEFAULTS["n_init"],
    max_iter: int = K.KMEANS_DEFAULTS["max_iter"], seed: int = K.KMEANS_DEFAULTS["seed"],
    exact: bool = False,
) -> DataFrame:
    """Inertia, silhouette and Davies-Bouldin for every k of the range.

    All fits share their passes; one projection then names the nearest centre
    for all k, and all labellings are scored together.  The silhouette is the
    linear squared-distance one, under its own name; ``exact=True`` takes the
    Euclidean one, which needs all distances.
    """
    features = list(features)
    scaler = Scaler.fit(df, features)
    z = [f"_z_{c}" for c in features]
    points = _weighted_points(df, scaler).persist()
    try:
        fits = _best_fits(points, z, range(k_range[0], k_range[1] + 1), n_init, max_iter, seed)
        centers = {k: model.points for k, (_, model, _) in fits.items()}
        labelled = label_with_centers(points, z, centers, [_WEIGHT])
        scores = materialize(score_labellings(labelled, z, weight=_WEIGHT))
    finally:
        points.unpersist()
    name = "silhouette" if exact else "silhouette_squared"
    if exact:
        rows = label_with_centers(scaler.transform(df.select(*features), prefix="_z_"), z, centers)
        rows = materialize(rows)
        found = [
            (k, silhouette_exact(silhouette_samples(rows.filter(F.col("g") == k), z)).first()[0])
            for k in centers
        ]
        euclidean = df.sparkSession.createDataFrame(found, "g int, silhouette double")
        scores = scores.join(F.broadcast(euclidean), "g")
    return scores.select(F.col("g").alias("k"), "inertia", name, "davies_bouldin")


def label_with_centers(df: DataFrame, features, centers: dict, keep=()) -> DataFrame:
    """(g, cluster, features, kept columns): every row once for each set of centres, with its nearest one.

    `centers` maps g to a list of centres; the lowest index wins a tie.
    """
    labels = F.array(*[
        F.struct(F.lit(g).alias("g"), _nearest(features, points).cast("bigint").alias("cluster"))
        for g, points in centers.items()
    ])
    return df.select(F.inline(labels), *features, *keep)


def best_k(sweep: DataFrame) -> DataFrame:
    """k with the greatest silhouette, exact or squared, and k with the least Davies-Bouldin."""
    name = "silhouette" if "silhouette" in sweep.columns else "silhouette_squared"
    return sweep.agg(
        F.max(F.struct(name, (-F.col("k")).alias("m"))).alias("s"),
        F.min(F.struct("davies_bouldin", "k")).alias("d"),
    ).select(
        (-F.col("s.m")).alias("k_silhouette"), F.col(f"s.{name}").alias("silhouette"),
        F.col("d.k").alias("k_davies_bouldin"),
        F.col("d.davies_bouldin").alias("davies_bouldin"),
    )
