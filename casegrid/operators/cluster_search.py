"""DBSCAN parameter search and the comparison of clustering methods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import cut_lineage
from .clusters import (
    davies_bouldin,
    noise_stats,
    silhouette_exact,
    silhouette_samples,
    silhouette_squared,
)
from .dbscan import dbscan, dbscan_grid_labels
from .kmeans import fit_kmeans
from .labellings import score_labellings
from .scaling import Scaler


def dbscan_grid(
    df: DataFrame, features, eps_list=K.DBSCAN_EPS_GRID,
    min_samples_list=K.DBSCAN_MIN_SAMPLES_GRID, row_id="row_id", exact=False,
) -> DataFrame:
    """Clusters, noise and quality for every (eps, min_samples) pair.

    All pairs are labelled through the same joins and scored together.  The
    silhouette is the linear squared one unless the ``exact`` one is asked for,
    which compares all points of one pair after the other.
    """
    features = list(features)
    spark = df.sparkSession
    z = [f"_z_{c}" for c in features]
    scaled = cut_lineage(
        Scaler.fit(df, features).transform(df.select(row_id, *features), prefix="_z_")
    )
    params = [(float(e), int(m)) for e in eps_list for m in min_samples_list]
    labels = cut_lineage(dbscan_grid_labels(scaled, z, params, row_id))
    one = F.count(F.lit(1))
    noise = labels.groupBy("g").agg(
        F.count_if(F.col("label") < 0).alias("n_noise"),
        (F.count_if(F.col("label") < 0) * 100.0 / one).alias("noise_pct"),
    )
    labelled = scaled.select(row_id, *z).join(labels, row_id).withColumn(
        "cluster", F.col("label").cast("bigint")
    )
    scores = score_labellings(labelled, z).withColumnRenamed("silhouette_squared", "silhouette")
    if exact:
        found = []
        for r in scores.filter("n_clusters > 1").select("g").collect():  # at most one a pair
            own = labelled.filter(F.col("g") == r["g"])
            found.append((r["g"], silhouette_exact(silhouette_samples(own, z)).first()[0]))
        euclidean = spark.createDataFrame(found, "g int, silhouette double")
        scores = scores.drop("silhouette").join(F.broadcast(euclidean), "g", "left")
    pairs = spark.createDataFrame(
        [(g, *p) for g, p in enumerate(params)], "g int, eps double, min_samples int"
    )
    return pairs.join(noise, "g", "left").join(scores, "g", "left").select(
        "eps", "min_samples", F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"),
        F.coalesce("n_noise", F.lit(0)).alias("n_noise"), "noise_pct", "silhouette",
        "davies_bouldin",
    )


def select_dbscan_params(grid: DataFrame, fallback=None) -> DataFrame:
    """Best valid pair, else the pair with most clusters, else the fallback.

    Valid: more than one cluster, under 50 % noise, a silhouette.
    """
    fallback = fallback or K.DBSCAN_FALLBACK
    valid = (
        (F.col("n_clusters") > 1) & (F.col("noise_pct") < 50) & F.col("silhouette").isNotNull()
    )
    usable = (F.col("n_clusters") > 0) & (F.col("noise_pct") < 80)
    ranked = grid.select(
        "eps", "min_samples",
        F.when(valid, 0).when(usable, 1).alias("tier"),
        F.when(valid, F.col("silhouette")).otherwise(F.col("n_clusters").cast("double"))
        .alias("score"),
    ).filter(F.col("tier").isNotNull())
    best = ranked.agg(
        F.min(F.struct("tier", (-F.col("score")).alias("s"), "eps", "min_samples")).alias("b")
    )
    return best.select(
        F.coalesce("b.eps", F.lit(fallback["eps"])).alias("eps"),
        F.coalesce("b.min_samples", F.lit(fallback["min_samples"])).alias("min_samples"),
        F.coalesce("b.tier", F.lit(2)).alias("tier"),
    )


def _silhouette(labelled: DataFrame, z, exact: bool) -> float:
    if exact:
        return silhouette_exact(silhouette_samples(labelled, z)).first()[0]
    return silhouette_squared(labelled, z)


def compare_methods(
    df: DataFrame, features, k=5, eps=0.01, min_samples=5, n_init=10, row_id="row_id", exact=False
) -> DataFrame:
    """One row per method with its quality, plus which one is recommended.

    The silhouette is the linear squared one unless the ``exact`` one is asked for.
    """
    features = list(features)
    spark = df.sparkSession
    z = [f"_z_{c}" for c in features]
    fitted = fit_kmeans(df, features, k=k, n_init=n_init)
    scaled = cut_lineage(fitted.scaler.transform(df.select(row_id, *features), prefix="_z_"))
    km = fitted.transform(df.select(row_id, *features))
    km = scaled.join(km.select(row_id, "cluster"), row_id)
    db = dbscan(scaled, z, eps, min_samples, row_id)
    db = scaled.join(db.select(row_id, F.col("label").cast("bigint").alias("cluster")), row_id)
    rows = []
    for method, labelled, cost, text in (
        ("K-Means", km, fitted.inertia, f"k={k}"),
        ("DBSCAN", db, None, f"eps={eps}, min_samples={min_samples}"),
    ):
        labelled = cut_lineage(labelled)
        noise = noise_stats(labelled).first()
        sil = dbi = None
        if noise["n_clusters"] > 1:
            sil = _silhouette(labelled, z, exact)
            dbi = davies_bouldin(labelled, z).first()[0]
        n_clusters = k if method == "K-Means" else noise["n_clusters"]
        rows.append((method, n_clusters, sil, dbi, cost, noise["n_noise"], text))
    km_sil, db_sil = rows[0][2], rows[1][2]
    pick = "K-Means" if db_sil is None or (km_sil is not None and km_sil > db_sil) else "DBSCAN"
    if km_sil is None and db_sil is None:
        pick = None
    return spark.createDataFrame(
        [(*r, r[0] == pick) for r in rows],
        "method string, n_clusters bigint, silhouette double, davies_bouldin double, "
        "inertia double, noise_points bigint, parameters string, recommended boolean",
    )
