"""Statistics and quality measures of rows that already carry a cluster label."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import cluster_color, percent_label
from ..session import cut_lineage
from .ordering import mode_per_group
from .pairwise import block_count, compare_blocks
from .labellings import PAGE, score_labellings, worst_by_tiles
from .summaries import category_counts

NOISE = -1
BLOCK_ROWS = 4096
#: Distances worked out at a time: two such tables stay in a core's cache.
_TILE = 65_536


def without_noise(df: DataFrame, label="cluster") -> DataFrame:
    return df.filter(F.col(label) != NOISE)


def _count_map(df: DataFrame, label: str, col: str, name: str) -> DataFrame:
    """value -> count map per cluster, of the most frequent values where there are many.

    `summaries.category_counts` gives all of them in long form.
    """
    counts = category_counts(df.select(label, col), [col], label, K.MAP_CATEGORIES)
    return counts.groupBy(label).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "n")))).alias(name)
    )


def cluster_statistics(
    df: DataFrame, label="cluster", lat="latitude", lon="longitude", gender=None,
    age_group=None, age=None, location=None, unit=None,
) -> DataFrame:
    """Size, share of all rows (noise included), centre and who/where per cluster."""
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = without_noise(df, label)
    measures = [
        F.count(F.lit(1)).alias("size"),
        F.avg(lat).alias("center_lat"),
        F.avg(lon).alias("center_lon"),
    ]
    if age and not age_group:
        measures.append(F.avg(age).alias("avg_age"))
    out = rows.groupBy(label).agg(*measures)
    out = out.withColumn("share_pct", F.col("size") * 100.0 / total)
    out = out.withColumn("share_label", percent_label("share_pct"))
    extras = []
    if gender:
        extras.append(_count_map(rows, label, gender, "gender_distribution"))
    if age_group:
        extras.append(_count_map(rows, label, age_group, "age_distribution"))
    for col, name in ((location, "top_location"), (unit, "top_unit")):
        if col:
            extras.append(
                mode_per_group(rows, label, col).select(label, F.col("value").alias(name))
            )
    for extra in extras:
        out = out.join(extra, label, "left")
    return out


def cluster_counts(df: DataFrame, label="cluster", measured="latitude", location="district"):
    return df.groupBy(label).agg(
        F.count(measured).alias("records"), F.count_distinct(location).alias("locations")
    )


def target_groups(df: DataFrame, label="cluster", gender="gender", age_group="age_group"):
    """Dominant gender and age group of each cluster with their shares."""
    rows = without_noise(df, label)
    out = rows.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    for col, name in ((gender, "gender"), (age_group, "age")):
        best = mode_per_group(rows, label, col).select(
            label, F.col("value").alias(f"_{name}"), F.col("n").alias(f"_{name}_n")
        )
        out = out.join(best, label, "left")

    def text(name):
        pct = F.col(f"_{name}_n") * 100.0 / F.col("size")
        return F.when(
            F.col(f"_{name}").isNotNull(),
            F.concat(F.col(f"_{name}"), F.lit(" ("), percent_label(pct, 0), F.lit(")")),
        )

    description = F.concat_ws(
        " ",
        F.split_part(F.col("_gender"), F.lit(" "), F.lit(1)),
        F.trim(F.split_part(F.col("_age"), F.lit("("), F.lit(1))),
    )
    return out.select(
        label, "size",
        text("gender").alias("dominant_gender"),
        text("age").alias("dominant_age_group"),
        F.when(description == "", F.concat(F.lit("Cluster "), F.col(label)))
        .otherwise(description).alias("description"),
    )


def cluster_sizes(df: DataFrame, label="cluster") -> DataFrame:
    return without_noise(df, label).groupBy(label).agg(F.count(F.lit(1)).alias("size"))


def cluster_balance(df: DataFrame, label="cluster") -> DataFrame:
    """Coefficient of variation of the sizes; NULL with fewer than two clusters."""
    return cluster_sizes(df, label).agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.when(
            F.count(F.lit(1)) > 1, F.stddev_pop("size") / F.avg("size")
        ).alias("balance"),
    )


def cluster_spread(df: DataFrame, label="cluster", lat="latitude", lon="longitude"):
    spread = without_noise(df, label).groupBy(label).agg(
        F.stddev_pop(lat).alias("lat_std"), F.stddev_pop(lon).alias("lon_std")
    )
    return spread.withColumn("avg_spread", (F.col("lat_std") + F.col("lon_std")) / 2)


def cluster_ellipse(df: DataFrame, x: str, y: str, label="cluster") -> DataFrame:
    """Centre and axes of the outline drawn round a demographic cluster."""
    stats = df.groupBy(label).agg(
        F.avg(x).alias("center_x"),
        F.avg(y).alias("center_y"),
        (F.coalesce(F.stddev_pop(x), F.lit(0.0)) * 3).alias("width"),
        F.count_distinct(y).alias("_levels"),
    )
    return stats.select(
        label, "center_x", "center_y",
        F.when(F.col("width") == 0, 4.0).otherwise(F.col("width")).alias("width"),
        F.when(F.col("_levels") > 1, 1.6).otherwise(0.7).alias("height"),
    )


def noise_stats(df: DataFrame, label="cluster") -> DataFrame:
    noise = F.count_if(F.col(label) == NOISE)
    return df.agg(
        noise.alias("n_noise"),
        (noise * 100.0 / F.count(F.lit(1))).alias("noise_pct"),
        F.count_distinct(F.when(F.col(label) != NOISE, F.col(label))).alias("n_clusters"),
    )


def cluster_markers(df: DataFrame, label="cluster", lat="latitude", lon="longitude"):
    return without_noise(df, label).groupBy(label).agg(
        F.avg(lat).alias("latitude"), F.avg(lon).alias("longitude"),
        F.count(F.lit(1)).alias("size"),
    ).withColumn("color", cluster_color(label))


# --- quality measures -------------------------------------------------------------

def _centroids(df: DataFrame, features, label) -> DataFrame:
    return df.groupBy(label).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in features], F.count(F.lit(1)).alias("_size")
    )


def _to_own_centroid(df: DataFrame, features, label) -> DataFrame:
    """Each row with its squared distance to its cluster's centroid."""
    near = df.join(_centroids(df, features, label), label)
    terms = [(F.col(c) - F.col(f"_m_{c}")) * (F.col(c) - F.col(f"_m_{c}")) for c in features]
    return near.withColumn("_d2", sum(terms[1:], terms[0]))


def inertia(df: DataFrame, features, label="cluster") -> DataFrame:
    """Sum of squared distances to the own centroid, noise left out."""
    rows = without_noise(df, label)
    return _to_own_centroid(rows, features, label).agg(F.sum("_d2").alias("inertia"))


def davies_bouldin(df: DataFrame, features, label="cluster") -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance."""
    features = list(features)
    rows = without_noise(df, label).select(label, *features)
    own = cut_lineage(
        _to_own_centroid(rows, features, label)
        .groupBy(label)
        .agg(
            F.avg(F.sqrt("_d2")).alias("_s"),
            *[F.first(f"_m_{c}").alias(f"_m_{c}") for c in features],
        )
    )
    k = own.count()
    cols = [f"_m_{c}" for c in features]

    def worst(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        diff = a[cols].to_numpy()[:, None, :] - b[cols].to_numpy()[None, :, :]
        dist = np.sqrt((diff**2).sum(axis=2))
        spread = a["_s"].to_numpy()[:, None] + b["_s"].to_numpy()[None, :]
        ratio = np.where(dist > 0, spread / np.where(dist > 0, dist, 1.0), 0.0)
        ratio[a[label].to_numpy()[:, None] == b[label].to_numpy()[None, :]] = 0.0
        return pd.DataFrame({"label": a[label], "ratio": ratio.max(axis=1)})

    blocks = block_count(k, BLOCK_ROWS // 4)
    if blocks > 1:
        table = own.select(
            F.lit(0).alias("g"), F.col(label).alias("cluster"), F.col("_s").alias("s"),
            F.array(*cols).alias("m"),
        )
        ratios = worst_by_tiles(table, len(features)).withColumnRenamed("cluster", "label")
    else:
        ratios = compare_blocks(
            own, own, worst, "label bigint, ratio double", blocks, blocks, label, label
        )
    per_cluster = ratios.groupBy("label").agg(F.max("ratio").alias("ratio"))
    return per_cluster.agg(
        F.when(F.count(F.lit(1)) > 1, F.avg("ratio")).alias("davies_bouldin")
    )


def silhouette_samples(df: DataFrame, features, label="cluster", block_rows=BLOCK_ROWS):
    """Exact Euclidean silhouette of each distinct (point, label) with its weight.

    Equal points of one cluster are compared once and counted by weight.  The
    comparison runs block against block; a task holds two blocks at a time.
    """
    features = list(features)
    points = cut_lineage(
        without_noise(df, label)
        .groupBy(label, *features)
        .agg(F.count(F.lit(1)).alias("w"))
        .withColumn("pid", F.xxhash64(label, *features))
    )
    blocks = block_count(points.count(), block_rows)

    def sums(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(label, kind="stable")  # a cluster is one run of columns
        x, y = a[features].to_numpy(float), b[features].to_numpy(float)
        groups, first = np.unique(b[label].to_numpy(), return_index=True)
        weights = b["w"].to_numpy(float)
        total = np.empty((len(a), len(groups)))
        step = max(1, _TILE // max(len(b), 1))
        d, part = np.empty((step, len(b))), np.empty((step, len(b)))
        for i in range(0, len(a), step):
            rows = x[i:i + step]
            near, own = d[: len(rows)], part[: len(rows)]
            near.fill(0.0)
            for f in range(len(features)):
                np.subtract(rows[:, f, None], y[None, :, f], out=own)
                np.multiply(own, own, out=own)
                np.add(near, own, out=near)
            np.sqrt(near, out=near)
            np.multiply(near, weights, out=near)
            total[i:i + step] = np.add.reduceat(near, first, axis=1)
        n = len(groups)
        out = {c: np.repeat(a[c].to_numpy(), n) for c in [label, *features, "w"]}
        out["other"] = np.tile(groups, len(a))
        out["dist"] = total.ravel()
        return pd.DataFrame(out)

    feats = ", ".join(f"`{c}` double" for c in features)
    schema = f"`{label}` bigint, {feats}, w bigint, other bigint, dist double"
    parts = compare_blocks(points, points, sums, schema, blocks, blocks, "pid", "pid")
    sizes = points.groupBy(label).agg(F.sum("w").alias("size"))
    to_cluster = (
        parts.groupBy(label, *features, "w", "other")
        .agg(F.sum("dist").alias("dist"))
        .join(sizes.select(F.col(label).alias("other"), "size"), "other")
    )
    own = F.col("other") == F.col(label)
    ab = to_cluster.groupBy(label, *features, "w").agg(
        F.max(F.when(own, F.col("size"))).alias("_size"),
        F.max(F.when(own, F.try_divide(F.col("dist"), F.col("size") - 1))).alias("_a"),
        F.min(F.when(~own, F.col("dist") / F.col("size"))).alias("_b"),
    )
    s = F.when(F.col("_size") == 1, 0.0).otherwise(
        F.coalesce(
            F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0)
        )
    )
    return ab.withColumn("silhouette", F.when(F.col("_b").isNotNull(), s)).drop("_size", "_a", "_b")


def silhouette_per_cluster(samples: DataFrame, label="cluster") -> DataFrame:
    return samples.groupBy(label).agg(
        (F.sum(F.col("silhouette") * F.col("w")) / F.sum("w")).alias("silhouette")
    )


def silhouette_exact(samples: DataFrame) -> DataFrame:
    """Mean silhouette; NULL with fewer than two clusters."""
    return samples.agg(
        (F.sum(F.col("silhouette") * F.col("w")) / F.sum("w")).alias("silhouette")
    )


def silhouette_squared(df: DataFrame, features, label="cluster") -> float:
    """Silhouette on squared distances: one linear pass, a different number.

    The evaluator compares each row with every cluster; with more than a page of
    clusters rows meet those only that can be the nearest.
    """
    rows = without_noise(df, label)
    if rows.select(label).distinct().count() > PAGE:
        one = rows.select(F.lit(0).alias("g"), F.col(label).alias("cluster"), *features)
        return score_labellings(one, features).first()["silhouette_squared"]
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol=label)
    return evaluator.evaluate(vectors)


def quality_report(
    df: DataFrame, features, label="cluster", lat=None, lon=None, exact: bool = True
) -> DataFrame:
    """Long table of every quality measure: scope, cluster, metric, value.

    The silhouette compares all distinct points with each other; `exact=False`
    takes the linear squared one instead, under the name `silhouette_squared` and
    for the whole only.
    """
    features = list(features)
    none = F.lit(None).cast("bigint")

    def overall(one_row: DataFrame, *metrics):
        pairs = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
              for m in metrics]
        )
        return one_row.select(none.alias("cluster"), F.inline(pairs))

    def each(frame: DataFrame, *metrics):
        pairs = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
              for m in metrics]
        )
        return frame.select(F.col(label).cast("bigint").alias("cluster"), F.inline(pairs))

    parts = [
        overall(df.agg(F.count(F.lit(1)).alias("n_samples")), "n_samples"),
        overall(noise_stats(df, label), "n_noise", "n_clusters"),
        overall(cluster_balance(df, label), "balance"),
        each(cluster_sizes(df, label), "size"),
    ]
    if exact:
        samples = cut_lineage(silhouette_samples(df, features, label))
        parts += [
            overall(silhouette_exact(samples), "silhouette"),
            each(silhouette_per_cluster(samples, label), "silhouette"),
            overall(davies_bouldin(df, features, label), "davies_bouldin"),
            overall(inertia(df, features, label), "inertia"),
        ]
    else:
        rows = df.select(F.lit(0).alias("g"), F.col(label).alias("cluster"), *features)
        scores = score_labellings(rows, features)
        parts.append(overall(scores, "silhouette_squared", "davies_bouldin", "inertia"))
    if lat and lon:
        parts.append(each(cluster_spread(df, label, lat, lon), "lat_std", "lon_std", "avg_spread"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def nearest_center(df: DataFrame, features, centers: list[list[float]], out="cluster"):
    """Index of the nearest given centre (lowest index on a tie)."""
    def dist(center):
        terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
                 for c, v in zip(features, center)]
        return sum(terms[1:], terms[0])

    ranked = F.array(
        *[F.struct(dist(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]
    )
    return df.withColumn(out, F.array_min(ranked)["i"])
