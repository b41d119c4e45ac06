"""Centroid clustering with an incremental distance matrix.

Every vector keeps its exact integer dot product with every centroid.  A round
adds to them only what the changed components of the centroids bring, and the
squared distance follows as |x|^2 - 2 x.c + |c|^2, all in 64-bit integers, so
assignments are those of a full computation.  Only the centroids and their sums
(at most `k` rows) pass the driver.

The state of a round is cached on the executors and dropped after the next one.
A lost executor's part is made again from the input by the rounds so far, which
need nothing but the rows of that part and the short list of centroids: no round
shuffles vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Scaled components stay below this, so that squared distances of up to 64 fit in 64 bits.
LIMIT = 1 << 27

_STATE = "vec_id long, x array<long>, dots array<long>, cluster int, distance long"


def integer_vectors(rows: DataFrame, dims: int = 64, scale: int = 256, vector: str = "embedding",
                    vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, x): components as floor(scale * value) of the vectors that are kept.

    Kept are vectors of exactly `dims` components, none NULL or non-finite.  A
    scaled component of 2**27 or more in absolute value raises an error.
    """
    finite = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    )

    def scaled(v: Column) -> Column:
        product = v.cast("double") * F.lit(float(scale))
        error = F.raise_error(F.lit("a vector component is too large for exact distances")).cast("long")
        return F.when(F.abs(product) < LIMIT, F.floor(product)).otherwise(error)

    return rows.filter((F.size(vector) == dims) & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(vector, scaled).alias("x")
    )


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of smallest sha256 of `salt:vec_id`; ties by components, no id last."""
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(values: np.ndarray):
    rows, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel())
    )


def _round(centroids: np.ndarray, change: np.ndarray | None):
    """Kernel of one assignment; `change` is what was added to the centroids since the last one."""
    k, dims = centroids.shape
    squares = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), dims)
            if change is None:
                dots = x @ centroids.T
            else:
                dots = _matrix(batch.column("dots"), k).copy()
                for j in np.flatnonzero(change.any(axis=1)):
                    moved = np.flatnonzero(change[j])
                    dots[:, j] += x[:, moved] @ change[j, moved]
            part = squares - 2 * dots
            cluster = part.argmin(axis=1)  # the first of equals
            distance = part[np.arange(len(x)), cluster] + (x * x).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("x"), _lists(dots),
                 pa.array(cluster.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "x", "dots", "cluster", "distance"],
            )

    return run


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the means of the clusters; an empty cluster keeps its centroid."""
    dims = centroids.shape[1]
    sums = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(dims)]
    )
    means = centroids.copy()
    for r in sums.collect():  # at most one row a centroid
        means[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    return means


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2", dims: int = 64, scale: int = 256,
            vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Starts from `first_centroids`; each round assigns every vector to its nearest
    centroid (ties: the smaller number) and moves the centroids to their means;
    the vectors are assigned once more in the end.  Vectors of another length,
    NULL vectors and those with a NULL or non-finite component are left out; a
    NULL vec_id is one like any other, but taken last as a first centroid;
    repeated rows count and come out as often as they went in; fewer than k
    vectors give as many centroids, an empty table no rows.  Other columns are
    ignored.  There are no texts; rows are as long as `dims`.
    """
    spark = rows.sparkSession
    vectors = integer_vectors(rows, dims, scale, vector, vec_id)
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    state = vectors.mapInArrow(_round(centroids, None), _STATE)
    for _ in range(rounds):
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        moved = _means(state, centroids)
        change, centroids = moved - centroids, moved
        previous, state = state, state.mapInArrow(_round(centroids, change), _STATE)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
        previous.unpersist()
    final = materialize(state.select("vec_id", "cluster", "distance"))
    state.unpersist()
    names = spark.createDataFrame(
        [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())],
        "cluster int, centroid_sha256 string",
    )
    inertia = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = final.agg(F.sum("distance").alias("inertia"))
    # one row a centroid, and one row
    about = inertia.join(names, "cluster").join(F.broadcast(total))
    return final.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
