"""All-against-all comparison in bounded blocks.

Some exact results need every row of one frame against every row of another
(mean Euclidean distance to each cluster, best text similarity).  Rows are
hashed into blocks of bounded size; each task gets one left and one right
block as pandas frames and returns only its per-row aggregate, so neither the
pairs nor a whole frame ever sits in one task, in a shuffle or on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_count(rows: int, block_rows: int, tasks: int = 1, least_rows: int = 1) -> int:
    """Blocks of at most block_rows, and about one per task if rows allow it."""
    return max(1, math.ceil(rows / block_rows), min(tasks, rows // least_rows))


def compare_blocks(
    left: DataFrame,
    right: DataFrame,
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    left_blocks: int,
    right_blocks: int,
    left_key: str,
    right_key: str,
) -> DataFrame:
    """Union of kernel(left block, right block) over all block pairs."""

    spark = left.sparkSession
    # a set number of partitions: the work of a pair does not show in its bytes
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    partitions = min(left_blocks * right_blocks, tasks)

    def place(df, key, own, own_blocks, other, other_blocks):
        return df.withColumns(
            {
                own: F.pmod(F.xxhash64(key), F.lit(own_blocks)).cast("int"),
                other: F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))),
            }
        ).repartition(partitions, "_lb", "_rb")

    lhs = place(left, left_key, "_lb", left_blocks, "_rb", right_blocks)
    rhs = place(right, right_key, "_rb", right_blocks, "_lb", left_blocks)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame()
        drop = ["_lb", "_rb"]
        return kernel(a.drop(columns=drop), b.drop(columns=drop))

    return (
        lhs.groupBy("_lb", "_rb").cogroup(rhs.groupBy("_lb", "_rb")).applyInPandas(run, schema)
    )
