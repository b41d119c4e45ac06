"""Joins with a table of distinct keys that stay balanced when some keys hold many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot above this share of all rows; there are at most 1 / share such keys.
HOT_SHARE = 1e-4
#: Below this many rows no key is hot.
HOT_ROWS = 1000


def lookup(
    rows: DataFrame, named: DataFrame, keys: list[str], count: str, total: int, how: str = "inner"
) -> DataFrame:
    """Join rows with `named`, which has distinct, non-null keys; `how` is inner or left.

    `count` is a column of `named`: how many of the `total` rows have that key, at
    least roughly.  Keys with more than a ten-thousandth of the rows number at
    most ten thousand and are broadcast, so their rows stay where they are; the
    other rows are shuffled, and none of their keys can make a task large.  Rows
    with a NULL key meet nothing and are not shuffled either.  The result has no
    column `count`.
    """
    limit = max(HOT_ROWS, int(total * HOT_SHARE))
    flag = "_hot"
    while flag in rows.columns or flag in named.columns:
        flag += "_"
    values = [c for c in named.columns if c not in keys and c != count]
    hot = named.filter(F.col(count) > limit).drop(count).withColumn(flag, F.lit(True))
    rest = named.filter(F.col(count) <= limit).drop(count)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    marked = rows.join(F.broadcast(hot), keys, "left")
    found = marked.filter(F.col(flag)).drop(flag)
    other = marked.filter(F.col(flag).isNull())
    met = other.filter(known).drop(flag, *values).join(rest, keys, how)
    out = found.unionByName(met)
    return out if how == "inner" else out.unionByName(other.filter(~known).drop(flag))
