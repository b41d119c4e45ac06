"""Exact medians and quantiles without one reducer that holds all values.

A column with few different values gives its counts to the driver.  Any other is
narrowed: approximate quantiles cut the present range into parts, one grouped
count says how many values each part holds, and only the part with the wanted
rank goes on.  Every pass keeps a bounded state in each task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Different values that the driver takes, by estimate; it takes twice as many at most.
VALUES = 20_000
#: Parts of a range.
PARTS = 200


def _order(v) -> tuple:
    return (v != v, v)  # NaN is the greatest value, as in Spark


def _ranked(counts: list, wanted: list[int], before: int) -> dict[int, float]:
    """rank -> value from all (value, n) of a range whose first rank is `before`."""
    out, at = {}, before
    for value, n in sorted(counts, key=lambda r: _order(r[0])):
        out.update({k: value for k in wanted if at <= k < at + n})
        at += n
    return out


def values_at(df: DataFrame, column: str, ranks: list[int]) -> dict[int, float]:
    """rank (from 0, in ascending order) -> value of a numeric column, NULLs left out."""
    v = F.col(column)
    todo = [(df.filter(v.isNotNull()).select(v.cast("double").alias("v")), sorted(set(ranks)), 0)]
    out: dict[int, float] = {}
    v = F.col("v")
    while todo:
        rows, wanted, before = todo.pop()
        if rows.agg(F.approx_count_distinct("v")).first()[0] <= VALUES:
            few = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).limit(2 * VALUES + 1).collect()
            if len(few) <= 2 * VALUES:
                out.update(_ranked([tuple(r) for r in few], wanted, before))
                continue
        shares = [i / PARTS for i in range(1, PARTS)]
        cuts = rows.agg(F.percentile_approx("v", shares, 10 * PARTS)).first()[0]
        cuts = sorted({float(c) for c in cuts}, key=_order)
        # part 2i: below cut i; part 2i + 1: equal to cut i
        array = F.array(*[F.lit(c) for c in cuts])
        below = F.size(F.filter(array, lambda c: c < v))
        equal = F.when(F.exists(array, lambda c: c == v), 1).otherwise(0)
        part = (below * 2 + equal).alias("part")
        sizes = dict(map(tuple, rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()))
        for p in sorted(sizes):
            mine = [k for k in wanted if before <= k < before + sizes[p]]
            if mine and p % 2:
                out.update(dict.fromkeys(mine, cuts[p // 2]))
            elif mine:
                inside = rows
                if p // 2 > 0:
                    inside = inside.filter(v > F.lit(cuts[p // 2 - 1]))
                if p // 2 < len(cuts):
                    inside = inside.filter(v < F.lit(cuts[p // 2]))
                todo.append((inside, mine, before))
            before += sizes[p]
    return out


def exact_quantiles(df: DataFrame, column: str, shares=(0.5,)) -> list[float | None]:
    """Interpolated quantiles of a numeric column; None where it has no value.

    Values count as doubles.  The table is read once, or a few times where it
    has more than VALUES different values.
    """
    n = df.agg(F.count(column)).first()[0]
    if not n:
        return [None for _ in shares]
    at = [s * (n - 1) for s in shares]
    found = values_at(df, column, [k for x in at for k in (math.floor(x), math.ceil(x))])
    out = []
    for x in at:
        low, high = found[math.floor(x)], found[math.ceil(x)]
        out.append(low if low == high else (math.ceil(x) - x) * low + (x - math.floor(x)) * high)
    return out


def exact_median(df: DataFrame, column: str) -> float | None:
    return exact_quantiles(df, column)[0]
