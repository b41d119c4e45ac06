"""Ranks, first-of-group and top-n without single-task or hot-group windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import as_col
from ..session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row in its lower 33 bits


def with_global_row_number(df: DataFrame, order: list, name: str = "rn") -> DataFrame:
    """Consecutive 1..n over a total order, computed in every partition at once.

    Rows are range partitioned and sorted, written once to the shared
    folder so the layout cannot change, then each partition adds the number of
    rows in the partitions before it.  Only the per-partition counts (as many
    rows as partitions) meet in one place.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    placed = materialize(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    part = F.shiftright("_mid", _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition: bounded
        .withColumn(name, F.col("_before") + local + 1)
        .drop("_part", "_before", "_mid")
    )


def surrogate_id(
    df: DataFrame, order: list, name: str = "person_id", pattern: str = "MP-%04d"
) -> DataFrame:
    numbered = with_global_row_number(df, order, "_rn")
    return numbered.withColumn(name, F.format_string(pattern, F.col("_rn"))).drop("_rn")


def dedup_first(
    df: DataFrame, keys: list[str] | None, row_id: str, null_key: str = "equal"
) -> DataFrame:
    """First row (in row order) of every key; NULL keys are one key by default.

    A minimum over (row id, rest) combines on the map side, so a key that holds
    a large share of the rows still reaches its reducer as a few rows.
    """
    if null_key not in ("equal", "distinct"):
        raise ValueError(f"unknown null_key: {null_key}")
    keys = keys or [c for c in df.columns if c != row_id]
    rest = [c for c in df.columns if c != row_id]
    group = [F.col(k) for k in keys]
    if null_key == "distinct":
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        group.append(F.when(any_null, F.col(row_id)).alias("_null_row"))
    first = df.groupBy(*[g.alias(f"_k{i}") for i, g in enumerate(group)]).agg(
        F.min(F.struct(row_id, *rest)).alias("_first")
    )
    return first.select("_first.*").select(*df.columns)


def latest_per_group(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Row with the greatest order value of each group."""
    rest = [c for c in df.columns if c not in keys and c != order]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(order, *rest)).alias("_last"))
        .select(*keys, "_last.*")
        .select(*df.columns)
    )


def value_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    if not keep_null:
        df = df.filter(F.col(col).isNotNull())
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col))


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """n most frequent values; ties by value."""
    return value_counts(df, col).limit(n)


def top_values_with_rest(df: DataFrame, col: str, n: int) -> DataFrame:
    """n most frequent values plus how many further values there are."""
    counts = value_counts(df, col)
    total = counts.agg(F.count(F.lit(1))).scalar()
    return counts.limit(n).withColumn("remaining", F.greatest(total - n, F.lit(0)))


def top_n_per_group(df: DataFrame, group: str, col: str, n: int) -> DataFrame:
    """n most frequent values of each group with their rank.

    The rank runs over the counts, not the rows; the rank limit is applied
    before the shuffle, so a group with very many values sends n rows a task.
    """
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(group, col).agg(F.count(F.lit(1)).alias("n"))
    )
    w = W.partitionBy(group).orderBy(F.desc("n"), F.asc(col))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def mode_per_group(df: DataFrame, group: str, col: str) -> DataFrame:
    """Most frequent value of each group (smallest value on a tie) and its count."""
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(group, col).agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("m"), col)).alias("b"))
    return best.select(group, F.col(f"b.{col}").alias("value"), (-F.col("b.m")).alias("n"))


def top_n(df: DataFrame, by: str | Column, n: int, tie: str) -> DataFrame:
    """n rows with the greatest value; ties by the smallest tie key."""
    return df.orderBy(as_col(by).desc_nulls_last(), F.asc(tie)).limit(n)


def topk_semi(df: DataFrame, col: str, k: int) -> DataFrame:
    """Rows whose value is one of the k most frequent."""
    return df.join(top_values(df, col, k).select(col), col, "left_semi")


def label_codes(df: DataFrame, cols: list[str], unknown: str = "Unknown") -> DataFrame:
    """(field, label, code): codes 0.. in sorted label order for each column.

    NULL counts as Unknown.  All columns are read in one pass.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("field"),
                F.coalesce(F.col(c).cast("string"), F.lit(unknown)).alias("label"),
            )
            for c in cols
        ]
    )
    distinct = df.select(F.inline(pairs)).distinct()
    numbered = with_global_row_number(distinct, ["field", "label"], "_rn")
    first = numbered.groupBy("field").agg(F.min("_rn").alias("_first"))  # a row per column
    return numbered.join(first, "field").select(
        "field", "label", (F.col("_rn") - F.col("_first")).cast("int").alias("code")
    )


def label_encode(df: DataFrame, cols: list[str], suffix: str = "_code") -> DataFrame:
    """Fill NULL with Unknown and add the integer code of each label."""
    codes = label_codes(df, cols)
    out = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in cols})
    for c in cols:
        own = codes.filter(F.col("field") == c).select(
            F.col("label").alias(c), F.col("code").alias(f"{c}{suffix}")
        )
        out = out.join(own, c, "left")
    return out


def position_code(c, order) -> Column:
    """Place of a label in a fixed order, from 0; others go after it as NULL."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), as_col(c))
    return F.when(place > 0, place - 1)
