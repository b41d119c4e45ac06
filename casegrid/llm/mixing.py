"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

The targets come from the table of sources alone.  Documents then take whole
repetitions of their source, and the rest of the target is filled with one more
repetition of documents in seeded hash order.  The running sum over that order
is never taken over a whole source: sums of 4,096 hash ranges per source find
the range in which the target is reached, and only the documents of that range
are ordered.  The gap that the first document too long leaves is closed by the
longest document that still fits, and then by the one that comes nearest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from casegrid.session import materialize

from .common import WORD

MAX_EPOCHS = 3
SEED = 17
#: Hex digits of the hash that name a range: 16 ** 3 ranges per source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(rank: Column) -> Column:
    """1, 2, 3, repeating over sources in code point order, the NULL source last."""
    return ((rank - 1) % 3 + 1).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources: source, source_size, weight.  Adds target (double).

    The total is shared by weight; a source stops at `max_epochs` times its size
    and its excess is shared by weight among the others until none is above.
    With sources in order of capacity per weight the clamped ones come first, and
    the fixed point is the level at the first source that is not full; behind it
    the levels fall again, so it is the largest one.
    """
    cap = F.col("source_size") * max_epochs
    order = W.orderBy((cap / F.col("weight")).asc(), "weight", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(W.partitionBy())
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights = F.sum("weight").over(after)
    level = F.when(cap * weights > F.col("weight") * left, left / weights)
    return (
        sources.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(W.partitionBy()))
        .withColumn(
            "target",
            F.least(cap.cast("double"), F.coalesce(F.col("weight") * F.col("_level"), cap.cast("double"))),
        )
        .drop("_level")
    )


def _per_source(slim: DataFrame, max_epochs: int) -> DataFrame:
    sums = materialize(slim.groupBy("source").agg(F.sum("size").alias("source_size")))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    plan = water_fill(sums.withColumn("weight", cyclic_weights(rank)), max_epochs)
    whole_reps = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    return materialize(
        plan.withColumn("whole", whole_reps.cast("long")).withColumn(
            "rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
        )
    )


def _same(a: DataFrame, b: DataFrame, *names: str):
    on = F.lit(True)
    for name in names:
        on = on & a[name].eqNullSafe(b[name])
    return on


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
    max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, row (hash of the text), copy (number among
    equal rows), size, source_size, target, repeats, taken.

    Weights are 1, 2, 3 over the sources in code point order; the sources share
    the size of the whole table.  A NULL text has size 0, a NULL source is a
    source, NULL ids share a place in the order; an empty table gives no rows.
    Reruns give the same answer; equal rows are told apart by an arbitrary number.
    """
    slim = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("row"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(doc_id).cast("string"))).alias("h"),
        ).withColumn("n", F.monotonically_increasing_id())
    )
    plan = _per_source(slim, max_epochs)
    ranged = slim.withColumn("range", F.substring("h", 1, RANGE_DIGITS))
    by_range = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    through = F.sum("range_size").over(W.partitionBy("source").orderBy("range"))
    by_range = by_range.withColumn("through", through)
    edge = by_range.join(plan, _same(by_range, plan, "source")).filter(
        "through > rest and through - range_size <= rest"
    )
    edge = materialize(
        edge.groupBy(by_range["source"]).agg(
            F.min_by(F.struct("range", (F.col("through") - F.col("range_size")).alias("base")), "range").alias("e")
        ).select("source", F.col("e.range").alias("edge"), F.col("e.base").alias("base"))
    )
    levels = materialize(
        plan.join(edge, _same(plan, edge, "source"), "left").select(
            plan["source"], "source_size", "target", "whole", "rest", "edge", "base"
        )
    )
    rows = ranged.join(levels, _same(ranged, levels, "source")).drop(levels["source"])
    at_edge = rows.filter("range = edge")
    running = F.sum("size").over(
        W.partitionBy("source").orderBy("h", "size", "row", "n").rowsBetween(W.unboundedPreceding, 0)
    )
    at_edge = at_edge.withColumn("extra", (F.col("base") + running <= F.col("rest")).cast("int"))
    others = rows.filter("edge is null or range <> edge").withColumn(
        "extra", (F.col("edge").isNull() | (F.col("range") < F.col("edge"))).cast("int")
    )
    chosen = materialize(at_edge.unionByName(others).drop("range", "edge", "base", "h"))
    chosen = _top_up(_top_up(chosen, over=False), over=True)
    repeats = F.least(F.col("whole") + F.col("extra"), F.lit(max_epochs).cast("long"))
    return chosen.select(
        "doc_id", "row", "source", "size", "source_size", "target", repeats.alias("repeats"),
        (repeats * F.col("size")).alias("taken"), "n",
    )


def _top_up(chosen: DataFrame, over: bool) -> DataFrame:
    """One more repetition of the document, per source, that best closes its gap;
    with `over` also of one that goes over the target by less than the gap."""
    gaps = materialize(
        chosen.groupBy("source").agg(
            (F.max("rest") - F.sum(F.col("size") * F.col("extra"))).alias("gap")
        )
    )
    off = F.abs(F.col("size") - F.col("gap"))
    open_rows = chosen.filter("extra = 0 and size > 0 and whole * source_size < target")
    best = open_rows.join(gaps, _same(open_rows, gaps, "source")).filter(
        off < F.col("gap") if over else F.col("size") <= F.col("gap")
    )
    best = materialize(
        best.groupBy(chosen["source"]).agg(
            F.max(F.struct((-off).alias("off"), "size", "doc_id", "row", "n")).alias("b")
        ).select(F.col("b.n").alias("best_n"))
    )
    out = chosen.join(best, chosen["n"] == best["best_n"], "left")
    return out.withColumn(
        "extra", F.when(F.col("best_n").isNotNull(), 1).otherwise(F.col("extra"))
    ).drop("best_n")


def repeated(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
    max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> DataFrame:
    """The mix itself: every row as often as it is taken, with its own columns.

    Equal rows (id, text and source) share their repetitions out among them.  A
    NULL or empty text has no size and is not taken; an empty table gives no rows.
    All columns keep their values, whatever their names.
    """
    taken = (
        mix(docs, text, source, doc_id, max_epochs, seed)
        .groupBy(F.col("doc_id").alias("id"), "row", F.col("source").alias("of"))
        .agg(F.sum("repeats").alias("repeats"))
        .filter("repeats > 0")
    )
    # the input goes along as one column, so that no name of it can meet one made here
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("in"),
        F.col(doc_id).alias("key_id"), F.xxhash64(text).alias("key_row"), F.col(source).alias("key_of"),
    )
    same = (
        rows["key_id"].eqNullSafe(taken["id"]) & (rows["key_row"] == taken["row"])
        & rows["key_of"].eqNullSafe(taken["of"])
    )
    joined = rows.join(taken, same)
    equal = W.partitionBy("id", "row", "of")
    share = joined.withColumns(
        {"n": F.row_number().over(equal.orderBy("id")), "equals": F.count("*").over(equal)}
    )
    times = F.floor((F.col("repeats") + F.col("equals") - F.col("n")) / F.col("equals")).cast("int")
    copies = share.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times)))
    return copies.select(*[F.col("in")[c].alias(c) for c in docs.columns])
