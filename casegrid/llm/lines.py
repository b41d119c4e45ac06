"""Line dedup: corpus-wide repeats of a line, decided on hashes, returned as bitmaps.

Only hashes, document ids and positions are shuffled.  They are range
partitioned by (hash, document) and sorted by document and position inside a
task, where one pass streams the first occurrence of a line in each document.
A line that a third of all documents hold is so spread over many tasks; what the
tasks that share it must agree on (how many documents, which is the last) is one
pre-aggregated row per task.  The decisions go back to the lines in two ways:
lines with more than a ten-thousandth of all rows are at most ten thousand, and
broadcast; no other line can make a partition large, and these are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from casegrid.session import materialize

from .common import lookup, lower_ascii, partitions, whole

MIN_CHARS = 20
MIN_DOCS = 3

_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without outer white space, A-Z in lower case."""
    return lower_ascii(F.regexp_replace(line, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", ""))


def _line_hashes(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    keyed = F.filter(
        F.transform(
            F.split(whole(text), "\n"),
            lambda line, i: F.struct(i.alias("pos"), line_key(line).alias("key")),
        ),
        lambda e: F.char_length(e["key"]) >= min_chars,
    )
    return (
        docs.select(
            F.col(doc_id).alias("doc"), F.xxhash64(text).alias("row"), F.explode(keyed).alias("e")
        )
        .select(
            "doc", "row", F.col("e.pos").alias("pos"),
            F.xxhash64("e.key").alias("h1"), F.xxhash64(F.lit(1), "e.key").alias("h2"),
        )
    )


def dropped_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """(doc, row, pos) of every line that goes: held by `min_docs` documents or
    more, and not in the largest document id among them.

    `row` is a hash of the text; rows with one id and one text are one document
    and get the same decisions.  NULL ids are one document, below all others.
    """
    spark = docs.sparkSession
    lines = materialize(_line_hashes(docs, text, doc_id, min_chars))
    total = lines.count()
    firsts = (
        lines.repartitionByRange(partitions(spark), *_HASH, "doc")
        .sortWithinPartitions(*_HASH, "doc", "pos")
        .withColumn("n", F.row_number().over(W.partitionBy(*_HASH, "doc").orderBy("pos")))
        .filter("n = 1")
    )
    repeats = materialize(
        firsts.groupBy(*_HASH)
        .agg(F.count("*").alias("docs"), F.max("doc").alias("last"))
        .filter(F.col("docs") >= min_docs)
    )
    marked = lookup(lines, repeats, _HASH, "docs", total)
    return marked.filter(
        F.col("last").isNotNull() & ~F.col("doc").eqNullSafe(F.col("last"))
    ).select("doc", "row", "pos")


def _shifted(values: Column, first: Column) -> Column:
    """The values one place on, `first` before them."""
    return F.concat(F.array(first), F.slice(values, 1, F.size(values) - 1))


def runs_of(positions: Column) -> Column:
    """Run lengths kept, dropped, kept, ... up to the last dropped position.

    `positions` are the dropped ones, sorted and not empty.  Every step is one
    pass over an array, none looks into another one or grows one.
    """
    def pair(a, b):
        return F.struct(a.alias("p"), b.alias("q"))

    after = F.concat(F.slice(positions, 2, F.size(positions)), F.array(F.lit(-2)))
    starts = F.transform(
        F.filter(F.zip_with(positions, _shifted(positions, F.lit(-2)), pair), lambda e: e["p"] != e["q"] + 1),
        lambda e: e["p"],
    )
    ends = F.transform(
        F.filter(F.zip_with(positions, after, pair), lambda e: e["p"] + 1 != e["q"]), lambda e: e["p"] + 1
    )
    kept = F.zip_with(starts, _shifted(ends, F.lit(0)), lambda s, e: s - e)
    dropped = F.zip_with(starts, ends, lambda s, e: e - s)
    return F.flatten(F.zip_with(kept, dropped, lambda k, d: F.array(k, d)))


def keep_bitmaps(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per document that loses a line: doc, row, runs.

    The bitmap counts kept and dropped lines in turn, up to the last dropped one.
    """
    return (
        dropped_lines(docs, text, doc_id, min_chars, min_docs)
        .groupBy("doc", "row")
        .agg(runs_of(F.sort_array(F.collect_set("pos"))).alias("runs"))
    )


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Add n_lines, n_dropped, keep_runs (the bitmap) and kept_text to every row.

    keep_runs counts kept and dropped lines in turn and adds up to n_lines.  A
    NULL or empty text is one empty line, which stays.  Texts of any length and
    number of lines are handled whole; of repeated lines in one document all stay
    or all go; repeated rows get the same decisions.  An empty table gives an
    empty table.  Columns of the input named like an added one are replaced, all
    others keep their values, whatever their names.
    """
    made = ["n_lines", "n_dropped", "keep_runs", "kept_text"]
    bitmaps = keep_bitmaps(docs, text, doc_id, min_chars, min_docs)
    kept_columns = [c for c in docs.columns if c not in made]
    # the input goes along as one column, so that no name of it can meet one made here
    carried = kept_columns if text in kept_columns else [*kept_columns, text]
    left = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("in"), F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("hash"),
    )
    joined = left.join(bitmaps, left["id"].eqNullSafe(bitmaps["doc"]) & (left["hash"] == bitmaps["row"]), "left")
    joined = joined.withColumn("split", F.split(whole(F.col("in")[text]), "\n"))
    n = F.size("split")
    none = F.array().cast("array<int>")
    total = F.aggregate(F.coalesce("runs", none), F.lit(0), lambda a, r: a + r)
    runs = F.concat(F.coalesce("runs", none), F.array(n - total))
    flags = F.flatten(F.transform(runs, lambda r, k: F.array_repeat(k % 2 == 0, r)))
    marked = F.zip_with("split", flags, lambda line, keep: F.struct(line.alias("line"), keep.alias("keep")))
    kept = F.transform(F.filter(marked, lambda e: e["keep"]), lambda e: e["line"])
    dropped = F.aggregate(
        F.transform(F.coalesce("runs", none), lambda r, k: F.when(k % 2 == 1, r).otherwise(0)),
        F.lit(0), lambda a, r: a + r,
    )
    unchanged = whole(F.col("in")[text])
    return joined.select(
        *[F.col("in")[c].alias(c) for c in kept_columns],
        n.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"),
        runs.alias("keep_runs"),
        F.when(F.col("runs").isNull(), unchanged).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
