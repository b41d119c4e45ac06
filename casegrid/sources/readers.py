"""File scans."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..operators.quality import coordinate_check, missing_columns, schema_check
from . import schemas as S

_FILE, _BLOCK = "_file", "_block"
#: Rows of one task; the number that Spark's increasing ids leave room for.
_LINES = 2**33
#: Bits of a row id for the place in a file (of up to 1 TB).
_FILE_BITS = 40


class MissingInput(FileNotFoundError):
    """The path given for a scan does not exist."""


def canonical(df: DataFrame, required=()) -> DataFrame:
    """Rename file columns to the operators' names and add absent ones as NULL."""
    names = {c: S.CANONICAL_NAMES[c] for c in df.columns if c in S.CANONICAL_NAMES}
    out = df.withColumnsRenamed(names)
    gaps = {c: F.lit(None).cast("string") for c in required if c not in out.columns}
    return out.withColumns(gaps) if gaps else out


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False,
    placed: bool = False,
) -> DataFrame:
    """CSV with a header and quoted fields; usual missing tokens become NULL.

    A column of another type than text that does not parse becomes NULL.  Fields
    with line breaks need ``multi_line``, which reads each file in one piece.
    ``placed`` adds the file and the start of the block that a row was read from.
    """
    try:
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("multiLine", multi_line)
            .option("escape", '"')
            .csv(path)
        )
        if placed:
            df = df.select(
                "*", F.col("_metadata.file_path").alias(_FILE),
                F.col("_metadata.file_block_start").alias(_BLOCK),
            )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition() or e):
            raise MissingInput(path) from e
        raise
    text = {
        f.name: F.when(~F.col(f"`{f.name}`").isin(*K.CSV_MISSING_TOKENS), F.col(f"`{f.name}`"))
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name != _FILE
    }
    return df.withColumns(text) if text else df


def read_cases(spark: SparkSession, path: str, schema=S.RAW_CASES) -> DataFrame:
    """Case file under canonical names.

    ``row_id`` is unique and grows with the path of the file, and in a file with
    the line; it carries the row order that first-row rules need.  It is the place
    of the file in the sorted list, then the start of the block a row was read
    from plus the number of the row in its task: a line has at least one byte, and
    only the last block of a file shares a task with blocks of other files, so no
    two rows of a file meet.  Files are read once, and no row is shuffled for it.
    """
    df = canonical(read_csv(spark, path, schema, placed=True))
    files = sorted(df.inputFiles())
    if len(files) >= 1 << (63 - _FILE_BITS):
        raise ValueError("too many files for row ids of 63 bits")
    # the sorted list of files, local ones in both spellings of their address; broadcast
    # by its size, so the scan keeps its partitions
    order = spark.createDataFrame(
        [
            (name, i << _FILE_BITS)
            for i, f in enumerate(files) for name in {f, re.sub(r"^(\w+):///", r"\1:/", f)}
        ],
        f"{_FILE} string, _start long",
    )
    line = F.monotonically_increasing_id().bitwiseAND(_LINES - 1)
    return (
        df.withColumn("_at", F.col(_BLOCK) + line)
        .join(order, _FILE)
        .withColumn("row_id", F.col("_start") + F.col("_at"))
        .drop(_FILE, _BLOCK, "_start", "_at")
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.PREDICTIONS).toDF(
        "district", "latitude", "longitude", "predicted_cases", "prev_count"
    )


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Nested place file (one JSON array): a row per city with its position."""
    whole = spark.read.text(path, wholetext=True)
    cities = whole.select(F.posexplode(F.from_json("value", S.GAZETTEER)).alias("city_pos", "c"))
    return cities.select("city_pos", "c.*")


def load_and_validate(
    spark: SparkSession, path: str, schema=S.RAW_CASES, required=S.CANONICAL_REQUIRED
) -> tuple[DataFrame, DataFrame]:
    """Cases and a report of (check, ok, detail) rows."""
    from ..functions.values import coerce_numeric

    df = read_cases(spark, path, schema)
    gaps = missing_columns(df, required)
    report = spark.createDataFrame(
        [("schema", not gaps, ", ".join(gaps) or None)], "check string, ok boolean, detail string"
    )
    if {"latitude", "longitude"} <= set(df.columns):
        numeric = df.select(
            coerce_numeric("latitude").alias("latitude"),
            coerce_numeric("longitude").alias("longitude"),
        )
        bounds = coordinate_check(numeric).select(
            F.lit("coordinates").alias("check"),
            F.col("valid").alias("ok"),
            F.when(~F.col("valid"), F.format_string("%d outside bounds", "invalid"))
            .alias("detail"),
        )
        report = report.unionByName(bounds)
    return df, report


__all__ = [
    "MissingInput", "canonical", "load_and_validate", "read_cases", "read_csv",
    "read_gazetteer", "read_predictions", "schema_check",
]
