"""Sinks.  Each writes a directory of part files from all tasks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode="overwrite"):
    out = df.select(*columns) if columns else df
    (
        out.write.mode(mode).option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode="overwrite"):
    """Cleaned cases are usually partitioned by year for later year filters.

    Rows are rebalanced by the partition columns first, so a year is written by
    as many tasks as its size asks for instead of by every task.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode="overwrite"):
    df.write.mode(mode).json(path)


def metric_document(df: DataFrame, **sections: list[str]) -> DataFrame:
    """One JSON text per row, columns grouped into named objects."""
    nested = F.struct(*[F.struct(*cols).alias(name) for name, cols in sections.items()])
    return df.select(F.to_json(nested).alias("document"))


def complete_coordinates(df: DataFrame, lat="latitude", lon="longitude") -> DataFrame:
    """Rows an export of located cases keeps."""
    return df.na.drop("any", subset=[lat, lon])
