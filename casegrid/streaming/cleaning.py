"""Cases that keep arriving as CSV files, cleaned as they come.

The batch cleaning steps that need no other row are reused as they are; the
steps that need the whole table (dedup, median fill, codes) stay batch work on
the written result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.cleaning import stateless_clean
from ..sources import schemas as S
from ..sources.readers import canonical


def read_case_stream(spark: SparkSession, folder: str, schema=S.EXTRACT_CASES) -> DataFrame:
    stream = spark.readStream.schema(schema).option("header", True).csv(folder)
    return canonical(stream)


def write_clean_stream(stream: DataFrame, out: str, checkpoint: str, **trigger):
    """Append cleaned rows, partitioned by year; restartable from its checkpoint."""
    return (
        stateless_clean(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("year")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
