"""Reports over cleaned cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.summaries import peak_and_low_month, season_counts, yearly_growth


def trend_report(df: DataFrame, year="year", month="month") -> DataFrame:
    """Yearly growth, peak and lowest month and seasons as (section, item, value)."""
    growth = yearly_growth(df, year)
    peaks = peak_and_low_month(df, month)
    seasons = season_counts(df, month)

    def part(frame, section, item, value):
        return frame.select(
            F.lit(section).alias("section"), F.col(item).cast("string").alias("item"),
            F.col(value).cast("double").alias("value"),
        )

    peak_rows = peaks.unpivot([], ["peak_month", "lowest_month"], "item", "value")
    return (
        part(growth, "cases", year, "cases")
        .unionByName(part(growth, "growth_pct", year, "growth_pct"))
        .unionByName(part(peak_rows, "season_peak", "item", "value"))
        .unionByName(part(seasons, "season", "season", "n"))
    )
