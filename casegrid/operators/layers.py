"""Tables behind maps and charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import age_cut, change_color, error_color, round_even
from .ordering import top_n, top_values
from .summaries import actual_year_counts, monthly_counts, ordered_counts, yearly_counts

MIN_WEIGHT = 0.1


def heat_points(df: DataFrame, lat="latitude", lon="longitude") -> DataFrame:
    """Points with a full position; equal points become one with a weight."""
    known = df.na.drop("any", subset=[lat, lon])
    return known.groupBy(F.col(lat).alias("latitude"), F.col(lon).alias("longitude")).agg(
        F.count(F.lit(1)).alias("weight")
    )


def require_rows(df: DataFrame, message="the table is empty") -> DataFrame:
    """Raise if there is nothing to draw."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def weighted_points(df: DataFrame, value: str, location="district") -> DataFrame:
    return df.select(
        location, "latitude", "longitude",
        F.greatest(F.col(value).cast("double"), F.lit(MIN_WEIGHT)).alias("weight"),
    )


def map_layer(df: DataFrame, value: str, location="district", n: int = 10) -> DataFrame:
    """Weighted points, the map centre and the n markers in one long table.

    Raises ValueError for an empty table, as there is nothing to draw.
    """
    require_rows(df)
    points = weighted_points(df, value, location).select(
        F.lit("point").alias("kind"), F.col(location).alias("name"), "latitude", "longitude",
        "weight",
    )
    center = df.agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    ).select(
        F.lit("center").alias("kind"), F.lit(None).cast("string").alias("name"),
        "latitude", "longitude", F.lit(None).cast("double").alias("weight"),
    )
    markers = top_n(df, value, n, location).select(
        F.lit("marker").alias("kind"), F.col(location).alias("name"), "latitude", "longitude",
        F.col(value).cast("double").alias("weight"),
    )
    return points.unionByName(center).unionByName(markers)


def actual_layer(df: DataFrame, year_value: int, location="district", n: int = 10):
    return map_layer(actual_year_counts(df, year_value, location), "actual_cases", location, n)


def district_labels(df: DataFrame, location="district", case_id="case_id"):
    known = df.na.drop("any", subset=[location, "latitude", "longitude"])
    return known.groupBy(location).agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"),
        F.count(case_id).alias("case_count"),
    ).withColumn(
        "label",
        F.format_string("%s<br>(%d cases)", F.col(location), F.col("case_count")),
    )


def prediction_change(df: DataFrame, predicted="predicted_cases", previous="prev_count"):
    """Change on the year before; percent is NULL where that year had none."""
    rounded = round_even(F.col(predicted).cast("double"), 2)
    change = rounded - F.col(previous)
    return df.withColumns(
        {
            "change_cases": change,
            "change_pct": round_even(F.try_divide(change * 100.0, F.col(previous)), 1),
            "color": change_color(predicted, previous),
        }
    )


def predicted_vs_actual(df: DataFrame, predicted="predicted_cases", actual="actual_cases"):
    rounded = round_even(F.col(predicted).cast("double"), 2)
    error = round_even(rounded - F.col(actual), 2)
    return df.withColumns(
        {"error": error, "abs_error": F.abs(error), "color": error_color(predicted, actual)}
    )


def chart_bundle(
    df: DataFrame, gender="gender", age="age", year="year", month="month",
    location="district", label: str | None = None, top: int = 15,
) -> DataFrame:
    """Every standard chart as rows of (chart, item, n)."""
    def rows(frame: DataFrame, chart: str, item: str):
        return frame.select(
            F.lit(chart).alias("chart"), F.col(item).cast("string").alias("item"), "n"
        )

    genders = df.filter(F.col(gender).isNotNull()).groupBy(gender).agg(
        F.count(F.lit(1)).alias("n")
    )
    parts = [
        rows(genders, "gender", gender),
        rows(ordered_counts(df, age_cut(age), K.AGE_CUT_LABELS), "age", "category"),
        rows(yearly_counts(df, year), "year", year),
        rows(monthly_counts(df, month), "month", "month_name"),
        rows(top_values(df, location, top), "location", location),
    ]
    if label:
        sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        parts.append(rows(sizes, "cluster", label))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
