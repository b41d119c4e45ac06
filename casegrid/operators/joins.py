"""Lookups and joins of panels, forecasts and the gazetteer's districts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def previous_year_join(
    locations: DataFrame, panel_df: DataFrame, target_year: int,
    location="district", period="year", count="case_count",
) -> DataFrame:
    """Add last year's count (0 if none) and the target year to each location."""
    prev = panel_df.filter(F.col(period) == target_year - 1).select(
        location, F.col(count).alias("prev_count")
    )
    return locations.join(prev, location, "left").withColumns(
        {
            "prev_count": F.coalesce("prev_count", F.lit(0)),
            period: F.lit(target_year),
        }
    )


def attach_actuals(
    predictions: DataFrame, cases: DataFrame, location="district", case_id="case_id"
) -> DataFrame:
    """Actual cases per predicted location, 0 where there are none."""
    actual = (
        cases.filter(F.col(location).isNotNull())
        .groupBy(location).agg(F.count(case_id).alias("actual_cases"))
    )
    return predictions.join(actual, location, "left").withColumn(
        "actual_cases", F.coalesce("actual_cases", F.lit(0))
    )


def fill_coordinates(
    df: DataFrame, districts: DataFrame, key="district", lat="latitude", lon="longitude"
) -> DataFrame:
    """Take the district's position where latitude or longitude is missing.

    Both values are replaced together; rows that still lack one are dropped.
    """
    known = districts.select(
        F.col(key), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"),
        F.lit(True).alias("_hit"),
    )
    gap = (F.col(lat).isNull() | F.col(lon).isNull()) & F.col("_hit")
    return (
        df.join(known, key, "left")
        .withColumns(
            {
                lat: F.when(gap, F.col("_lat")).otherwise(F.col(lat)),
                lon: F.when(gap, F.col("_lon")).otherwise(F.col(lon)),
            }
        )
        .drop("_lat", "_lon", "_hit")
        .na.drop("any", subset=[lat, lon])
    )


def forecast_grid(
    history: DataFrame, test: DataFrame, target_year: int, location="district",
    year="year", case_id="case_id", lat="latitude", lon="longitude", age="age",
) -> DataFrame:
    """Feature row for every location seen in the history or the test rows.

    Locations without history take the overall means; a location without
    cases in the year before gets a previous count of 0.  The NULL location,
    if present, is kept as a location of its own.
    """
    keys = history.select(location).union(test.select(location)).distinct()
    known = history.groupBy(location).agg(
        F.avg(lat).alias("latitude"), F.avg(lon).alias("longitude"), F.avg(age).alias("age"),
        F.count_if((F.col(year) == target_year - 1) & F.col(case_id).isNotNull()).alias("_prev"),
        F.lit(True).alias("_seen"),
    )
    overall = history.agg(
        F.struct(
            F.avg(lat).alias("latitude"), F.avg(lon).alias("longitude"), F.avg(age).alias("age")
        )
    ).scalar()
    joined = keys.alias("k").join(
        known.alias("h"), F.col(f"k.{location}").eqNullSafe(F.col(f"h.{location}")), "left"
    )
    unseen = F.col("_seen").isNull() | F.col(f"k.{location}").isNull()
    feature = {
        c: F.when(unseen, overall[c]).otherwise(F.col(f"h.{c}"))
        for c in ("latitude", "longitude", "age")
    }
    return joined.select(
        F.col(f"k.{location}").alias(location),
        feature["latitude"].alias("latitude"),
        feature["longitude"].alias("longitude"),
        F.lit(target_year).alias(year),
        F.when(F.col(f"k.{location}").isNull(), 0)
        .otherwise(F.coalesce("_prev", F.lit(0))).alias("prev_count"),
        feature["age"].alias("age"),
    )
