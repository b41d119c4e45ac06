"""Validation, null handling, audits and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import as_col, is_missing, keyword_match
from ..functions.values import coerce_numeric, round_even
from .selection import exact_median


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required columns the frame lacks (metadata only)."""
    return sorted(set(required) - set(df.columns))


def schema_check(df: DataFrame, required) -> DataFrame:
    """One row per required column: is it there, and with which type."""
    types = dict(df.dtypes)
    rows = [(c, c in types, types.get(c)) for c in required]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, present boolean, data_type string"
    )


def out_of_bounds(lat, lon, lat_bounds=K.LAT_BOUNDS, lon_bounds=K.LON_BOUNDS) -> Column:
    """True only for a known coordinate outside its bounds."""
    lat, lon = as_col(lat), as_col(lon)
    outside = (
        (lat < lat_bounds[0]) | (lat > lat_bounds[1])
        | (lon < lon_bounds[0]) | (lon > lon_bounds[1])
    )
    return F.coalesce(outside, F.lit(False))


def coordinate_check(df: DataFrame, lat="latitude", lon="longitude", **bounds) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(out_of_bounds(lat, lon, **bounds)).alias("invalid"),
    ).withColumn("valid", F.col("invalid") == 0)


def missing_coordinate_counts(df: DataFrame, lat="latitude", lon="longitude") -> DataFrame:
    no_lat, no_lon = F.col(lat).isNull(), F.col(lon).isNull()
    return df.agg(
        F.count_if(no_lat).alias("missing_lat"),
        F.count_if(no_lon).alias("missing_lon"),
        F.count_if(no_lat | no_lon).alias("missing_either"),
        F.count_if(~(no_lat | no_lon)).alias("complete"),
    )


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def median_of(df: DataFrame, col: str) -> Column:
    """Exact interpolated median as a literal; its state is bounded for any column."""
    return F.lit(exact_median(df, col)).cast("double")


def smart_fill(
    df: DataFrame,
    critical=("latitude", "longitude", "reported_date"),
    median_cols=("age",),
    constants=None,
) -> DataFrame:
    """Drop rows without critical values, then fill the rest.

    The median is taken over the rows that are left after the drop.
    """
    constants = constants or {
        "gender": "Unknown", "district": "Unknown", "reported_time": "00:00",
    }
    kept = df.na.drop("any", subset=[c for c in critical if c in df.columns])
    fills = {
        c: F.coalesce(F.col(c), median_of(kept, c)) for c in median_cols if c in df.columns
    }
    fills.update(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in constants.items() if c in df.columns}
    )
    return kept.withColumns(fills)


def handle_missing(df: DataFrame, strategy: str = "smart", **kw) -> DataFrame:
    if strategy == "drop":
        return drop_missing(df)
    if strategy == "smart":
        return smart_fill(df, **kw)
    if strategy == "fill":  # accepted, and does nothing
        return df
    raise ValueError(f"unknown strategy: {strategy}")


def standardize_coordinates(df: DataFrame, lat="latitude", lon="longitude") -> DataFrame:
    """Coordinates to numbers; rows where either is not a number go."""
    numeric = df.withColumns({lat: coerce_numeric(lat), lon: coerce_numeric(lon)})
    return numeric.na.drop("any", subset=[lat, lon])


def keyword_filter_report(df: DataFrame, text: str, **lists) -> DataFrame:
    keep = keyword_match(text, **lists)
    return df.agg(
        F.count(F.lit(1)).alias("original"),
        F.count_if(~keep).alias("removed"),
        F.count_if(keep).alias("remaining"),
    )


def _long(counts: DataFrame, cols: list[str], value: str) -> DataFrame:
    """One wide row of per-column numbers -> one row per column."""
    return counts.unpivot([], cols, "column_name", value)


def null_counts(df: DataFrame) -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(wide, df.columns, "missing")


def missing_audit(df: DataFrame) -> DataFrame:
    """Missing per column: NULL anywhere, and the text marker in text columns."""
    text_cols = {c for c, t in df.dtypes if t == "string"}
    wide = df.agg(
        *[
            F.count_if(is_missing(c) if c in text_cols else F.col(c).isNull()).alias(c)
            for c in df.columns
        ]
    )
    return _long(wide, df.columns, "missing").orderBy(F.desc("missing"), "column_name")


def percent_empty(df: DataFrame) -> DataFrame:
    """Share of empty cells over rows x columns, in percent."""
    text_cols = {c for c, t in df.dtypes if t == "string"}
    missing = F.lit(0).cast("bigint")
    for c in df.columns:
        gap = is_missing(c) if c in text_cols else F.col(c).isNull()
        missing = missing + F.when(gap, 1).otherwise(0)
    totals = df.agg(
        F.sum(missing).alias("missing_cells"),
        (F.count(F.lit(1)) * len(df.columns)).alias("total_cells"),
    )
    return totals.withColumn(
        "pct_empty", F.try_divide(F.col("missing_cells") * 100.0, "total_cells")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, missing and missing % of each column, from one scan."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    return (
        wide.unpivot(["_rows"], df.columns, "column_name", "missing")
        .withColumn("data_type", types[F.col("column_name")])
        .withColumn(
            "missing_pct",
            round_even(F.try_divide(F.col("missing") * 100.0, "_rows"), 2),
        )
        .drop("_rows")
    )


def category_map(df: DataFrame, col: str, n: int = K.MAP_CATEGORIES) -> Column:
    """value -> count map of the n most frequent values of a column, as a scalar subquery.

    `summaries.category_counts` gives all values of a column with more of them.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.desc("n"), col).limit(n)
    return counts.agg(F.map_from_entries(F.collect_list(F.struct(col, "n")))).scalar()


def data_summary(
    df: DataFrame, date="reported_date", location="district", gender="gender", age="age",
    top: int = 10,
) -> DataFrame:
    """One row: size, columns, gaps, date range, places, genders, age statistics."""
    flat = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        F.create_map(
            *[x for c in df.columns for x in (F.lit(c), F.count_if(F.col(c).isNull()))]
        ).alias("missing_values"),
        F.min(date).alias("earliest"),
        F.max(date).alias("latest"),
        F.count_distinct(location).alias("unique_locations"),
        F.avg(age).alias("age_mean"),
        median_of(df, age).alias("age_median"),
        F.min(age).alias("age_min"),
        F.max(age).alias("age_max"),
    )
    return flat.withColumns(
        {
            "gender_distribution": category_map(df, gender),
            "top_locations": category_map(df, location, top),
        }
    )


def stage_counts(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Row counts before and after cleaning with stage flags."""
    def counted(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")

    return counted(raw, "raw").union(counted(cleaned, "clean")).withColumn(
        "ready", F.col("n") > 0
    )
