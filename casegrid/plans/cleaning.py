"""Cleaning plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import capitalize_first, na_to_null
from ..functions.values import age_cut, coerce_numeric, parse_date, parse_hour, smart_age_group
from ..operators.ordering import dedup_first, label_encode, surrogate_id
from ..operators.places import match_places
from ..operators.quality import smart_fill, standardize_coordinates
from ..session import materialize


def with_date_parts(df: DataFrame, date="reported_date") -> DataFrame:
    parsed = df if dict(df.dtypes)[date] in ("date", "timestamp", "timestamp_ntz") else (
        df.withColumn(date, parse_date(date))
    )
    return parsed.withColumns(
        {
            "year": F.year(date), "month": F.month(date),
            "day_of_week": F.weekday(date), "quarter": F.quarter(date),
        }
    )


def clean_cases(
    df: DataFrame, key="case_id", row_id="row_id", encode=("gender", "district")
) -> DataFrame:
    """Dedup, fill, coordinates, dates, ages, codes: always in this order.

    The unique rows are written once: the median and the label sets are read
    from two columns of them instead of repeating the shuffle of all rows.  The
    age is made a number before its median is taken, as text has none.
    """
    out = dedup_first(df, [key], row_id)
    if dict(out.dtypes).get("age") == "string":
        out = out.withColumn("age", coerce_numeric("age"))
    out = smart_fill(materialize(out))
    out = standardize_coordinates(out)
    out = with_date_parts(out)
    out = out.withColumns(
        {"age": coerce_numeric("age"), "age_group": age_cut(coerce_numeric("age"))}
    )
    return label_encode(out, list(encode))


def cleaning_report(
    df: DataFrame, key="case_id", row_id="row_id",
    critical=("latitude", "longitude", "reported_date"),
    filled=("age", "gender", "district", "reported_time"),
) -> DataFrame:
    """Row counts and fills of the cleaning plan, from one aggregate."""
    unique = dedup_first(df, [key], row_id)
    critical = [c for c in critical if c in df.columns]
    filled = [c for c in filled if c in df.columns]
    kept = F.lit(True)
    for c in critical:
        kept = kept & F.col(c).isNotNull()
    initial = df.agg(F.count(F.lit(1))).scalar()
    counts = unique.agg(
        F.count(F.lit(1)).alias("unique_rows"),
        F.count_if(kept).alias("final_rows"),
        *[F.count_if(kept & F.col(c).isNull()).alias(f"filled_{c}") for c in filled],
    )
    return counts.select(
        initial.alias("initial_rows"),
        (initial - F.col("unique_rows")).alias("duplicates_removed"),
        (F.col("unique_rows") - F.col("final_rows")).alias("missing_dropped"),
        *[f"filled_{c}" for c in filled],
        "final_rows",
    )


def stateless_clean(df: DataFrame) -> DataFrame:
    """Row-by-row part of the extract cleaning; also runs on a stream."""
    out = df.withColumns(
        {
            "gender": capitalize_first("gender"),
            "reported_date": parse_date("reported_date"),
            "reported_time": na_to_null("reported_time"),
            "age_group": smart_age_group("age"),
        }
    )
    if "last_seen_date" in df.columns:
        out = out.withColumn("last_seen_date", parse_date(na_to_null("last_seen_date")))
    return out.withColumns(
        {"year": F.year("reported_date"), "hour": parse_hour("reported_time")}
    )


def clean_extract(
    df: DataFrame, aliases: DataFrame, row_id="row_id", text="location_text", **match_args
) -> DataFrame:
    """City extract -> cleaned cases with matched places and new ids.

    Rows without a report date go after the matching; ids follow row order.
    """
    out = stateless_clean(df.drop("latitude", "longitude"))
    out = out.filter(F.col("reported_date").isNotNull())
    out = match_places(out, text, aliases, **match_args)
    return surrogate_id(out, [row_id])
