"""Schemas of the case tables and of the nested place reference."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: columns of the raw case file, in file order ------------------
RAW_CASE_COLUMNS = (
    "Person ID", "Gender", "Age", "Date Reported Missing", "Time Reported Missing",
    "Location last seen", "Latitude", "Longitude", "Barangay District", "Post URL",
)
# --- fixed values: columns of the city extract, in file order -------------------
EXTRACT_COLUMNS = (
    "Person ID", "AGE", "GENDER", "Date Reported Missing", "Time Reported Missing",
    "Date Last Seen", "Location Last Seen", "Longtitude", "Latitude", "Post URL",
)
# --- fixed values: file column -> column name used by the operators -------------
CANONICAL_NAMES = {
    "Person ID": "case_id",
    "Gender": "gender",
    "GENDER": "gender",
    "Age": "age",
    "AGE": "age",
    "Date Reported Missing": "reported_date",
    "Time Reported Missing": "reported_time",
    "Date Last Seen": "last_seen_date",
    "Location last seen": "location_text",
    "Location Last Seen": "location_text",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Longtitude": "longitude",
    "Barangay District": "district",
    "Post URL": "post_url",
}
CANONICAL_REQUIRED = (
    "case_id", "gender", "age", "reported_date", "reported_time", "location_text",
    "latitude", "longitude", "district", "post_url",
)


def all_text(columns) -> T.StructType:
    """Raw files are read as text; typing is a cleaning step that cannot fail."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RAW_CASES = all_text(RAW_CASE_COLUMNS)
EXTRACT_CASES = all_text(EXTRACT_COLUMNS)

PREDICTIONS = T.StructType(
    [
        T.StructField("Barangay District", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("Predicted_Cases", T.DoubleType()),
        T.StructField("Prev_Year_Count", T.DoubleType()),
    ]
)

_POINT = "struct<latitude:double,longitude:double>"
GAZETTEER = (
    "array<struct<city:string,type:string,note:string,total_barangays:bigint,"
    f"coordinates:{_POINT},districts:array<struct<name:string,description:string,"
    f"barangay_range:string,coordinates:{_POINT},barangays:array<string>,"
    f"barangay_list:array<struct<name:string,coordinates:{_POINT}>>>>>>"
)
