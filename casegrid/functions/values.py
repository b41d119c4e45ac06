"""Number, age, date and label expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import as_col, strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INFINITE = r"(?i)^[+-]?inf(inity)?$"


def coerce_numeric(c) -> Column:
    """Text to double; whatever is not a number becomes NULL."""
    text = strip(as_col(c).cast("string"))
    return F.when(text.rlike(_NUMBER) | text.rlike(_INFINITE), text.try_cast("double"))


def nan_to_null(c) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


# --- filled columns ------------------------------------------------------------

def fill_missing_id(key, row_id, pattern: str = "UNK-%04d") -> Column:
    """The id, or one made from the number of the row where it has none."""
    return F.coalesce(as_col(key).cast("string"), F.format_string(pattern, as_col(row_id)))


def coalesce_key(*columns, default: str = "Unknown") -> Column:
    """The first known of several columns, trimmed; the default where all are NULL."""
    return F.trim(F.coalesce(*[as_col(c) for c in columns], F.lit(default)))


def fill_year(year, date) -> Column:
    """The year, or that of the date where it is NULL."""
    return F.coalesce(as_col(year), F.year(as_col(date)))


# --- age groups ----------------------------------------------------------------

def age_cut(age, edges=K.AGE_CUT_EDGES, labels=K.AGE_CUT_LABELS) -> Column:
    """Right-closed bins (lo, hi]; values outside every bin are NULL."""
    age = as_col(age)
    out = F
    for lo, hi, label in zip(edges, edges[1:], labels):
        out = out.when((age > lo) & (age <= hi), label)
    return out


def smart_age_group(c) -> Column:
    """Life stage from a word or a number; gaps between whole ages go to Old."""
    word = F.lower(strip(as_col(c).cast("string")))
    age = coerce_numeric(c)
    out = F
    for key, label in K.SMART_AGE_WORDS.items():
        out = out.when(word == key, label)
    return (
        out.when(age.isNull(), "Unknown")
        .when(age < 13, "Child")
        .when(age.between(13, 14), "Young Teen")
        .when(age.between(15, 17), "Teen")
        .when(age.between(18, 24), "Young Adult")
        .when(age.between(25, 59), "Adult")
        .otherwise("Old")
    )


def report_age_group(c) -> Column:
    """Coarse group: words found inside the text first, then whole numbers."""
    word = F.lower(strip(as_col(c).cast("string")))
    whole = F.when(word.rlike(r"^[0-9]+$"), word.try_cast("decimal(38,0)"))
    return (
        F.when(F.contains(word, F.lit("teen")), "Teen")
        .when(F.contains(word, F.lit("senior")), "Senior")
        .when(F.contains(word, F.lit("adult")), "Adult")
        .when(F.contains(word, F.lit("child")), "Child")
        .when(whole < 13, "Child")
        .when(whole < 20, "Teen")
        .when(whole < 60, "Adult")
        .when(word.rlike(r"^[0-9]+$"), "Senior")
        .otherwise("Unknown")
    )


# --- dates ---------------------------------------------------------------------

def parse_date(c, formats=("M/d/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")) -> Column:
    """First format that fits; NULL when none does."""
    text = strip(as_col(c).cast("string"))
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def parse_date_robust(c) -> Column:
    """Month-first, else day-first, else NULL."""
    return parse_date(c, ("M/d/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "d/M/yyyy"))


def parse_hour(c) -> Column:
    """Hour of a 12-hour or 24-hour clock text."""
    text = F.upper(strip(as_col(c)))
    stamps = [
        F.try_to_timestamp(text, F.lit(f))
        for f in ("h:mm a", "h:mm:ss a", "H:mm", "H:mm:ss", "h a")
    ]
    return F.hour(F.coalesce(*stamps))


def month_name(month) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in K.MONTH_SHORT]), as_col(month))


def season(month, seasons=K.SEASONS) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in seasons]), as_col(month))


def date_parts(c) -> dict[str, Column]:
    c = as_col(c)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "quarter": F.quarter(c),
        "day_of_week": F.weekday(c),
        "day_of_year": F.dayofyear(c),
        "month_name": F.date_format(c, "MMMM"),
    }


def cyclic(c, period: int) -> tuple[Column, Column]:
    angle = as_col(c) * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


# --- labels --------------------------------------------------------------------

def percent_label(share, digits: int = 1) -> Column:
    share = as_col(share)
    return F.when(share.isNotNull(), F.format_string(f"%.{digits}f%%", share))


def significance(p) -> Column:
    p = as_col(p)
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def error_color(predicted, actual) -> Column:
    err = F.abs(as_col(predicted) - as_col(actual))
    return F.when(err <= 1, "green").when(err <= 2, "orange").otherwise("red")


def change_color(predicted, previous) -> Column:
    change = as_col(predicted) - as_col(previous)
    return (
        F.when(change > 1, "red").when(change > 0, "orange")
        .when(change < -1, "green").otherwise("blue")
    )


def r2_verdict(r2) -> Column:
    r2, out = as_col(r2), F
    for bound, word in K.R2_VERDICTS:
        out = out.when(r2 > bound, word)
    return out.otherwise("weak")


def cluster_color(label, colors=K.CLUSTER_COLORS) -> Column:
    palette = F.array(*[F.lit(c) for c in colors])
    return F.element_at(palette, (F.pmod(as_col(label), F.lit(len(colors))) + 1).cast("int"))


def round_even(c, digits: int) -> Column:
    """Round half to even on the scaled binary value, as array libraries do."""
    scale = float(10**digits)
    return F.rint(as_col(c) * scale) / scale


def rate_ratio(count, previous) -> Column:
    """Growth of a count against the one before, which gets one added."""
    return as_col(count) / (as_col(previous) + 1.0)


def split_marker(period, first_test) -> Column:
    """TRAIN before the first period of the test, TEST from it on."""
    return F.when(as_col(period) < first_test, "TRAIN").otherwise("TEST")


def not_negative(value) -> Column:
    """Forecasts below zero become zero."""
    return F.greatest(as_col(value), F.lit(0.0))
