"""Grouped counts, panels, histograms and shares.

Every aggregate here combines on the map side; windows run over aggregated
rows only (years, months, categories).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import age_cut, month_name, percent_label, season
from ..session import materialize
from .selection import exact_median


def _known(df: DataFrame, *cols) -> DataFrame:
    """Grouping ignores rows without a key."""
    return df.na.drop("any", subset=list(cols))


# --- panels --------------------------------------------------------------------

def panel(
    df: DataFrame, location="district", period="year", case_id="case_id",
    lat="latitude", lon="longitude", age="age",
) -> DataFrame:
    """Cases, mean position and mean age per location and period."""
    return _known(df, location, period).groupBy(location, period).agg(
        F.count(case_id).alias("case_count"),
        F.avg(lat).alias("latitude"),
        F.avg(lon).alias("longitude"),
        F.avg(age).alias("age"),
    )


def panel_centroid(
    df: DataFrame, location="district", period="year", lat="latitude", lon="longitude"
) -> DataFrame:
    """Rows and mean position per location and period."""
    return _known(df, location, period).groupBy(location, period).agg(
        F.count(F.lit(1)).alias("case_count"),
        F.avg(lat).alias("lat_mean"),
        F.avg(lon).alias("lon_mean"),
    )


def location_centroid(
    df: DataFrame, location="district", lat="latitude", lon="longitude", age="age"
) -> DataFrame:
    return _known(df, location).groupBy(location).agg(
        F.avg(lat).alias("latitude"), F.avg(lon).alias("longitude"), F.avg(age).alias("age")
    )


def actual_year_counts(
    df: DataFrame, year_value: int, location="district", year="year",
    lat="latitude", lon="longitude",
) -> DataFrame:
    return (
        _known(df.filter(F.col(year) == year_value), location)
        .groupBy(location)
        .agg(
            F.avg(lat).alias("latitude"),
            F.avg(lon).alias("longitude"),
            F.count(F.lit(1)).alias("actual_cases"),
        )
    )


def lag_previous(
    panel_df: DataFrame, location="district", period="year", count="case_count",
    calendar: bool = False, keep_first: bool = False,
) -> DataFrame:
    """Count of the previous observed period of the same location.

    With ``calendar`` the predecessor must be exactly one period earlier,
    else the previous count is 0.
    """
    w = W.partitionBy(location).orderBy(period)
    prev = F.lag(count, 1).over(w)
    if calendar:
        prev = F.when(F.lag(period, 1).over(w) == F.col(period) - 1, prev).otherwise(0)
    out = panel_df.withColumn("prev_count", prev)
    return out if keep_first or calendar else out.filter(F.col("prev_count").isNotNull())


# --- time ----------------------------------------------------------------------

def yearly_counts(df: DataFrame, year="year") -> DataFrame:
    return _known(df, year).groupBy(year).agg(F.count(F.lit(1)).alias("n")).orderBy(year)


def yearly_growth(df: DataFrame, year="year", keep_first: bool = True) -> DataFrame:
    """Cases per year and percent change on the year before it in the data."""
    per_year = _known(df, year).groupBy(year).agg(F.count(F.lit(1)).alias("cases"))
    prev = F.lag("cases").over(W.orderBy(year))  # one row per year
    out = per_year.withColumn("_prev", prev).withColumn(
        "growth_pct", (F.col("cases") - F.col("_prev")) * 100.0 / F.col("_prev")
    )
    out = out.withColumn(
        "growth_label", F.coalesce(percent_label("growth_pct"), F.lit("nan%"))
    )
    if not keep_first:
        out = out.filter(F.col("_prev").isNotNull())
    return out.drop("_prev").orderBy(year)


def monthly_counts(df: DataFrame, month="month") -> DataFrame:
    counts = _known(df, month).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("month_name", month_name(month)).orderBy(month)


def monthly_filled(df: DataFrame, month="month") -> DataFrame:
    """All twelve months, 0 where the data has none."""
    months = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias(month))
    counts = _known(df, month).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    return months.join(counts, month, "left").select(
        month, F.coalesce("n", F.lit(0)).alias("n")
    )


def month_intensity(df: DataFrame, month="month") -> DataFrame:
    """Share of each month's count in the greatest month's count."""
    filled = monthly_filled(df, month)
    peak = F.max("n").over(W.partitionBy())  # twelve rows
    return filled.withColumn("intensity", F.try_divide(F.col("n") * 1.0, peak))


def monthly_timeline(df: DataFrame, date="reported_date") -> DataFrame:
    month = F.trunc(F.col(date), "month").alias("month_start")
    return (
        _known(df, date).groupBy(month).agg(F.count(F.lit(1)).alias("n")).orderBy("month_start")
    )


def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return _known(df, a, b).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def peak_and_low_month(df: DataFrame, month="month") -> DataFrame:
    """Months with most and fewest cases; the earlier month on a tie."""
    counts = _known(df, month).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min(F.struct((-F.col("n")).alias("k"), F.col(month).alias("m")))["m"].alias("peak_month"),
        F.min(F.struct(F.col("n").alias("k"), F.col(month).alias("m")))["m"].alias("lowest_month"),
    )


def month_count_map(df: DataFrame, month="month") -> DataFrame:
    """One row: the count of every month that has cases, as a map of at most twelve."""
    counts = _known(df, month).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    entries = F.sort_array(F.collect_list(F.struct(month, "n")))
    return counts.agg(F.map_from_entries(entries).alias("counts"))


def season_counts(df: DataFrame, month="month", seasons=K.SEASONS) -> DataFrame:
    return (
        _known(df, month)
        .groupBy(season(month, seasons).alias("season"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- distributions -------------------------------------------------------------

def equal_width_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Counts in equal bins over the observed range; the last bin is closed."""
    known = _known(df, col).select(F.col(col).cast("double").alias("v"))
    span = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    bin_no = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
    )
    return (
        known.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin")
    )


def gaussian_density(df: DataFrame, col: str, grid: list[float]) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth at the given grid points.

    Rows collapse to distinct values first; each distinct value then adds to
    the few grid points, which sit in the plan as a literal array.
    """
    known = _known(df, col).select(F.col(col).cast("double").alias("v"))
    per_value = known.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    stats = known.agg(
        F.struct(
            F.count(F.lit(1)).cast("double").alias("total"),
            (F.stddev_samp("v") * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("bandwidth"),
        )
    ).scalar()
    total, bandwidth = stats["total"], stats["bandwidth"]
    points = F.array(*[F.lit(float(g)) for g in grid])
    weights = per_value.select("v", "n", F.explode(points).alias("grid_point"))
    z = (F.col("grid_point") - F.col("v")) / bandwidth
    height = F.sum(F.col("n") * F.exp(-0.5 * z * z))
    return (
        weights.groupBy("grid_point")
        .agg(height.alias("_h"))
        .select(
            "grid_point",
            (F.col("_h") / (total * bandwidth * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
        )
        .orderBy("grid_point")
    )


def ordered_counts(df: DataFrame, value: Column, order) -> DataFrame:
    """Counts in a fixed category order, 0 for categories without rows."""
    counts = df.groupBy(value.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    table = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("category"))
                      for i, c in enumerate(order)])
    fixed = df.sparkSession.range(1).select(F.inline(table))
    return fixed.join(counts, "category", "left").select(
        "position", "category", F.coalesce("n", F.lit(0)).alias("n")
    ).orderBy("position")


def age_group_counts(df: DataFrame, age="age") -> DataFrame:
    return ordered_counts(df, age_cut(age), K.AGE_CUT_LABELS)


def known_unknown(df: DataFrame, missing: Column) -> DataFrame:
    return df.agg(F.count_if(~missing).alias("known"), F.count_if(missing).alias("unknown"))


def category_counts(
    df: DataFrame, columns: list[str], by: str | None = None, top: int | None = None
) -> DataFrame:
    """([by,] column_name, value, n): how often each value of the columns occurs, per group.

    Long form: a row a value, however many there are.  `top` keeps the most
    frequent values of each column and group (ties: the smaller value), by a rank
    limit that is applied before the shuffle.  NULL values and NULL groups are
    left out.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])
    group = [by] if by else []
    counts = (
        df.select(*group, F.inline(pairs)).na.drop("any")
        .groupBy(*group, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    if top is None:
        return counts
    order = W.partitionBy(*group, "column_name").orderBy(F.desc("n"), "value")
    return counts.withColumn("_rank", F.row_number().over(order)).filter(
        F.col("_rank") <= top
    ).drop("_rank")


def share_of_total(df: DataFrame, col: str) -> DataFrame:
    counts = _known(df, col).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", F.col("n") * 100.0 / total)


def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    return df.agg(
        F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"),
        F.lit(exact_median(df, col)).cast("double").alias("median"),
    )


def yearly_report(
    df: DataFrame, year="year", month="month", location="district", age_group="age_group",
    gender="gender", top: int = 5, age_order=K.REPORT_AGE_ORDER,
) -> DataFrame:
    """Months, top places, age groups and genders for every year and overall.

    Each row adds one item to each of four sections; the items are counted per
    year on the map side, and the overall counts are sums of the yearly ones.
    ``scope`` is the year or 'all'.
    """
    sections = {"month": month, "location": location, "age_group": age_group, "gender": gender}
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("section"), F.col(c).cast("string").alias("item"))
            for s, c in sections.items()
        ]
    )
    yearly = (
        df.filter(F.col(year).isNotNull())
        .select(F.col(year).cast("string").alias("scope"), F.inline(pairs))
        .filter(F.col("item").isNotNull())
        .groupBy("scope", "section", "item").agg(F.count(F.lit(1)).alias("n"))
    )
    overall = yearly.groupBy(F.lit("all").alias("scope"), "section", "item").agg(
        F.sum("n").alias("n")
    )
    counts = materialize(yearly.unionByName(overall))
    w = W.partitionBy("scope", "section").orderBy(F.desc("n"), "item")
    places = (
        counts.filter(F.col("section") == "location")
        .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
        .drop("rank")
    )
    fixed = [("month", str(m)) for m in range(1, 13)] + [("age_group", a) for a in age_order]
    fixed_items = F.array(
        *[F.struct(F.lit(s).alias("section"), F.lit(i).alias("item")) for s, i in fixed]
    )
    scopes = counts.select("scope").distinct().select("scope", F.inline(fixed_items))
    filled = scopes.join(counts, ["scope", "section", "item"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )
    genders = counts.filter(F.col("section") == "gender")
    return filled.unionByName(places).unionByName(genders)
