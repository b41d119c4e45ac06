"""The whole way from raw cases to hotspots, as a set of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import forecast as fc
from ..operators import layers as ly
from ..operators.clusters import cluster_markers, cluster_statistics, target_groups
from ..operators.kmeans import best_k, fit_kmeans, k_sweep
from ..operators.quality import coordinate_check, data_summary
from ..session import materialize
from .cleaning import clean_cases, cleaning_report
from .reports import trend_report

POSITION = ("latitude", "longitude")


def hotspot_study(
    raw: DataFrame, k_range=(2, 10), n_init: int = 10, model="poisson", params=None,
    exact: bool = False, location="district",
) -> dict[str, DataFrame]:
    """Validate, clean, cluster, describe, forecast the year after the last one.

    Returns the tables by name; every one stays lazy but for the searches and
    fits.  ``exact=True`` takes the Euclidean silhouette in the search for k.
    """
    cleaned = materialize(clean_cases(raw))
    known = cleaned.filter(F.col("year").isNotNull())
    sweep = k_sweep(cleaned, POSITION, k_range, n_init=n_init, exact=exact)
    k = best_k(sweep).first()["k_silhouette"]
    clustered = fit_kmeans(cleaned, POSITION, k=k, n_init=n_init).transform(cleaned)
    next_year = known.agg(F.max("year")).first()[0] + 1
    fitted = fc.fit_counts(fc.training_frame(known, location), model, params)
    forecast = fc.predict_hotspots(fitted, known, next_year, None, location)
    return {
        "bounds": coordinate_check(cleaned),
        "cleaning": cleaning_report(raw),
        "summary": data_summary(cleaned, location=location),
        "k_search": sweep,
        "clusters": cluster_statistics(
            clustered, gender="gender", age_group="age_group", location=location
        ),
        "markers": cluster_markers(clustered),
        "target_groups": target_groups(clustered),
        "trends": trend_report(known),
        "forecast": forecast,
        "forecast_layer": ly.map_layer(forecast, "predicted_cases", location),
        "charts": ly.chart_bundle(clustered, label="cluster", location=location),
    }
