"""Evaluation plans: clustering search and forecast back-test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import forecast as fc
from ..operators.cluster_search import compare_methods, dbscan_grid, select_dbscan_params
from ..operators.joins import attach_actuals, fill_coordinates, forecast_grid
from ..operators.kmeans import best_k, fit_kmeans, k_sweep
from ..operators.ordering import label_encode
from ..session import materialize
from ..sources.writers import metric_document, write_csv


def evaluate_clustering(
    df: DataFrame, features, k_range=(2, 15), eps_list=K.DBSCAN_EPS_GRID_WIDE,
    min_samples_list=K.DBSCAN_MIN_SAMPLES_GRID, n_init=10, row_id="row_id", exact=False,
    districts: DataFrame | None = None, out: str | None = None,
) -> dict[str, DataFrame]:
    """Search k and (eps, min_samples), then compare both methods at their best.

    With `districts` (district, latitude, longitude) rows without a position take
    that of their district first, and those that still lack one are left out.
    Returns the tables by name: `k_search`, `recommended_k`, `dbscan_grid`,
    `dbscan_choice`, `comparison`, of the clusters with the recommended k their
    sizes and centres as `clusters`, and the metric document as `summary`.  With
    `out` the search tables are written there as CSV and the document as JSON.
    """
    features = list(features)
    if districts is not None:
        df = fill_coordinates(df, districts, lat=features[0], lon=features[1])
    df = materialize(df)
    sweep = k_sweep(df, features, k_range, n_init=n_init, exact=exact)
    best = best_k(sweep)
    k = best.first()["k_silhouette"]
    grid = dbscan_grid(df, features, eps_list, min_samples_list, row_id, exact)
    choice = select_dbscan_params(grid)
    chosen = choice.first()
    clustered = fit_kmeans(df, features, k=k, n_init=n_init).transform(df)
    comparison = compare_methods(
        df, features, k, chosen["eps"], chosen["min_samples"], n_init, row_id, exact
    )
    tables = {
        "k_search": sweep,
        "recommended_k": best,
        "dbscan_grid": grid,
        "dbscan_choice": choice,
        "comparison": comparison,
        "clusters": clustered.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(c) for c in features]
        ),
        "summary": evaluation_document(df, best, choice, comparison),
    }
    if out is not None:
        for name in ("k_search", "dbscan_grid", "comparison"):
            write_csv(tables[name], f"{out}/{name}")
        tables["summary"].write.mode("overwrite").text(f"{out}/summary")
    return tables


def evaluation_document(
    df: DataFrame, best: DataFrame, choice: DataFrame, comparison: DataFrame
) -> DataFrame:
    """One JSON text: rows, the k and the parameter pair that were chosen, their scores."""
    def scores(method: str, prefix: str) -> DataFrame:
        names = ("n_clusters", "silhouette", "davies_bouldin", "inertia", "noise_points")
        return comparison.filter(F.col("method") == method).select(
            *[F.col(c).alias(f"{prefix}_{c}") for c in names]
        )

    # five tables of one row each
    row = df.agg(F.count(F.lit(1)).alias("records")).join(
        best.select(F.col("k_silhouette").alias("kmeans_k"))
    ).join(
        choice.select(F.col("eps").alias("dbscan_eps"), F.col("min_samples").alias("dbscan_min_samples"))
    ).join(scores("K-Means", "kmeans")).join(scores("DBSCAN", "dbscan"))
    return metric_document(
        row, dataset=["records"],
        kmeans=["kmeans_k", "kmeans_silhouette", "kmeans_davies_bouldin", "kmeans_inertia"],
        dbscan=["dbscan_eps", "dbscan_min_samples", "dbscan_n_clusters", "dbscan_silhouette",
                "dbscan_davies_bouldin", "dbscan_noise_points"],
    )


def long_table(tables: dict[str, DataFrame]) -> DataFrame:
    """Several tables as one: the name of the table and each row as JSON."""
    parts = [
        t.select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("row"))
        for name, t in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def demographic_clusters(df: DataFrame, k_range=(2, 6), n_init=10, gender="gender", age="age"):
    """Cluster on age and gender code; k with the best silhouette."""
    known = df.filter(F.col(age).isNotNull()).withColumn(
        gender, F.coalesce(F.col(gender), F.lit("Unknown"))
    )
    coded = label_encode(known, [gender]).withColumns(
        {age: F.col(age).cast("double"), "gender_code": F.col(f"{gender}_code").cast("double")}
    )
    features = [age, "gender_code"]
    k = best_k(k_sweep(coded, features, k_range, n_init=n_init)).first()["k_silhouette"]
    return fit_kmeans(coded, features, k=k, n_init=n_init).transform(coded)


def backtest(
    cases: DataFrame, test_year: int, location="district", params: dict | None = None,
    grids: dict | None = None, features=K.PANEL_FEATURES, derive=None,
) -> tuple[DataFrame, dict]:
    """Fit on the years before, predict the test year for every location.

    `params` maps a model to its parameters; `grids` maps it to the values to
    search instead, on contiguous folds of the history in the order of location
    and year, by mean squared error.  `derive` adds columns of one's own to the
    history and to the rows to predict, for `features` that name them.  Returns
    the predictions of each model next to the actual counts, and the fitted
    models, which know the parameters that were chosen.
    """
    derive = derive or (lambda df: df)
    history = cases.filter(F.col("year") < test_year)
    test = cases.filter(F.col("year") == test_year)
    train = materialize(derive(fc.training_frame(history, location)))
    # the grid keeps a NULL location; it is not a place and gets no forecast
    grid = derive(forecast_grid(history, test, test_year, location))
    # a row per location, read by every score of every model
    out = materialize(attach_actuals(grid.filter(F.col(location).isNotNull()), test, location))
    models = {}
    if grids is None:
        for kind, options in (params or {"gradient_boosting": {}, "poisson": {}}).items():
            models[kind] = fc.fit_counts(train, kind, options, features)
    else:
        for kind, values in grids.items():
            models[kind], _ = fc.grid_search(
                train, kind, values, [location, "year"], features, scoring="neg_mse"
            )
    for kind, model in models.items():
        out = model.predict(out, f"predicted_{kind}")
    return out, models


def chosen_params(models: dict, spark) -> DataFrame:
    """(model, params): the parameters each model was fitted with."""
    rows = [(kind, fc.params_text(m.params)) for kind, m in models.items()]
    return spark.createDataFrame(rows, "model string, params string")


def backtest_report(scored: DataFrame, models: dict, train: DataFrame) -> DataFrame:
    """Model table of a back-test: test scores, overfit gap, best model."""
    train = materialize(train)
    train_r2 = {
        kind: fc.regression_metrics(m.predict(train), "case_count", "predicted_cases")
        .first()["r2"]
        for kind, m in models.items()
    }
    return fc.model_comparison(
        scored, "actual_cases", {k: f"predicted_{k}" for k in models}, train_r2
    )


def retrain_and_forecast(
    cases: DataFrame, last_year: int, kind="poisson", params: dict | None = None,
    location="district", features=K.PANEL_FEATURES, derive=None,
) -> DataFrame:
    """Refit on history plus the last year, forecast the year after it.

    `derive` and `features` are those of `backtest`.
    """
    derive = derive or (lambda df: df)
    history = cases.filter(F.col("year") < last_year)
    last = cases.filter(F.col("year") == last_year)
    columns = [*features, "case_count"]
    train = derive(fc.training_frame(history, location)).select(*columns)
    test = attach_actuals(
        derive(forecast_grid(history, last, last_year, location)).filter(F.col(location).isNotNull()),
        last, location,
    ).withColumnRenamed("actual_cases", "case_count").select(*columns)
    model = fc.fit_counts(train.unionByName(test), kind, params, features)
    upcoming = derive(
        forecast_grid(cases.filter(F.col("year") <= last_year), last, last_year + 1, location)
    ).filter(F.col(location).isNotNull())
    return model.predict(upcoming).select(
        location, "latitude", "longitude", "predicted_cases", "prev_count"
    ).orderBy(F.desc("predicted_cases"), location)


def retrain_best(
    cases: DataFrame, test_year: int, params: dict | None = None, location="district",
    grids: dict | None = None, features=K.PANEL_FEATURES, derive=None,
) -> DataFrame:
    """Back-test the models, refit the one with the best test R2 on all years, forecast.

    With `grids` the parameters of both models are searched in the back-test, and
    the winner keeps those it was chosen with.  `model` and `params` name it.
    """
    scored, models = backtest(cases, test_year, location, params, grids, features, derive)
    train = fc.training_frame(cases.filter(F.col("year") < test_year), location)
    report = backtest_report(scored, models, derive(train) if derive else train)
    best = report.filter("best").first()["model"]
    chosen = models[best].params
    return retrain_and_forecast(
        cases, test_year, best, chosen, location, features, derive
    ).withColumns(
        {"model": F.lit(best), "params": F.lit(fc.params_text(chosen))}
    )
