"""Forecast features, models, searches and back-tests."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import not_negative
from ..operators import forecast as fc
from ..operators import summaries as sm
from ..operators.joins import attach_actuals, forecast_grid
from ..operators.ordering import latest_per_group
from ..plans import evaluation as ev
from . import bindings as b
from .registry import query, rounded

_TEST_YEAR = 2000
_CENTROID = """cent AS (SELECT district, avg(latitude) AS latitude,
  avg(longitude) AS longitude, avg(age) AS age FROM cases GROUP BY district)"""


@query("next_year_features", f"""WITH {b.CASES}, {_CENTROID}, prev AS (
  SELECT district, count(case_id) AS n FROM cases WHERE year = 2001 GROUP BY district)
SELECT cent.district, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
  round(age, 6) AS age, coalesce(n, 0) AS prev_count, 2002 AS year
FROM cent LEFT JOIN prev ON cent.district = prev.district""")
def next_year_features(spark, sf):
    return rounded(fc.next_year_frame(b.cases(spark, sf), 2002))


@query("scenario_features", f"""WITH {b.CASES}, {_CENTROID}, p AS (
  SELECT district, year + 1 AS year, count(case_id) AS n FROM cases GROUP BY 1, 2),
 y AS (SELECT CAST(unnest([2001, 2002, 2005]) AS INTEGER) AS year)
SELECT cent.district, y.year, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
  round(age, 6) AS age, coalesce(n, 0) AS prev_count
FROM cent CROSS JOIN y LEFT JOIN p ON p.district = cent.district AND p.year = y.year""")
def scenario_features(spark, sf):
    return rounded(fc.scenario_frame(b.cases(spark, sf), [2001, 2002, 2005]))


@query("backtest_features", f"""WITH {b.CASES}, hist AS (
  SELECT * FROM cases WHERE year < {_TEST_YEAR}),
 cent AS (SELECT district, avg(latitude) AS latitude, avg(longitude) AS longitude,
   avg(age) AS age, count(*) FILTER (year = {_TEST_YEAR} - 1) AS prev_count
   FROM hist GROUP BY district),
 act AS (SELECT district, count(*) AS n FROM cases WHERE year = {_TEST_YEAR} GROUP BY district)
SELECT cent.district, {_TEST_YEAR} AS year, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, round(age, 6) AS age, prev_count,
  coalesce(n, 0) AS actual_cases
FROM cent LEFT JOIN act ON cent.district = act.district""")
def backtest_features(spark, sf):
    c = b.cases(spark, sf)
    history, test = c.filter(F.col("year") < _TEST_YEAR), c.filter(F.col("year") == _TEST_YEAR)
    return rounded(attach_actuals(forecast_grid(history, test, _TEST_YEAR), test))


@query("cv_folds", "WITH " + b.CASES + """, p AS (
  SELECT district, year, count(*) AS n FROM cases GROUP BY 1, 2)
SELECT district, year, CAST(ntile(3) OVER (ORDER BY district, year) - 1 AS INTEGER) AS fold
FROM p""")
def cv_folds(spark, sf):
    p = sm.panel(b.cases(spark, sf)).select("district", "year")
    return fc.with_folds(p, ["district", "year"], 3)


def _metrics_sql(source: str) -> str:
    return f"""SELECT round(1 - sum((y - p) ** 2) / sum((y - m) ** 2), 6) AS r2,
  round(sqrt(avg((y - p) ** 2)), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae
FROM {source}, (SELECT avg(y) AS m FROM {source})"""


@query("regression_metrics", """WITH d AS (
  SELECT l_quantity AS y, l_extendedprice / 2000 AS p FROM lineitem) """ + _metrics_sql("d"))
def regression_metrics(spark, sf):
    df = b.table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("y"), (F.col("l_extendedprice") / 2000).alias("p")
    )
    return rounded(fc.regression_metrics(df, "y", "p"))


@query("forecast_totals", "WITH " + b.CASES + """, d AS (
  SELECT district, count(*) FILTER (year = 2000) AS a,
    count(*) FILTER (year = 1999) * 1.01 AS p FROM cases GROUP BY district),
 t AS (SELECT CAST(sum(a) AS BIGINT) AS a, sum(CAST(p AS DOUBLE)) AS p FROM d)
SELECT a AS actual_total, round(p, 6) AS predicted_total, round(abs(a - p), 6) AS abs_error,
  round(abs(a - p) * 100.0 / a, 6) AS error_pct,
  round(100.0 - abs(a - p) * 100.0 / a, 6) AS accuracy_pct FROM t""")
def forecast_totals(spark, sf):
    df = b.cases(spark, sf).groupBy("district").agg(
        F.count_if(F.col("year") == 2000).alias("actual_cases"),
        (F.count_if(F.col("year") == 1999) * F.lit(1.01)).alias("predicted_cases"),
    )
    return rounded(fc.forecast_totals(df))


@query("model_table", """WITH d AS (
  SELECT l_quantity AS y, l_extendedprice / 2000 AS p1, 24 + l_discount AS p2 FROM lineitem),
 m AS (SELECT avg(y) AS m FROM d),
 r AS (SELECT 'a' AS model, 1 - sum((y - p1) ** 2) / sum((y - m) ** 2) AS r2,
    sqrt(avg((y - p1) ** 2)) AS rmse, avg(abs(y - p1)) AS mae, 0.9::DOUBLE AS tr FROM d, m
  UNION ALL SELECT 'b', 1 - sum((y - p2) ** 2) / sum((y - m) ** 2), sqrt(avg((y - p2) ** 2)),
    avg(abs(y - p2)), 0.1::DOUBLE FROM d, m)
SELECT model, round(r2, 6) AS r2, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
  round(tr - r2, 6) AS overfit_gap, r2 = (SELECT max(r2) FROM r) AS best,
  CASE WHEN r2 > 0.3 THEN 'strong' WHEN r2 > 0.15 THEN 'moderate' ELSE 'weak' END AS verdict
FROM r""")
def model_table(spark, sf):
    df = b.table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("y"), (F.col("l_extendedprice") / 2000).alias("p1"),
        (24 + F.col("l_discount")).alias("p2"),
    )
    return rounded(fc.model_comparison(df, "y", {"a": "p1", "b": "p2"}, {"a": 0.9, "b": 0.1}))


# --- fits -----------------------------------------------------------------------------------


def _train(spark, sf):
    return fc.training_frame(b.cases(spark, sf))


@query("poisson_fit")
def poisson_fit(spark, sf):
    model = fc.fit_counts(_train(spark, sf), "poisson", {"alpha": 0.1})
    rows = list(zip(model.scaler.features, map(float, model.model.coefficients)))
    rows.append(("Intercept", float(model.model.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


_LAGGED = b.CASES + """, panel AS (
  SELECT district, year, count(case_id) AS case_count, avg(latitude) AS latitude,
         avg(longitude) AS longitude, avg(age) AS age FROM cases GROUP BY district, year),
 lagged AS (SELECT *, lag(case_count) OVER (PARTITION BY district ORDER BY year) AS prev_count
            FROM panel QUALIFY prev_count IS NOT NULL)"""


@query("poisson_score_equations", f"WITH {_LAGGED} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature,
        round(sum(case_count * {c}) / sum(case_count) / avg({c}), 5) AS weighted_mean
        FROM lagged""" for c in K.PANEL_FEATURES)
    + " UNION ALL SELECT 'total', round(CAST(sum(case_count) AS DOUBLE), 2) FROM lagged")
def poisson_score_equations(spark, sf):
    """Feature means weighted by the fitted counts of the unpenalised model.

    A fit is the maximum of the likelihood exactly if these equal the means
    weighted by the actual counts, which is what the SQL computes.
    """
    train = _train(spark, sf)
    model = fc.fit_counts(train, "poisson", {"alpha": 0.0})
    scored = model.predict(train, "mu")
    values = [
        F.round(F.sum(F.col("mu") * F.col(c)) / F.sum("mu") / F.avg(c), 5).alias(c)
        for c in K.PANEL_FEATURES
    ]
    wide = scored.agg(*values, F.round(F.sum("mu"), 2).alias("total"))
    return wide.unpivot([], wide.columns, "feature", "weighted_mean")


@query("poisson_penalised_equations", f"WITH {_LAGGED} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round((avg(case_count * {c}) - avg(case_count) * avg({c}))
        / stddev_pop({c}), 3) AS moment FROM lagged""" for c in K.PANEL_FEATURES))
def poisson_penalised_equations(spark, sf):
    """At the optimum of the penalised fit, the mean of fitted count times scaled
    feature plus alpha times its coefficient is the same mean of the actual counts."""
    alpha = 0.1
    train = _train(spark, sf)
    model = fc.fit_counts(train, "poisson", {"alpha": alpha})
    scored = model.model.transform(model.vectors(train)).select(
        "prediction", vector_to_array("features").alias("z")
    )
    wide = scored.agg(*[
        F.round(F.avg(F.col("prediction") * F.col("z")[j]) + alpha * float(coef), 3).alias(c)
        for j, (c, coef) in enumerate(zip(model.scaler.features, model.model.coefficients))
    ])
    return wide.unpivot([], wide.columns, "feature", "moment")


@query("poisson_inference")
def poisson_inference(spark, sf):
    train = _train(spark, sf).persist()
    try:
        model = fc.fit_counts(train, "poisson", {"alpha": 0.0})
        table, _ = fc.poisson_inference(model, train.count(), spark)
    finally:
        train.unpersist()
    return table


@query("poisson_scores")
def poisson_scores(spark, sf):
    train = _train(spark, sf).persist()
    try:
        model = fc.fit_counts(train, "poisson", {"alpha": 0.0})
        _, scores = fc.poisson_inference(model, train.count(), spark)
    finally:
        train.unpersist()
    return scores


_ODD = ("odd_count",)


def _odd_count(df):
    return df.withColumn("odd_count", F.col("prev_count") % 2)


#: Two groups: the Poisson fit on a 0/1 feature knows only their sizes and totals.
_GROUPS = f"""WITH {_LAGGED}, f AS (
  SELECT case_count AS y, prev_count % 2 AS odd FROM lagged),
 q AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(y) FILTER (odd = 0) AS t0, sum(y) FILTER (odd = 1) AS t1,
    avg(y) FILTER (odd = 0) AS m0, avg(y) FILTER (odd = 1) AS m1, avg(odd) AS m, stddev_pop(odd) AS sd FROM f)"""


def _two_groups(spark, sf):
    train = _odd_count(_train(spark, sf)).persist()
    try:
        model = fc.fit_counts(train, "poisson", {"alpha": 0.0}, _ODD)
        return fc.poisson_inference(model, train.count(), spark)
    finally:
        train.unpersist()


@query("poisson_inference_closed_form", f"""{_GROUPS}, e AS (
  SELECT 'odd_count' AS feature, ln(m1 / m0) * sd AS c, sd * sqrt(1 / t0 + 1 / t1) AS se FROM q
  UNION ALL SELECT 'Intercept', ln(m0) + m * ln(m1 / m0), sqrt(1 / t0 + m * m * (1 / t0 + 1 / t1) - 2 * m / t0) FROM q)
SELECT feature, round(c, 5) AS coefficient, round(se, 5) AS std_error, round(exp(c), 4) AS rate_ratio,
  round(c - 1.96 * se, 5) AS ci_lower, round(c + 1.96 * se, 5) AS ci_upper FROM e""")
def poisson_inference_closed_form(spark, sf):
    """Coefficients, errors and intervals of a fit on one standardised 0/1 feature."""
    table, _ = _two_groups(spark, sf)
    return table.select(
        "feature", *[F.round(c, 5).alias(c) for c in ("coefficient", "std_error", "ci_lower", "ci_upper")],
        F.round("rate_ratio", 4).alias("rate_ratio"),
    )


@query("poisson_scores_closed_form", f"""{_GROUPS}, l AS (
  SELECT 2 * sum(y * ln(y / mu) - (y - mu)) AS deviance, sum(y * ln(mu) - mu - lgamma(y + 1)) AS ll, max(n) AS n
  FROM (SELECT CAST(y AS DOUBLE) AS y, CASE odd WHEN 0 THEN m0 ELSE m1 END AS mu, n FROM f, q))
SELECT round(4 - 2 * ll, 3) AS aic, round(deviance, 3) AS deviance, round(deviance - (n - 2) * ln(n), 3) AS bic_deviance,
  round(2 * ln(n) - 2 * ll, 3) AS bic_likelihood, CAST(n AS INTEGER) AS n_rows FROM l""")
def poisson_scores_closed_form(spark, sf):
    _, scores = _two_groups(spark, sf)
    return rounded(scores, 3)


@query("forecast_closed_form", f"""{_GROUPS}, prev AS (
  SELECT district, count(case_id) FILTER (year = 2001) AS n FROM cases GROUP BY district)
SELECT district, round(CASE prev.n % 2 WHEN 0 THEN m0 ELSE m1 END, 4) AS predicted_cases, prev.n AS prev_count
FROM prev, q""")
def forecast_closed_form(spark, sf):
    """Forecast of every place by the fit on the 0/1 feature: the mean of its group."""
    model = fc.fit_counts(_odd_count(_train(spark, sf)), "poisson", {"alpha": 0.0}, _ODD)
    upcoming = _odd_count(fc.next_year_frame(b.cases(spark, sf), 2002))
    return rounded(model.predict(upcoming).select("district", "predicted_cases", "prev_count"), 4)


@query("scenarios_closed_form", f"""{_GROUPS}, p AS (
  SELECT district, year + 1 AS year, count(case_id) AS n FROM cases GROUP BY 1, 2),
 y AS (SELECT CAST(unnest([2001, 2002, 2005]) AS INTEGER) AS year), d AS (SELECT DISTINCT district FROM cases)
SELECT d.district, y.year, round(CASE coalesce(p.n, 0) % 2 WHEN 0 THEN m0 ELSE m1 END, 4) AS predicted_cases
FROM d CROSS JOIN y LEFT JOIN p ON p.district = d.district AND p.year = y.year, q""")
def scenarios_closed_form(spark, sf):
    model = fc.fit_counts(_odd_count(_train(spark, sf)), "poisson", {"alpha": 0.0}, _ODD)
    rows = _odd_count(fc.scenario_frame(b.cases(spark, sf), [2001, 2002, 2005]))
    return rounded(model.predict(rows).select("district", "year", "predicted_cases"), 4)


@query("gbt_fit")
def gbt_fit(spark, sf):
    model = fc.fit_counts(_train(spark, sf), "gradient_boosting", {"max_depth": 5})
    return model.importance(spark)


@query("feature_importance")
def feature_importance(spark, sf):
    return fc.fit_counts(_train(spark, sf), "poisson", {"alpha": 0.1}).importance(spark)


@query("grid_search")
def grid_search(spark, sf):
    _, table = fc.grid_search(
        _train(spark, sf), "poisson", K.POISSON_GRID, ["district", "year"]
    )
    return table


@query("grid_search_gbt")
def grid_search_gbt(spark, sf):
    _, table = fc.grid_search(
        _train(spark, sf), "gradient_boosting", K.GBT_GRID, ["district", "year"], scoring="neg_mse"
    )
    return table


@query("train_and_score")
def train_and_score(spark, sf):
    _, metrics = fc.train_and_score(b.cases(spark, sf), "poisson")
    return metrics


@query("rf_location")
def rf_location(spark, sf):
    cases = b.cases(spark, sf).select("row_id", "district", "latitude", "longitude", "age",
                                      "reported_date")
    df = fc.temporal_features(cases)
    return fc.fit_location_classifier(df)


@query("forecast_next_year")
def forecast_next_year(spark, sf):
    cases = b.cases(spark, sf)
    model = fc.fit_counts(_train(spark, sf), "poisson", {"alpha": 0.1})
    return fc.predict_hotspots(model, cases, 2002, 10)


@query("forecast_all_locations")
def forecast_all_locations(spark, sf):
    cases = b.cases(spark, sf)
    model = fc.fit_counts(_train(spark, sf), "poisson", {"alpha": 0.1})
    return fc.predict_hotspots(model, cases, 2002, None)


@query("scenarios")
def scenarios(spark, sf):
    model = fc.fit_counts(_train(spark, sf), "poisson", {"alpha": 0.1})
    return fc.scenario_forecasts(model, b.cases(spark, sf), [2002, 2003, 2004])


#: The trees are searched on the narrow grid; the wide one is an argument like any other.
_GRIDS = {"gradient_boosting": K.GBT_GRID, "poisson": K.POISSON_GRID_WIDE}


@query("backtest")
def backtest(spark, sf):
    out, _ = ev.backtest(b.cases(spark, sf), _TEST_YEAR, grids=_GRIDS)
    return out


@query("backtest_report")
def backtest_report(spark, sf):
    cases = b.cases(spark, sf)
    out, models = ev.backtest(cases, _TEST_YEAR, grids=_GRIDS)
    train = fc.training_frame(cases.filter(F.col("year") < _TEST_YEAR))
    return ev.backtest_report(out, models, train).join(ev.chosen_params(models, spark), "model")


#: A search whose fits have closed forms: on one 0/1 feature, a tree of depth 1 and
#: an unpenalised Poisson fit predict the mean of their group, a tree of depth 0 that of all.
_CLOSED = {
    "gradient_boosting": {"n_estimators": (1,), "learning_rate": (1.0,), "max_depth": (0, 1)},
    "poisson": {"alpha": (0.0,), "max_iter": (100, 200)},
}
_FOLDED = f"""WITH {_LAGGED.replace("FROM cases GROUP BY", f"FROM cases WHERE year < {_TEST_YEAR} GROUP BY")},
 f AS (SELECT district, year, case_count AS y, prev_count % 2 AS odd,
    ntile(3) OVER (ORDER BY district, year) - 1 AS fold FROM lagged),
 m AS (SELECT t.fold, avg(o.y) AS flat, avg(o.y) FILTER (o.odd = 0) AS m0, avg(o.y) FILTER (o.odd = 1) AS m1
   FROM (SELECT DISTINCT fold FROM f) t JOIN f o ON o.fold <> t.fold GROUP BY t.fold),
 sc AS (SELECT f.fold, avg((y - flat) ** 2) AS e0, avg((y - CASE odd WHEN 0 THEN m0 ELSE m1 END) ** 2) AS e1
   FROM f JOIN m USING (fold) GROUP BY f.fold),
 tot AS (SELECT -avg(e0) AS s0, -avg(e1) AS s1 FROM sc)"""


@query("grid_search_closed_form", f"""{_FOLDED}
SELECT 'n_estimators=1, learning_rate=1.0, max_depth=0' AS params, round(s0, 4) AS mean_score, s0 >= s1 AS best FROM tot
UNION ALL SELECT 'n_estimators=1, learning_rate=1.0, max_depth=1', round(s1, 4), s1 > s0 FROM tot
UNION ALL SELECT 'alpha=0.0, max_iter=100', round(s1, 4), true FROM tot
UNION ALL SELECT 'alpha=0.0, max_iter=200', round(s1, 4), false FROM tot""")
def grid_search_closed_form(spark, sf):
    """Scores of both searches on the history where they are group means."""
    history = b.cases(spark, sf).filter(F.col("year") < _TEST_YEAR)
    train = _odd_count(fc.training_frame(history)).persist()
    try:
        tables = [
            fc.grid_search(train, kind, grid, ["district", "year"], _ODD, scoring="neg_mse")[1]
            for kind, grid in _CLOSED.items()
        ]
    finally:
        train.unpersist()
    return rounded(tables[0].unionByName(tables[1]), 4)


@query("backtest_search", f"""{_FOLDED},
 fit AS (SELECT avg(y) AS flat, avg(y) FILTER (odd = 0) AS m0, avg(y) FILTER (odd = 1) AS m1 FROM f),
 now AS (SELECT district, count(*) FILTER (year = {_TEST_YEAR} - 1) AS prev_count FROM cases
   WHERE year < {_TEST_YEAR} GROUP BY district),
 act AS (SELECT district, count(*) AS n FROM cases WHERE year = {_TEST_YEAR} GROUP BY district),
 g AS (SELECT district, coalesce(n, 0) AS actual_cases,
    CASE prev_count % 2 WHEN 0 THEN m0 ELSE m1 END AS mean, flat, s0, s1
   FROM now LEFT JOIN act USING (district), fit, tot)
SELECT district, actual_cases, round(CASE WHEN s0 >= s1 THEN flat ELSE mean END, 4) AS predicted_gradient_boosting,
  round(mean, 4) AS predicted_poisson,
  'n_estimators=1, learning_rate=1.0, max_depth=' || CASE WHEN s0 >= s1 THEN 0 ELSE 1 END AS chosen_gradient_boosting,
  'alpha=0.0, max_iter=100' AS chosen_poisson
FROM g""")
def backtest_search(spark, sf):
    """Search, refit and predictions of a back-test where all of them are group means."""
    out, models = ev.backtest(
        b.cases(spark, sf), _TEST_YEAR, grids=_CLOSED, features=_ODD, derive=_odd_count
    )
    chosen = {f"chosen_{k}": F.lit(fc.params_text(m.params)) for k, m in models.items()}
    return rounded(out.withColumns(chosen).select(
        "district", "actual_cases", *[f"predicted_{k}" for k in models], *chosen
    ), 4)


@query("retrain_forecast")
def retrain_forecast(spark, sf):
    return ev.retrain_and_forecast(b.cases(spark, sf), _TEST_YEAR, "poisson", {"alpha": 0.1})


@query("retrain_best")
def retrain_best(spark, sf):
    return ev.retrain_best(b.cases(spark, sf), _TEST_YEAR, grids=_GRIDS)


@query("retrain_search", f"""{_FOLDED},
 hist AS (SELECT district, count(*) FILTER (year = {_TEST_YEAR} - 1) AS prev FROM cases
   WHERE year < {_TEST_YEAR} GROUP BY district),
 act AS (SELECT district, count(*) AS n FROM cases WHERE year = {_TEST_YEAR} GROUP BY district),
 every AS (SELECT y, odd FROM f UNION ALL SELECT coalesce(n, 0), coalesce(prev, 0) % 2
   FROM hist FULL JOIN act USING (district)),
 fit AS (SELECT avg(y) FILTER (odd = 0) AS m0, avg(y) FILTER (odd = 1) AS m1 FROM every),
 now AS (SELECT DISTINCT district FROM cases WHERE year <= {_TEST_YEAR})
SELECT district, coalesce(n, 0) AS prev_count, round(CASE coalesce(n, 0) % 2 WHEN 0 THEN m0 ELSE m1 END, 4)
  AS predicted_cases, 'poisson' AS model, 'alpha=0.0, max_iter=100' AS params
FROM now LEFT JOIN act USING (district), fit""")
def retrain_search(spark, sf):
    """Search, back-test, refit on all years and forecast where the fit is a group mean."""
    out = ev.retrain_best(
        b.cases(spark, sf), _TEST_YEAR, grids={"poisson": _CLOSED["poisson"]}, features=_ODD, derive=_odd_count
    )
    return rounded(out.select("district", "prev_count", "predicted_cases", "model", "params"), 4)


@query("feature_importance_closed_form", f"""{_GROUPS}
SELECT 'odd_count' AS feature, round(abs(ln(m1 / m0)) * sd, 5) AS importance FROM q""")
def feature_importance_closed_form(spark, sf):
    model = fc.fit_counts(_odd_count(_train(spark, sf)), "poisson", {"alpha": 0.0}, _ODD)
    return rounded(model.importance(spark), 5)


@query("gbt_onehot_forecast")
def gbt_onehot_forecast(spark, sf):
    """Forecast of every location with the validation scores of the model."""
    forecast, scores = fc.one_hot_forecast(sm.panel_centroid(b.cases(spark, sf)))
    one_row = scores.select(*[F.col(c).alias(f"validation_{c}") for c in scores.columns])
    return forecast.join(F.broadcast(one_row))


@query("latest_centroid_clamped", "WITH " + b.CASES + """, p AS (
  SELECT district, year, count(*) AS n, avg(latitude) AS la FROM cases GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY district ORDER BY year DESC) = 1)
SELECT district, 2002 AS year, CAST(greatest(n - 100, 0) AS DOUBLE) AS predicted_count FROM p""")
def latest_centroid_clamped(spark, sf):
    latest = latest_per_group(sm.panel_centroid(b.cases(spark, sf)), ["district"], "year")
    clamped = not_negative(F.col("case_count") - F.lit(100.0))
    return latest.select(
        "district", F.lit(2002).alias("year"), F.round(clamped, 6).alias("predicted_count")
    )
