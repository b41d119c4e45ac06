"""Models against their defining conditions; folds, grids and lookups."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from casegrid.operators import forecast as fc
from casegrid.operators import joins as jn
from casegrid.plans import evaluation as ev


@pytest.fixture(scope="module")
def cases(spark):
    rng = np.random.default_rng(1)
    rows, i = [], 0
    for d in range(8):
        for year in range(2018, 2026):
            if d == 7 and year < 2025:
                continue  # a place first seen in the test year
            for _ in range(int(rng.poisson(3 + d)) + 1):
                rows.append((i, f"D{d}", year, float(14 + d / 10 + rng.normal(0, 0.01)),
                             float(121 - d / 10), float(rng.integers(1, 90))))
                i += 1
    return spark.createDataFrame(
        rows, "case_id long, district string, year int, latitude double, longitude double, "
              "age double"
    ).cache()


@pytest.mark.parametrize("alpha", [0.0, 0.5])
def test_poisson_meets_its_score_equations(cases, alpha):
    train = fc.training_frame(cases)
    model = fc.fit_counts(train, "poisson", {"alpha": alpha})
    rows = model.model.transform(model.vectors(train)).select(
        "features", "case_count", "prediction"
    ).collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.case_count for r in rows], float)
    mu = np.array([r.prediction for r in rows])
    coef = np.array(model.model.coefficients)
    assert mu.sum() == pytest.approx(y.sum(), rel=1e-6)
    gap = x.T @ (mu - y) / len(y) + alpha * coef
    assert np.abs(gap).max() < 1e-5


def test_poisson_inference(spark, cases):
    train = fc.training_frame(cases)
    model = fc.fit_counts(train, "poisson", {"alpha": 0.0})
    n = train.count()
    table, scores = fc.poisson_inference(model, n, spark)
    rows = {r.feature: r for r in table.collect()}
    assert set(rows) == {*fc.K.PANEL_FEATURES, "Intercept"}
    r = rows["Intercept"]
    assert r.rate_ratio == pytest.approx(math.exp(r.coefficient))
    assert r.ci_upper - r.ci_lower == pytest.approx(2 * 1.96 * r.std_error)
    s = scores.first()
    assert s.bic_likelihood - s.aic == pytest.approx(6 * (math.log(n) - 2))


def test_d2_is_zero_for_the_mean_and_one_for_a_perfect_fit(spark):
    df = spark.createDataFrame([(0.0, 2.0, 0.001), (1.0, 2.0, 1.0), (5.0, 2.0, 5.0)],
                               "label double, mean double, near double")
    assert fc.poisson_d2(df, "label", "mean") == pytest.approx(0.0)
    assert fc.poisson_d2(df, "label", "near") == pytest.approx(1.0, abs=1e-3)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 5.0)], "y double, p double")
    r = fc.regression_metrics(df, "y", "p").first()
    assert r.r2 == pytest.approx(1 - 2 / 14)
    assert r.rmse == pytest.approx(math.sqrt(2 / 3)) and r.mae == pytest.approx(2 / 3)


def test_folds_are_contiguous_and_even(spark):
    df = spark.range(8).withColumnRenamed("id", "k")
    got = [r.fold for r in fc.with_folds(df, ["k"]).orderBy("k").collect()]
    assert got == [0, 0, 0, 1, 1, 1, 2, 2]


def test_grid_search_picks_the_best_mean_score(cases):
    model, table = fc.grid_search(
        fc.training_frame(cases), "poisson", {"alpha": (0.0, 5.0)}, ["district", "year"]
    )
    rows = {r.params: r for r in table.collect()}
    best = max(rows.values(), key=lambda r: r.mean_score)
    assert best.best and sum(r.best for r in rows.values()) == 1
    assert f"alpha={model.params['alpha']}" == best.params


def test_unseen_place_takes_overall_means(cases):
    history, test = cases.filter("year < 2025"), cases.filter("year = 2025")
    grid = {r.district: r for r in jn.forecast_grid(history, test, 2025).collect()}
    mean = history.agg(F.avg("latitude")).first()[0]
    assert len(grid) == 8
    assert grid["D7"].prev_count == 0 and grid["D7"].latitude == pytest.approx(mean)
    assert grid["D1"].prev_count == history.filter("district = 'D1' and year = 2024").count()


def test_forecast_lookup_without_prior_year_is_zero(cases):
    frame = {r.district: r for r in fc.next_year_frame(cases, 2030).collect()}
    assert all(r.prev_count == 0 and r.year == 2030 for r in frame.values())
    scen = fc.scenario_frame(cases, [2026, 2027]).collect()
    assert len(scen) == 16
    assert all((r.prev_count > 0) == (r.year == 2026) for r in scen)


def test_backtest_and_retrain(cases):
    params = {"gradient_boosting": {"n_estimators": 5, "max_depth": 2}, "poisson": {"alpha": 0.1}}
    out, models = ev.backtest(cases, 2025, params=params)
    rows = out.collect()
    assert len(rows) == 8 and sum(r.actual_cases for r in rows) == cases.filter(
        "year = 2025"
    ).count()
    report = ev.backtest_report(out, models, fc.training_frame(cases.filter("year < 2025")))
    flags = {r.model: r.best for r in report.collect()}
    assert set(flags) == set(params) and sum(flags.values()) == 1
    upcoming = ev.retrain_and_forecast(cases, 2025).collect()
    assert len(upcoming) == 8
    assert [r.predicted_cases for r in upcoming] == sorted(
        (r.predicted_cases for r in upcoming), reverse=True
    )


def test_boosted_trees_follow_a_step(spark):
    rows = [(float(i), float(i % 5), 2020.0, 1.0, 30.0, 10 if i < 20 else 50) for i in range(40)]
    train = spark.createDataFrame(
        rows, "latitude double, longitude double, year double, prev_count double, age double, "
              "case_count int"
    )
    model = fc.fit_counts(train, "gradient_boosting", {"n_estimators": 20, "max_depth": 2})
    metrics = fc.regression_metrics(model.predict(train), "case_count", "predicted_cases").first()
    assert metrics.r2 > 0.99
    assert model.importance(spark).first().feature == "latitude"


def test_one_hot_forecast_is_never_negative(cases):
    from casegrid.operators.summaries import panel_centroid

    forecast, scores = fc.one_hot_forecast(panel_centroid(cases), params={"n_estimators": 5})
    rows = forecast.collect()
    assert len(rows) == 8 and all(r.predicted_count >= 0 for r in rows)
    assert scores.first().rmse >= 0


def test_unknown_model_is_refused(cases):
    with pytest.raises(ValueError):
        fc.build_estimator("linear", {}, 1.0)
