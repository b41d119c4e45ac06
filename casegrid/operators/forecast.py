"""Count forecasts per location: model fits, grid search, back-test, scenarios."""

from __future__ import annotations

import itertools
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.values import cyclic, date_parts, not_negative, r2_verdict, significance
from ..session import materialize
from .joins import previous_year_join
from .ordering import latest_per_group, top_n, with_global_row_number
from .scaling import Scaler, hash_split
from .summaries import lag_previous, location_centroid, panel

_PARALLEL_FITS = 8
#: Rows of one task of a fit: a fit runs hundreds of short jobs, which a small panel
#: split over many tasks only slows down.
_FIT_ROWS = 50_000


# --- features ------------------------------------------------------------------

def training_frame(cases: DataFrame, location="district", year="year", **cols) -> DataFrame:
    """Panel rows with the previous observed count of their location."""
    return lag_previous(panel(cases, location, year, **cols), location, year)


def next_year_frame(
    cases: DataFrame, target_year: int, location="district", year="year", **cols
) -> DataFrame:
    """Feature row of each location for the year to forecast."""
    return previous_year_join(
        location_centroid(cases, location), panel(cases, location, year, **cols),
        target_year, location, year,
    )


def scenario_frame(cases: DataFrame, years, location="district", year="year") -> DataFrame:
    """Feature rows of each location for several years, each on its own.

    The previous count comes from the data only; years without one get 0.
    """
    targets = F.array(*[F.lit(int(y)) for y in years])
    grid = location_centroid(cases, location).withColumn(year, F.explode(targets))
    prev = panel(cases, location, year).select(
        location, (F.col(year) + 1).alias(year), F.col("case_count").alias("prev_count")
    )
    return grid.join(prev, [location, year], "left").withColumn(
        "prev_count", F.coalesce("prev_count", F.lit(0))
    )


def temporal_features(df: DataFrame, date="reported_date") -> DataFrame:
    """Calendar parts of a date and their position on the yearly/weekly circle."""
    parts = date_parts(date)
    parts.pop("month_name")
    out = df.withColumns(parts)
    m_sin, m_cos = cyclic("month", 12)
    d_sin, d_cos = cyclic("day_of_week", 7)
    return out.withColumns(
        {"month_sin": m_sin, "month_cos": m_cos, "dow_sin": d_sin, "dow_cos": d_cos}
    )


# --- models --------------------------------------------------------------------

def poisson_estimator(alpha: float, mean_label: float, max_iter: int = 100):
    """Poisson regression, log link, penalty alpha/2 * |coef|^2 per mean deviance.

    The fitted means sum to the labels, so a penalty of n * alpha on the score
    equation is a regularisation of alpha / mean(label) here.
    """
    return GeneralizedLinearRegression(
        family="poisson", link="log", regParam=alpha / mean_label, maxIter=max_iter, tol=1e-8,
        featuresCol="features", labelCol="label", predictionCol="prediction",
    )


def gbt_estimator(
    n_estimators=100, learning_rate=0.1, max_depth=3, min_samples_split=2, seed=42
):
    """Boosted trees; a split needs min_samples_split rows, so a leaf half of it."""
    return GBTRegressor(
        maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth,
        minInstancesPerNode=max(1, math.ceil(min_samples_split / 2)), seed=seed,
        featuresCol="features", labelCol="label", predictionCol="prediction",
    )


def build_estimator(kind: str, params: dict, mean_label: float):
    if kind == "poisson":
        return poisson_estimator(
            params.get("alpha", 1.0), mean_label, params.get("max_iter", 100)
        )
    if kind == "gradient_boosting":
        return gbt_estimator(**params)
    raise ValueError(f"unknown model: {kind}")


@dataclass(frozen=True)
class CountModel:
    """Fitted model with its scaler and the parameters that were chosen."""

    kind: str
    model: Model
    scaler: Scaler
    params: dict = field(default_factory=dict)

    def vectors(self, df: DataFrame) -> DataFrame:
        return _assemble(df, self.scaler)

    def predict(self, df: DataFrame, out="predicted_cases") -> DataFrame:
        scored = self.model.transform(self.vectors(df))
        drop = ["features", *[f"_z_{c}" for c in self.scaler.features]]
        return scored.withColumnRenamed("prediction", out).drop(*drop)

    def importance(self, spark) -> DataFrame:
        """Impurity importance of the trees, or the size of the coefficients."""
        values = (
            self.model.featureImportances.toArray()
            if self.kind == "gradient_boosting"
            else [abs(v) for v in self.model.coefficients]
        )
        rows = [(f, float(v)) for f, v in zip(self.scaler.features, values)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.desc("importance"), "feature"
        )


def _assemble(df: DataFrame, scaler: Scaler) -> DataFrame:
    return VectorAssembler(
        inputCols=[f"_z_{c}" for c in scaler.features], outputCol="features"
    ).transform(scaler.transform(df, prefix="_z_"))


def _compact(data: DataFrame, n: int) -> DataFrame:
    return data.coalesce(max(1, -(-n // _FIT_ROWS)))


def fit_counts(
    train: DataFrame, kind: str, params: dict | None = None, features=K.PANEL_FEATURES,
    label="case_count",
) -> CountModel:
    params = dict(params or {})
    scaler = Scaler.fit(train, features)
    data = _assemble(train, scaler).select("features", F.col(label).cast("double").alias("label"))
    data = data.persist()
    try:
        mean, n = data.agg(F.avg("label"), F.count(F.lit(1))).first()
        model = build_estimator(kind, params, mean).fit(_compact(data, n))
    finally:
        data.unpersist()
    return CountModel(kind, model, scaler, params)


# --- scores --------------------------------------------------------------------

def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R2, RMSE and MAE in one pass."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    rss, tss = F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y)
    return df.agg(
        (1 - F.try_divide(rss, tss)).alias("r2"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
    )


def poisson_d2(df: DataFrame, actual="label", predicted="prediction") -> float:
    """Share of the Poisson deviance explained."""
    y, p = F.col(actual), F.col(predicted)
    y_log_y = F.when(y > 0, y * F.ln(y)).otherwise(0.0)
    row = df.agg(
        F.sum(y_log_y).alias("yly"), F.sum(F.when(y > 0, y * F.ln(p)).otherwise(0.0)).alias("ylp"),
        F.sum(y).alias("y"), F.sum(p).alias("p"), F.avg(y).alias("mean"),
    ).first()
    deviance = 2 * (row["yly"] - row["ylp"] - row["y"] + row["p"])
    null_deviance = 2 * (row["yly"] - row["y"] * math.log(row["mean"])) if row["y"] else 0.0
    return 1.0 - deviance / null_deviance if null_deviance else 0.0


def _score(kind: str, scoring: str, scored: DataFrame) -> float:
    if scoring == "neg_mse":
        return -scored.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0]
    if kind == "poisson":
        return poisson_d2(scored)
    return regression_metrics(scored, "label", "prediction").first()["r2"]


# --- grid search ---------------------------------------------------------------

def with_folds(df: DataFrame, order: list[str], folds: int = 3) -> DataFrame:
    """Contiguous folds in row order; the first n mod folds get one row more."""
    numbered = with_global_row_number(df, order, "_rn")
    n = numbered.agg(F.max("_rn")).scalar()
    size, extra = F.floor(n / folds), n % folds
    i = F.col("_rn") - 1
    head = extra * (size + 1)
    fold = F.when(i < head, F.floor(i / (size + 1))).otherwise(
        extra + F.floor((i - head) / F.greatest(size, F.lit(1)))
    )
    return numbered.withColumn("fold", fold.cast("int")).drop("_rn")


def expand_grid(grid: dict) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _families(kind: str, candidates: list[dict]) -> list[tuple[dict, list[int]]]:
    """Candidates that one fit answers: (parameters to fit, their positions).

    The first n trees of a boosted model are the model of n trees, so only the
    largest number is fitted; a Poisson fit that ended before a smaller limit of
    iterations is the fit under that limit too.
    """
    varied = {"gradient_boosting": "n_estimators", "poisson": "max_iter"}[kind]
    default = {"gradient_boosting": 100, "poisson": 100}[kind]
    families: dict = {}
    for i, c in enumerate(candidates):
        key = tuple(sorted((k, v) for k, v in c.items() if k != varied))
        families.setdefault(key, []).append((c.get(varied, default), i))
    return [
        ({**dict(key), varied: max(n for n, _ in members)}, [i for _, i in members])
        for key, members in families.items()
    ]


def _fold_scores(
    kind: str, scoring: str, candidates: list[dict], family, mean: float, fit_rows: DataFrame,
    test_rows: DataFrame,
) -> list[tuple[int, float]]:
    """(position, score) of every candidate of a family on one fold."""
    params, members = family
    model = build_estimator(kind, params, mean).fit(fit_rows)
    if kind == "gradient_boosting":
        mse = model.evaluateEachIteration(test_rows, "squared")  # after 1, 2, ... trees
        spread = 1.0 if scoring == "neg_mse" else test_rows.agg(F.var_pop("label")).first()[0]
        out = []
        for i in members:
            error = mse[candidates[i].get("n_estimators", 100) - 1]
            out.append((i, -error if scoring == "neg_mse" else 1.0 - error / spread if spread else 0.0))
        return out
    used, scores = model.summary.numIterations, {}

    def score(limit: int) -> float:
        """Score under a limit of iterations; the fit at hand if it kept to it."""
        key = params["max_iter"] if used <= limit else limit
        if key not in scores:
            fitted = model
            if key != params["max_iter"]:
                fitted = build_estimator(kind, {**params, "max_iter": limit}, mean).fit(fit_rows)
            scores[key] = _score(kind, scoring, fitted.transform(test_rows))
        return scores[key]

    return [(i, score(candidates[i].get("max_iter", 100))) for i in members]


def grid_search(
    train: DataFrame, kind: str, grid: dict, order: list[str], features=K.PANEL_FEATURES,
    label="case_count", folds: int = 3, scoring: str = "default",
) -> tuple[CountModel, DataFrame]:
    """Mean score of every parameter set over the folds; refit of the best one.

    The panel is scaled once on all rows, as its folds share one scaler.  The
    fits are independent Spark jobs and run a few at a time; parameter sets that
    differ in the number of trees or the limit of iterations share a fit.
    """
    spark = train.sparkSession
    # written once: scaler, folds and refit would each read the cases again
    train = materialize(train)
    scaler = Scaler.fit(train, features)
    data = (
        _assemble(with_folds(train, order, folds), scaler)
        .select("fold", "features", F.col(label).cast("double").alias("label"))
        .persist()
    )
    candidates = expand_grid(grid)
    try:
        means = {
            f: data.filter(F.col("fold") != f).agg(F.avg("label")).first()[0]
            for f in range(folds)
        }
        rows = _compact(data, data.count())

        def run(task):
            family, fold = task
            return _fold_scores(
                kind, scoring, candidates, family, means[fold],
                rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold),
            )

        tasks = list(itertools.product(_families(kind, candidates), range(folds)))
        with ThreadPoolExecutor(_PARALLEL_FITS) as pool:
            scores = [pair for part in pool.map(run, tasks) for pair in part]
    finally:
        data.unpersist()
    mean_score = {
        i: sum(s for j, s in scores if j == i) / folds for i in range(len(candidates))
    }
    best = max(mean_score, key=lambda i: (mean_score[i], -i))
    table = spark.createDataFrame(
        [
            (params_text(c), float(mean_score[i]), i == best)
            for i, c in enumerate(candidates)
        ],
        "params string, mean_score double, best boolean",
    )
    return fit_counts(train, kind, candidates[best], features, label), table


def params_text(params: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in params.items())


# --- training, evaluation, forecast ----------------------------------------------

def train_and_score(
    cases: DataFrame, kind: str, grid: dict | None = None, location="district", year="year",
    test_share: float = 0.2,
) -> tuple[CountModel, DataFrame]:
    """Panel with lag, random split, model (searched if a grid is given), scores."""
    frame = materialize(training_frame(cases, location, year))
    train, test = hash_split(frame, [location, year], test_share)
    if grid:
        model, _ = grid_search(train, kind, grid, [location, year])
    else:
        model = fit_counts(train, kind)
    metrics = None
    for split, rows in (("train", train), ("test", test)):
        scored = model.predict(rows.withColumnRenamed(year, "year"))
        part = regression_metrics(scored, "case_count", "predicted_cases")
        part = part.withColumn("split", F.lit(split))
        metrics = part if metrics is None else metrics.unionByName(part)
    wide = metrics.agg(
        F.lit(kind).alias("model"),
        *[
            F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
            for s in ("train", "test") for m in ("r2", "rmse")
        ],
    )
    return model, wide.withColumn("overfit_gap", F.col("train_r2") - F.col("test_r2"))


def predict_hotspots(
    model: CountModel, cases: DataFrame, target_year: int, n: int | None = 10,
    location="district", year="year",
) -> DataFrame:
    """Forecast per location; the n greatest ones, or all with n=None."""
    scored = model.predict(next_year_frame(cases, target_year, location, year))
    out = scored.select(
        location, "latitude", "longitude", "predicted_cases", "prev_count",
        (F.col("predicted_cases") / (F.col("prev_count") + 1)).alias("rate_ratio"),
    )
    return out if n is None else top_n(out, "predicted_cases", n, location)


def scenario_forecasts(model: CountModel, cases: DataFrame, years, location="district"):
    return model.predict(scenario_frame(cases, years, location)).select(
        location, "year", "latitude", "longitude", "prev_count", "predicted_cases"
    )


def model_comparison(scored: DataFrame, actual: str, predictions: dict, train_r2: dict):
    """One row per model: test R2, RMSE, MAE, overfit gap, best flag, verdict."""
    out = None
    for name, col in predictions.items():
        row = regression_metrics(scored, actual, col).select(
            F.lit(name).alias("model"), "r2", "rmse", "mae",
            (F.lit(float(train_r2[name])) - F.col("r2")).alias("overfit_gap"),
        )
        out = row if out is None else out.unionByName(row)
    best = out.agg(F.max(F.struct("r2", "model"))["model"]).scalar()
    return out.withColumns({"best": F.col("model") == best, "verdict": r2_verdict("r2")})


def forecast_totals(df: DataFrame, actual="actual_cases", predicted="predicted_cases"):
    """Total actual and predicted cases with error and accuracy in percent."""
    sums = df.agg(F.sum(actual).alias("actual_total"), F.sum(predicted).alias("predicted_total"))
    error = F.abs(F.col("actual_total") - F.col("predicted_total"))
    pct = F.try_divide(error * 100.0, F.col("actual_total"))
    return sums.withColumns(
        {"abs_error": error, "error_pct": pct, "accuracy_pct": F.lit(100.0) - pct}
    )


def poisson_inference(model: CountModel, n_rows: int, spark) -> tuple[DataFrame, DataFrame]:
    """Coefficients with errors, rate ratios, p values, 95 % intervals; fit scores.

    BIC comes in both usual forms: from the deviance and from the likelihood.
    """
    fit, summary = model.model, model.model.summary
    names = [*model.scaler.features, "Intercept"]
    coefs = [*map(float, fit.coefficients), float(fit.intercept)]
    errors, p_values = summary.coefficientStandardErrors, summary.pValues
    rows = [
        (n, c, float(e), math.exp(c), float(p), c - 1.96 * e, c + 1.96 * e)
        for n, c, e, p in zip(names, coefs, errors, p_values)
    ]
    table = spark.createDataFrame(
        rows,
        "feature string, coefficient double, std_error double, rate_ratio double, "
        "p_value double, ci_lower double, ci_upper double",
    ).withColumn("significant", significance("p_value"))
    k = len(names)
    loglik = (2 * k - summary.aic) / 2
    scores = spark.createDataFrame(
        [(
            float(summary.aic), float(summary.deviance),
            float(summary.deviance - (n_rows - k) * math.log(n_rows)),
            float(-2 * loglik + k * math.log(n_rows)), n_rows,
        )],
        "aic double, deviance double, bic_deviance double, bic_likelihood double, n_rows int",
    )
    return table, scores


def fit_location_classifier(
    df: DataFrame, location="district", features=("latitude", "longitude", "month", "quarter",
    "day_of_week", "month_sin", "month_cos", "dow_sin", "dow_cos", "age"),
    trees: int = 100, depth: int = 10, test_share: float = 0.2, key="row_id", seed: int = 42,
) -> DataFrame:
    """Random forest that names the location of a case; train and test accuracy."""
    features = [f for f in features if f in df.columns]
    usable = df.na.drop("any", subset=[*features, location]).select(key, location, *features)
    # written once and dealt out to all cores: a small file is one task, and a
    # forest goes over its rows many times
    usable = materialize(usable.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key))
    train, test = hash_split(usable, [key], test_share)
    scaler = Scaler.fit(train, features)
    indexer = StringIndexer(inputCol=location, outputCol="label", handleInvalid="keep").fit(usable)
    train, test = (indexer.transform(_assemble(d, scaler)) for d in (train, test))
    # rows know their node of each tree, and a pass takes as many nodes as 512 MB of counts hold
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label",
        cacheNodeIds=True, maxMemoryInMB=512,
    ).fit(train)
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    row = (
        accuracy.evaluate(forest.transform(train)), accuracy.evaluate(forest.transform(test)),
        len(features), usable.count(),
    )
    return df.sparkSession.createDataFrame(
        [row],
        "train_accuracy double, test_accuracy double, n_features int, n_samples bigint",
    )


def one_hot_forecast(
    centroids: DataFrame, location="district", period="year", params: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Boosted trees on year, centroid and one column per location.

    Forecasts the year after the last one from each location's latest centroid;
    negative forecasts become 0.  Returns (forecast, validation scores).
    """
    means = centroids.agg(F.avg("lat_mean").alias("a"), F.avg("lon_mean").alias("b")).first()
    indexer = StringIndexer(
        inputCol=location, outputCol="_index", stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(centroids)
    encoder = OneHotEncoder(inputCol="_index", outputCol="_dist", dropLast=False).fit(
        indexer.transform(centroids)
    )  # sparse vectors: no column for each location

    def prepare(df: DataFrame) -> DataFrame:
        filled = df.na.fill({"lat_mean": means["a"] or 0.0, "lon_mean": means["b"] or 0.0})
        wide = encoder.transform(indexer.transform(filled))
        inputs = [period, "lat_mean", "lon_mean", "_dist"]
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(wide).select(
            location, period, "features",
            *([F.col("case_count").cast("double").alias("label")]
              if "case_count" in df.columns else []),
        )

    data = prepare(centroids).persist()
    train, valid = hash_split(data, [location, period])
    model = gbt_estimator(**(params or {})).fit(train)
    scores = regression_metrics(model.transform(valid), "label", "prediction")
    next_year = centroids.agg(F.max(period)).first()[0] + 1
    latest = latest_per_group(centroids, [location], period).withColumn(period, F.lit(next_year))
    forecast = model.transform(prepare(latest.drop("case_count"))).select(
        location, not_negative("prediction").alias("predicted_count")
    )
    return forecast, scores
