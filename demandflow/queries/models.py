"""Fitted models. Their figures have no SQL equivalent; invariants are tested instead."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.config import (
    AggregationConfig,
    BacktestConfig,
    DataConfig,
    EvaluationConfig,
    FeatureConfig,
    ForecastConfig,
    ModelConfig,
    SplitConfig,
)
from demandflow.operators import metrics as m
from demandflow.operators import splits as sp
from demandflow.operators.encode import category_codes, category_values, encode
from demandflow.operators.features import build_features, existing, rolling_stats
from demandflow.plans import clusters, search
from demandflow.plans import grouped_models as gm
from demandflow.plans import models as mo
from demandflow.plans.forecast import model_backtest
from demandflow.plans.forecast import run_forecast as run
from demandflow.plans.local_models import fit_predict_local
from demandflow.queries import query
from demandflow.queries.common import SERIES, STORE_SERIES, retail, rounded
from demandflow.session import dimension_join, materialize

KEYS = (*SERIES, "date")
NUMERIC = ("onpromotion", "lag_1", "lag_7", "lag_14", "lag_28", "ma_7", "ma_28", "dow", "dom", "month", "year")
FOREST_FEATURES = (
    "onpromotion", "sales_lag_7", "sales_lag_14", "sales_rolling_mean_7", "promo_rolling_sum_7", "dow", "month", "year",
)
SMALL_TREES = {"maxDepth": 4, "maxIter": 10}
TRIALS = mo.grid(maxDepth=[3, 5], maxIter=[5, 10]) + [{"maxDepth": 4, "maxIter": 8, "stepSize": 0.2}]


def _features(spark: SparkSession, folder: str) -> DataFrame:
    series = retail(spark, folder).series
    features = build_features(
        series, "date", "sales", SERIES, (1, 7, 14, 28), (7, 28), extra_aggs={"onpromotion": "sum"}
    )
    return materialize(features, "features")


def _config(model: str, params: dict, backtest: bool = False) -> ForecastConfig:
    return ForecastConfig(
        data=DataConfig(group_cols=SERIES),
        aggregation=AggregationConfig(extra_aggs={"onpromotion": "sum"}),
        features=FeatureConfig(),
        split=SplitConfig(test_horizon=28),
        model=ModelConfig(type=model, params=params),
        evaluation=EvaluationConfig(backtest=BacktestConfig(enabled=backtest, folds=2)),
    )


@query
def global_forecast(spark: SparkSession, folder: str) -> DataFrame:
    split = sp.split_horizon(_features(spark, folder), SERIES, 28, 56)
    model = mo.fit_global(
        sp.part(split, sp.TRAIN), "sales", SERIES, NUMERIC, mo.make_estimator("spark_gbt", {"seed": 42, **SMALL_TREES})
    )
    return mo.predict_global(model, sp.part(split, sp.TEST), KEYS, "sales")


@query
def model_zoo(spark: SparkSession, folder: str) -> DataFrame:
    split = materialize(sp.split_horizon(_features(spark, folder), SERIES, 28, 56), "split")
    train, test = sp.part(split, sp.TRAIN), sp.part(split, sp.TEST)
    zoo = {
        "spark_gbt": {"seed": 42, **SMALL_TREES},
        "spark_rf": {"seed": 42, "numTrees": 20, "maxDepth": 5},
        "glm": {"regParam": 0.1},
    }
    scored = []
    for kind, params in zoo.items():
        model = mo.fit_global(train, "sales", SERIES, NUMERIC, mo.make_estimator(kind, params))
        scored.append(mo.predict_global(model, test, KEYS, "sales").withColumn("model_name", F.lit(kind)))
    return mo.compare_models(reduce(DataFrame.unionByName, scored))


@query
def log_gbt_forecast(spark: SparkSession, folder: str) -> DataFrame:
    split = sp.split_train_val_test(_features(spark, folder), 28, 28)
    model = mo.fit_log_boosting(split, "sales", SERIES, NUMERIC, {**SMALL_TREES, "validationTol": 0.001})
    return mo.predict_log(model, sp.part(split, sp.TEST), KEYS, "sales")


@query
def local_forecast(spark: SparkSession, folder: str) -> DataFrame:
    split = sp.split_horizon(retail(spark, folder).series, SERIES, 28, 56)
    split = materialize(split, "split")
    train, test = sp.part(split, sp.TRAIN), sp.part(split, sp.TEST)
    scored = [
        fit_predict_local(train, test, kind, SERIES, 28).withColumn("model_name", F.lit(kind))
        for kind in mo.LOCAL_MODELS
    ]
    return reduce(DataFrame.unionByName, scored)


@query
def local_store_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """One seasonal model per store and family."""
    split = materialize(sp.split_horizon(retail(spark, folder).sales, STORE_SERIES, 14, 56), "split")
    return fit_predict_local(sp.part(split, sp.TRAIN), sp.part(split, sp.TEST), "seasonal_local", STORE_SERIES, 28)


def _fit_and_score(split: DataFrame) -> DataFrame:
    model = mo.fit_global(sp.part(split, sp.TRAIN), "sales", SERIES, NUMERIC, mo.make_estimator("glm", {"regParam": 0.1}))
    return mo.predict_global(model, sp.part(split, sp.TEST), KEYS, "sales")


@query
def strategy_compare(spark: SparkSession, folder: str) -> DataFrame:
    split = materialize(sp.split_horizon(_features(spark, folder), SERIES, 28, 56), "split")
    errors = m.forecast_errors(m.family_daily(retail(spark, folder).pred))
    groups = materialize(m.family_groups(errors), "family_groups")
    scored = [
        mo.train_by_strategy(split, strategy, _fit_and_score, groups)
        for strategy in ("global", "by_family", "by_family_group")
    ]
    return m.regression_metrics(reduce(DataFrame.unionByName, scored), ["model_strategy", "model_name"])


def _family_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Test predictions of one forest per eligible family."""
    rows = rolling_stats(retail(spark, folder).series, SERIES)
    rows = rows.withColumns({"dow": F.dayofweek("date"), "month": F.month("date"), "year": F.year("date")})
    rows = materialize(rows, "forest_rows")
    used = existing(FOREST_FEATURES, rows)
    gate = sp.training_eligibility(rows, ["family"], used).filter("reason = 'eligible'").select("family")
    clean = dimension_join(rows, materialize(gate, "eligible"), "family", "inner").dropna(subset=["sales", *used])
    split = sp.split_fraction(clean, ["family"]).drop("split_date")

    def forest(one: DataFrame) -> DataFrame:
        estimator = mo.make_estimator("spark_rf", {"seed": 42, "numTrees": 10, "maxDepth": 5})
        model = mo.fit_global(sp.part(one, sp.TRAIN), "sales", [], used, estimator)
        return mo.predict_global(model, sp.part(one, sp.TEST), KEYS, "sales")

    return mo.train_by_strategy(split, "by_family", forest)


@query
def family_forest(spark: SparkSession, folder: str) -> DataFrame:
    return m.regression_metrics(_family_forest(spark, folder), ["family"])


@query
def fleet_summary(spark: SparkSession, folder: str) -> DataFrame:
    return m.fleet_summary(m.regression_metrics(_family_forest(spark, folder), ["family"]), "family")


@query
def tuning_grid(spark: SparkSession, folder: str) -> DataFrame:
    split = materialize(sp.split_last_days(_features(spark, folder)), "split")
    return mo.tune(split, TRIALS, "sales", SERIES, NUMERIC)


@query
def tuned_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Validation predictions of the model with the best parameters."""
    split = materialize(sp.split_last_days(_features(spark, folder)), "split")
    model = mo.fit_tuned(split, TRIALS, "sales", SERIES, NUMERIC)
    scored = mo.predict_log(model, sp.part(split, sp.VALIDATION), KEYS, "sales")
    return m.residuals(scored, "y", "prediction")


@query
def scenario_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The last 28 days scored under the current and the doubled promotion plan."""
    split = materialize(sp.split_last_days(_features(spark, folder)), "split")
    model = mo.fit_log_boosting(split, "sales", SERIES, NUMERIC, SMALL_TREES)
    rows = sp.part(split, sp.VALIDATION).drop("sales")
    plans = mo.scenario_features(rows, "onpromotion", {"current": 1, "onpromotion_2x": 2})
    scored = mo.predict_log(model, plans, [*KEYS, "scenario"])
    return scored.withColumnRenamed("prediction", "predicted_sales")


@query
def backtest_gbt(spark: SparkSession, folder: str) -> DataFrame:
    cfg = _config("spark_gbt", {"seed": 42, "maxDepth": 3, "maxIter": 5}, backtest=True)
    return model_backtest(_features(spark, folder), cfg)


@query
def run_forecast(spark: SparkSession, folder: str) -> DataFrame:
    result = run(retail(spark, folder).series, _config("spark_gbt", {"seed": 42, **SMALL_TREES}))
    return result.metrics_by_series


@query
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    split = materialize(sp.split_last_days(_features(spark, folder)), "split")
    train = sp.part(split, sp.TRAIN)
    estimator = mo.make_estimator("spark_rf", {"seed": 42, "numTrees": 20, "maxDepth": 5})
    return mo.feature_importance(mo.fit_global(train, "sales", SERIES, NUMERIC, estimator), train)


@query
def prediction_range(spark: SparkSession, folder: str) -> DataFrame:
    return m.prediction_range(global_forecast(spark, folder), ["family"])


@query
def model_reload_diff(spark: SparkSession, folder: str) -> DataFrame:
    split = materialize(sp.split_last_days(_features(spark, folder)), "split")
    model = mo.fit_global(
        sp.part(split, sp.TRAIN), "sales", SERIES, NUMERIC, mo.make_estimator("spark_gbt", {"seed": 42, **SMALL_TREES})
    )
    return mo.reload_difference(model, sp.part(split, sp.VALIDATION).select(*KEYS, *NUMERIC), KEYS)


# --- all groups at once -----------------------------------------------------------------------------

PROMO_FEATURES = ("onpromotion", "dow")


def _promo_rows(spark: SparkSession, folder: str) -> DataFrame:
    return retail(spark, folder).series.withColumn("dow", F.dayofweek("date"))


@query
def family_moments(spark: SparkSession, folder: str) -> DataFrame:
    """The sums that the models of all families are solved from."""
    sums = gm.moments(_promo_rows(spark, folder), ["family"], gm.features_of(PROMO_FEATURES), "sales")
    names = {"x": PROMO_FEATURES, "xy": [f"{c}_sales" for c in PROMO_FEATURES]}
    names["xx"] = ["onpromotion_onpromotion", "onpromotion_dow", "dow_dow"]
    arrays = [F.get(F.col(a), F.lit(i)).alias(f"sum_{c}") for a, columns in names.items() for i, c in enumerate(columns)]
    whole = [F.col("y").alias("sum_sales"), F.col("yy").alias("sum_sales_sales")]
    return sums.select("family", F.col("n").alias("row_count"), *whole, *arrays)


@query
def family_promo_effect(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per promotion of every family: a least-squares line each, all from one aggregation."""
    rows, features = _promo_rows(spark, folder), gm.features_of(["onpromotion"])
    centre = gm.centres(rows, features, "sales")
    sums = gm.moments(rows, ["family"], features, "sales", centre)
    lines = gm.solved(sums, ["family"], features, "sales", centre)
    slope = F.get(F.col("coefficients"), F.lit(0)).alias("slope")
    return rounded(lines.select("family", F.col("n").alias("row_count"), slope, "intercept"))


@query
def family_ridge(spark: SparkSession, folder: str) -> DataFrame:
    """Test errors of the ridge models of all strategies, fitted together."""
    split = materialize(sp.split_horizon(_features(spark, folder), SERIES, 28, 56), "split")
    errors = m.forecast_errors(m.family_daily(retail(spark, folder).pred))
    groups = materialize(m.family_groups(errors), "family_groups")
    states = [r[0] for r in split.select("state").distinct().orderBy("state").collect()]  # the regions
    features = gm.features_of(NUMERIC, {"state": states[1:]})
    train, test = sp.part(split, sp.TRAIN), sp.part(split, sp.TEST)
    scored = gm.train_together(train, test, gm.STRATEGIES, "sales", features, KEYS, 0.1, 30, groups)[1]
    return m.regression_metrics(scored, ["model_strategy", "model_name"])


@query
def tuning_search(spark: SparkSession, folder: str) -> DataFrame:
    """Trials that are proposed from earlier ones."""
    split = materialize(sp.split_last_days(_features(spark, folder)), "split")
    trials = search.search_boosting(split, "sales", SERIES, NUMERIC, budgets=(3, 9), rounds=3, width=4)
    return trials.withColumn("params", F.to_json("params"))


@query
def local_curves(spark: SparkSession, folder: str) -> DataFrame:
    """Additive curves, with promotions, and exponential smoothing of every series."""
    split = materialize(sp.split_horizon(retail(spark, folder).series, SERIES, 28, 56), "split")
    train, test = sp.part(split, sp.TRAIN), sp.part(split, sp.TEST)
    scored = []
    for kind in mo.CURVE_MODELS:
        columns = ["onpromotion"] if kind == "additive_local" else []
        one = fit_predict_local(train, test, kind, SERIES, 28, regressors=columns)
        scored.append(one.withColumn("model_name", F.lit(kind)))
    return reduce(DataFrame.unionByName, scored)


# --- error clusters ------------------------------------------------------------------------------


def _scaled_errors(spark: SparkSession, folder: str) -> DataFrame:
    errors = m.forecast_errors(m.family_daily(retail(spark, folder).pred))
    errors = materialize(errors, "errors")
    codes = category_codes(category_values(errors, ["family"]))
    coded = materialize(encode(errors, codes, ["family"]), "coded_errors")
    return materialize(clusters.scaled_features(coded), "scaled_errors")


@query
def error_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.assign_clusters(_scaled_errors(spark, folder)).select("family", "date", "error", "cluster")


@query
def cluster_profile(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_profile(clusters.assign_clusters(_scaled_errors(spark, folder)))


@query
def cluster_weekdays(spark: SparkSession, folder: str) -> DataFrame:
    clustered = clusters.assign_clusters(_scaled_errors(spark, folder))
    return m.crosstab_pct(clustered, "cluster", "day_of_week", range(7))


@query
def elbow_curve(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.elbow_curve(_scaled_errors(spark, folder), range(2, 11))
