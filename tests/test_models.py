from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.config import BacktestConfig, DataConfig, EvaluationConfig, FeatureConfig, ForecastConfig, ModelConfig, SplitConfig
from demandflow.operators import metrics as m
from demandflow.operators import splits as sp
from demandflow.operators.features import build_features
from demandflow.plans import clusters
from demandflow.plans import models as mo
from demandflow.plans.forecast import model_backtest, run_forecast
from demandflow.plans.local_models import arima_forecast, fit_predict_local, seasonal_forecast
from demandflow.session import materialize

KEYS = ["family", "state", "date"]
NUMERIC = ["lag_1", "lag_7", "ma_7", "dow"]


@pytest.fixture(scope="module")
def series(spark):
    """Weekly pattern, level per family and a small deterministic disturbance."""
    pattern = F.array(*[F.lit(v) for v in (10.0, 12.0, 9.0, 11.0, 20.0, 30.0, 25.0)])
    grid = spark.range(200).select(
        F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("date"), pattern[(F.col("id") % 7).cast("int")].alias("base"), "id"
    )
    families = F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(k).alias("k")) for f, k in (("A", 1.0), ("B", 3.0))]))
    return materialize(
        grid.select("date", "id", "base", families.alias("g")).select(
            "date", F.col("g.family").alias("family"), F.lit("N").alias("state"),
            (F.col("base") * F.col("g.k") + F.col("id") * 13 % 5).alias("sales"),
        ),
        "series",
    )


@pytest.fixture(scope="module")
def split(series):
    features = build_features(series, "date", "sales", ["family", "state"], [1, 7], [7])
    return materialize(sp.split_horizon(features, ["family", "state"], 28, 56), "split")


def beats_the_mean(predictions, train):
    mean = train.agg(F.avg("sales")).first()[0]
    return m.regression_metrics(predictions).first().rmse < m.regression_metrics(
        predictions.withColumn("prediction", F.lit(mean))
    ).first().rmse


@pytest.mark.parametrize(("kind", "params"), [("spark_gbt", {"maxIter": 5, "seed": 1}), ("spark_rf", {"numTrees": 5, "seed": 1}), ("glm", {})])
def test_global_models(split, kind, params):
    train, test = sp.part(split, sp.TRAIN), sp.part(split, sp.TEST)
    model = mo.fit_global(train, "sales", ["family"], NUMERIC, mo.make_estimator(kind, params))
    predictions = mo.predict_global(model, test, KEYS, "sales")
    assert predictions.columns == [*KEYS, "y", "prediction"] and predictions.count() == 56
    assert predictions.filter("prediction IS NULL").count() == 0
    assert beats_the_mean(predictions, train)


def test_unknown_names_are_errors(split):
    with pytest.raises(ValueError, match="unknown model type"):
        mo.make_estimator("lgbm")
    with pytest.raises(ValueError, match="unknown strategy"):
        mo.train_by_strategy(split, "per_store", lambda rows: rows)
    with pytest.raises(ValueError, match="family groups"):
        mo.train_by_strategy(split, "by_family_group", lambda rows: rows)
    with pytest.raises(ValueError, match="unknown local model"):
        fit_predict_local(split, split, "prophet", ["family"], 3)


def test_unseen_category_is_scored(split):
    train, test = sp.part(split, sp.TRAIN), sp.part(split, sp.TEST)
    model = mo.fit_global(train.filter("family = 'A'"), "sales", ["family"], NUMERIC, mo.make_estimator("glm", {"regParam": 0.1}))
    assert mo.predict_global(model, test, KEYS, "sales").filter("prediction IS NOT NULL").count() == 56


def test_log_boosting_never_predicts_below_zero(split):
    three = sp.split_train_val_test(split.drop("split"), 28, 14)
    model = mo.fit_log_boosting(three, "sales", ["family"], NUMERIC, {"maxIter": 5})
    predictions = mo.predict_log(model, sp.part(three, sp.TEST), KEYS, "sales")
    assert predictions.filter("prediction < 0 OR prediction IS NULL").count() == 0
    assert beats_the_mean(predictions, sp.part(three, sp.TRAIN))


def test_reload_and_importance(split):
    train = sp.part(split, sp.TRAIN)
    model = mo.fit_global(train, "sales", ["family"], NUMERIC, mo.make_estimator("spark_rf", {"numTrees": 5, "seed": 1}))
    assert mo.reload_difference(model, train.select(*KEYS, *NUMERIC), KEYS).first().mean_abs_difference == 0.0
    importance = mo.feature_importance(model, train).collect()
    assert {r.feature for r in importance} == {*NUMERIC, "family"}
    assert sum(r.importance for r in importance) == pytest.approx(1.0)


def test_strategies(spark, split):
    groups = spark.createDataFrame([("A", "low_error"), ("B", "high_error")], "family string, family_group string")

    def fit(rows_):
        model = mo.fit_global(sp.part(rows_, sp.TRAIN), "sales", ["family"], NUMERIC, mo.make_estimator("glm", {"regParam": 0.1}))
        return mo.predict_global(model, sp.part(rows_, sp.TEST), KEYS, "sales")

    for strategy, names in (("global", {"global"}), ("by_family", {"A", "B"}), ("by_family_group", {"low_error", "high_error"})):
        scored = mo.train_by_strategy(split, strategy, fit, groups)
        assert {r.model_name for r in scored.select("model_name").distinct().collect()} == names
        assert scored.count() == 56


def test_tuning_orders_trials(split):
    two = materialize(sp.split_last_days(split.drop("split"), 28), "split")
    got = mo.tune(two, mo.grid(maxDepth=[2], maxIter=[2, 4]), "sales", ["family"], NUMERIC).collect()
    assert len(got) == 2 and got[0].rmsle <= got[1].rmsle
    model = mo.fit_tuned(two, mo.grid(maxDepth=[2], maxIter=[2, 4]), "sales", ["family"], NUMERIC)
    assert mo.predict_log(model, sp.part(two, sp.VALIDATION), KEYS, "sales").filter("prediction IS NULL").count() == 0
    assert mo.grid(a=[1, 2], b=[3]) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]


def test_local_models(series):
    keys = ["family", "state"]
    two = sp.split_horizon(series, keys, 14, 56)
    train, test = sp.part(two, sp.TRAIN), sp.part(two, sp.TEST)
    for kind in mo.LOCAL_MODELS:
        predictions = fit_predict_local(train, test, kind, keys, 14, order=(7, 1, 1))
        assert predictions.columns == [*keys, "date", "y", "prediction"] and predictions.count() == 28
        assert beats_the_mean(predictions, train)


def test_local_forecasters_follow_known_shapes():
    days = pd.date_range("2024-01-01", periods=140)
    weekly = pd.Series(np.tile([1.0, 2, 3, 4, 5, 6, 7], 20), days)
    np.testing.assert_allclose(seasonal_forecast(weekly, 7), [1, 2, 3, 4, 5, 6, 7], atol=1e-6)
    line = pd.Series(np.arange(140.0), days)
    np.testing.assert_allclose(arima_forecast((1, 1, 1))(line, 3), [140, 141, 142], atol=1e-6)
    np.testing.assert_allclose(arima_forecast((1, 1, 1))(line[:2], 3), [1, 1, 1])


def config(model, params, backtest):
    return ForecastConfig(
        data=DataConfig(group_cols=("family", "state")),
        features=FeatureConfig(lags=(1, 7), spans=(7,)),
        split=SplitConfig(test_horizon=14),
        model=ModelConfig(model, params),
        evaluation=EvaluationConfig(backtest=BacktestConfig(backtest, folds=2, fold_horizon=7, step=7)),
    )


def test_run_forecast_returns_all_frames(series):
    run = run_forecast(series, config("glm", {}, True))
    assert run.features.count() == run.train.count() + run.test.count()
    assert run.predictions.count() == 28 and run.metrics_by_series.count() == 2
    assert run.metrics_portfolio.first()["wMAPE"] < 0.5
    assert [r.fold for r in run.backtest.orderBy("fold").collect()] == [0, 1]
    local = run_forecast(series, config("seasonal_local", {}, False))
    assert local.backtest is None and local.predictions.count() == 28


def test_backtest_folds_have_full_horizon(series):
    features = materialize(build_features(series, "date", "sales", ["family", "state"], [1, 7], [7]), "features")
    metrics = model_backtest(features, config("glm", {}, True)).collect()
    assert len(metrics) == 2 and all(r["wMAPE"] < 0.5 for r in metrics)


def test_clusters(spark):
    data = [("A", day(n), 10.0, 10.0 + n % 2) for n in range(30)] + [("B", day(n), 10.0, 500.0 + n % 2) for n in range(10)]
    pred = spark.createDataFrame(data, "family string, date date, y double, prediction double")
    errors = m.forecast_errors(pred).withColumn("family_code", F.when(F.col("family") == "A", 0).otherwise(1))
    scaled = clusters.scaled_features(errors).cache()
    clustered = clusters.assign_clusters(scaled, 2)
    assert clustered.groupBy("family").agg(F.count_distinct("cluster")).filter("count(DISTINCT cluster) > 1").count() == 0
    profile = {r.top_family: r.row_count for r in clusters.cluster_profile(clustered).collect()}
    assert profile == {"A": 30, "B": 10}
    curve = [r.inertia for r in clusters.elbow_curve(scaled, (2, 4)).orderBy("k").collect()]
    assert curve[0] > curve[1]
    scaled.unpersist()


def test_local_models_cover_every_test_row(spark):
    """Sparse series end on different days, and one has no training rows."""
    data = [("a", day(3 * i), float(i)) for i in range(40)] + [("b", day(i), 1.0) for i in range(60)] + [("c", day(70), 2.0)]
    df = spark.createDataFrame(data, "s string, date date, sales double")
    train, test = df.filter(F.col("date") < day(45)).filter("s <> 'c'"), df.filter(F.col("date") >= day(45))
    for kind in mo.LOCAL_MODELS:
        got = {(r.s, r.date): r.prediction for r in fit_predict_local(train, test, kind, ["s"], order=(2, 1, 1)).collect()}
        assert len(got) == test.count()
        assert [k for k, v in got.items() if v is None] == [("c", day(70))]


def test_series_are_fitted_in_batches(spark):
    """Many short series go to Python together, and only the days of the test part come back."""
    r = np.random.default_rng(3)
    sizes = {s: int(r.integers(1, 120)) for s in range(60)}
    data = [(s if s else None, day(int(d)), float(d % 7 + s)) for s, n in sizes.items() for d in r.choice(400, n, replace=False)]
    data += [(61, day(n), None if n % 5 == 0 else 2.0) for n in range(30)] + [(61, None, 5.0), (62, day(1), None)]
    test_days = [(s if s else None, day(n), 1.0) for s in [*sizes, 61, 62, 63] for n in (0, 405, 420, 420)]
    schema = "s int, date date, sales double"
    train, test = spark.createDataFrame(data, schema), spark.createDataFrame(test_days, schema)
    out = fit_predict_local(train, test, "seasonal_local", ["s"], 14)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "FlatMapGroups" not in text
    got = [tuple(x) for x in out.collect()]
    assert len(got) == len(test_days) and all(x[3] is None for x in got if x[0] in (None, 62, 63))
    for s in (*range(1, 60), 61):
        rows_ = sorted((d, v) for k, d, v in data if k == s and d is not None)
        y = pd.Series([v for _, v in rows_], pd.DatetimeIndex([d for d, _ in rows_])).astype(float)
        y = y.asfreq("D").interpolate().ffill().bfill()
        ahead = max((pd.Timestamp(day(420)) - y.index[-1]).days, 14)
        days = pd.date_range(y.index[0], periods=len(y) + ahead)
        t = np.arange(len(days))
        year = 2 * np.pi * t / 365.25
        design = np.column_stack([np.eye(7)[days.dayofweek], t / t[-1], np.sin(year), np.cos(year)])
        beta = np.linalg.lstsq(design[: len(y)], y.to_numpy(), rcond=None)[0]
        expected = dict(zip(days.date[len(y) :], design[len(y) :] @ beta, strict=True))
        for _, d, _, p in (x for x in got if x[0] == s):
            assert p == (None if d not in expected else pytest.approx(expected[d], rel=1e-6, abs=1e-6))


def test_rows_without_a_feature_are_scored_as_missing(spark):
    train = spark.createDataFrame([(i, float(i), 2.0 * i) for i in range(30)], "id int, x double, sales double")
    model = mo.fit_global(train, "sales", [], ["x"], mo.make_estimator("glm"))
    rows_ = spark.createDataFrame([(1, 4.0, 8.0), (2, None, 1.0)], train.schema)
    got = {r.id: r.prediction for r in mo.predict_global(model, rows_, ["id"], "sales").collect()}
    assert got[1] == pytest.approx(8.0, abs=1e-6) and got[2] is None


def test_null_and_empty_groups_are_groups(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("", 3), (None, 4)], "g string, v int")
    got = {name: sorted(r.v for r in rows_.collect()) for name, rows_ in mo.by_group(df, "g")}
    assert got == {"a": [1], None: [2, 4], "": [3]}
