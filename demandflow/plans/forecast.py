"""End-to-end forecast run and model backtest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.config import ForecastConfig
from demandflow.operators.features import build_features, numeric_features
from demandflow.operators.metrics import metrics_by_series, metrics_portfolio
from demandflow.operators.splits import TEST, TRAIN, part, split_by_date, split_horizon, with_min_history
from demandflow.plans.backtest import backtest_metrics, train_rows, with_test_folds
from demandflow.plans.local_models import fit_predict_local
from demandflow.plans.models import LOCAL_MODELS, ForecastRun, fit_global, make_estimator, predict_global
from demandflow.session import materialize, side_by_side


def features_of(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """The modelling series of a run."""
    d, a, f = cfg.data, cfg.aggregation, cfg.features
    return build_features(
        df, d.date_col, d.target_col, d.group_cols, f.lags, f.spans, f.time_signals,
        target_agg=a.target_agg, extra_aggs=a.extra_aggs,
    )


def _split(features: DataFrame, cfg: ForecastConfig) -> DataFrame:
    d, s = cfg.data, cfg.split
    if s.mode == "horizon":
        return split_horizon(features, d.group_cols, s.test_horizon, d.min_train_periods, d.date_col)
    if s.mode == "date":
        enough = with_min_history(features, d.group_cols, d.min_train_periods)
        return split_by_date(enough, s.train_end_date, d.date_col)
    raise ValueError(f"unknown split mode {s.mode!r}")


def _predict(train: DataFrame, test: DataFrame, cfg: ForecastConfig, horizon: int) -> DataFrame:
    d, m = cfg.data, cfg.model
    if m.type in LOCAL_MODELS:
        return fit_predict_local(
            train, test, m.type, d.group_cols, horizon, d.date_col, d.target_col, m.params.get("order", (1, 1, 1))
        )
    numeric = numeric_features(train, [*d.group_cols, d.date_col, d.target_col, "fold", "step_ahead"])
    model = fit_global(train, d.target_col, d.group_cols, numeric, make_estimator(m.type, m.params))
    return predict_global(model, test, [*d.group_cols, d.date_col], d.target_col)


def model_backtest(features: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Portfolio metrics per fold, one fit per fold on the rows before its cutoff.

    ``features`` is read once per fold, so pass a written table.
    """
    d, b = cfg.data, cfg.evaluation.backtest
    tested = with_test_folds(features, d.group_cols, b.folds, b.fold_horizon, b.step, d.date_col)

    def scored(fold: int) -> DataFrame:
        train = train_rows(features, d.group_cols, fold, b.fold_horizon, b.step, d.date_col)
        test = tested.filter(F.col("fold") == fold).drop("fold", "step_ahead")
        return _predict(train, test, cfg, b.fold_horizon).withColumn("fold", F.lit(fold))

    predictions = reduce(DataFrame.unionByName, side_by_side(scored, range(b.folds)))
    return backtest_metrics(predictions, d.group_cols, cfg.evaluation.mase_seasonality)


def run_forecast(df: DataFrame, cfg: ForecastConfig) -> ForecastRun:
    """Aggregate, build features, split, fit, score and evaluate; backtest if asked for.

    The features are written once and shared by all later steps.
    """
    d, e = cfg.data, cfg.evaluation
    features = materialize(features_of(df, cfg), "features")
    split = _split(features, cfg)
    train, test = part(split, TRAIN), part(split, TEST)
    predictions = materialize(_predict(train, test, cfg, cfg.split.test_horizon), "predictions")
    return ForecastRun(
        features=features,
        train=train,
        test=test,
        predictions=predictions,
        metrics_by_series=metrics_by_series(predictions, d.group_cols, seasonality=e.mase_seasonality, date_col=d.date_col),
        metrics_portfolio=metrics_portfolio(predictions, d.group_cols, seasonality=e.mase_seasonality, date_col=d.date_col),
        backtest=model_backtest(features, cfg) if e.backtest.enabled else None,
    )
