from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.operators import metrics as m


@pytest.fixture
def pred(spark):
    rng = np.random.default_rng(7)
    data = []
    for s in ("x", "y"):
        y, p = rng.integers(0, 20, 30), rng.integers(0, 20, 30)
        data += [(s, day(n), float(a), float(b)) for n, (a, b) in enumerate(zip(y, p, strict=True))]
    data += [("zero", day(n), 0.0, 1.0) for n in range(10)] + [("short", day(0), 4.0, 2.0)]
    return spark.createDataFrame(data, "s string, date date, y double, prediction double")


def scale_free(pdf):
    err = (pdf["y"] - pdf["prediction"]).abs()
    size = pdf["y"].abs() + pdf["prediction"].abs()
    smape = np.where(size > 0, err / np.where(size > 0, size / 2, 1), 0.0).mean()
    wmape = err.sum() / pdf["y"].sum() if pdf["y"].sum() > 0 else None
    naive = (pdf["y"] - pdf["y"].shift(7)).abs().mean()
    return smape, wmape, err.mean() / naive if naive > 0 else None


def test_scale_free_metrics_against_pandas(pred):
    got = {r.s: r for r in m.metrics_by_series(pred, ["s"]).collect()}
    for s, pdf in pred.toPandas().sort_values("date").groupby("s"):
        smape, wmape, mase = scale_free(pdf)
        assert got[s]["sMAPE"] == pytest.approx(smape)
        assert got[s]["wMAPE"] == (None if wmape is None else pytest.approx(wmape))
        assert got[s]["MASE"] == (None if mase is None else pytest.approx(mase))
    assert got["short"]["MASE"] is None and got["zero"]["wMAPE"] is None and got["zero"]["MASE"] is None


def test_portfolio_pools_rows(pred):
    pdf = pred.toPandas()
    got = m.metrics_portfolio(pred, ["s"]).first()
    err = (pdf["y"] - pdf["prediction"]).abs()
    assert got["wMAPE"] == pytest.approx(err.sum() / pdf["y"].sum())
    assert got["level"] == "portfolio"
    assert {r.metric for r in m.metrics_long(m.metrics_portfolio(pred, ["s"])).collect()} == {"sMAPE", "wMAPE", "MASE"}


def test_regression_metrics_against_numpy(pred):
    pdf = pred.toPandas()
    y, p = pdf["y"].to_numpy(), pdf["prediction"].to_numpy()
    got = m.regression_metrics(pred).first()
    assert got.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got.mape == pytest.approx(np.abs((y - p) / np.where(y == 0, np.nan, y))[y != 0].mean() * 100)
    constant = m.regression_metrics(pred.filter("s = 'zero'")).first()
    assert constant.r2 is None and constant.mape is None


def test_best_is_the_smallest_error(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 3.0)], "model_name string, rmse double")
    assert rows(m.best_model(df)) == [("a", 2.0)]


def test_worst_and_best(pred):
    got = m.worst_and_best(m.regression_metrics(pred, ["s"]), 1, ["s"]).collect()
    by_rmse = m.regression_metrics(pred, ["s"]).orderBy("rmse").collect()
    assert {(r.side, r.s) for r in got} == {("worst", by_rmse[-1].s), ("best", by_rmse[0].s)}


def test_split_metrics_and_overfit(spark):
    df = spark.createDataFrame(
        [("train", 1.0, 1.5), ("validation", 1.0, 3.0), ("test", 0.0, 1.0)], "split string, y double, prediction double"
    )
    got = m.overfit_flag(m.split_metrics(df)).first()
    assert (got.train_rmse, got.validation_rmse, got.test_mae, got.possible_overfit) == (0.5, 2.0, 1.0, True)


def test_rmsle(pred):
    pdf = pred.toPandas()
    expected = np.sqrt(((np.log1p(pdf["prediction"]) - np.log1p(pdf["y"])) ** 2).mean())
    assert m.rmsle(pred).first()[0] == pytest.approx(expected)


def test_errors_and_groups(pred):
    named = pred.withColumnRenamed("s", "family")
    errors = m.forecast_errors(m.family_daily(named))
    zero = errors.filter("family = 'zero'").first()
    assert (zero.pct_error, zero.abs_error) == (0.0, 1.0)
    groups = {r.family: r.family_group for r in m.family_groups(errors).collect()}
    assert groups["zero"] == "low_error" and set(groups.values()) == {"low_error", "high_error"}
    summary = m.error_summary(errors).first()
    pdf = errors.toPandas()
    assert summary.mae == pytest.approx(pdf["abs_error"].mean())
    assert {r.family for r in m.family_error_summary(errors).collect()} == set(groups)


def test_crosstab_rows_add_up(pred):
    wide = m.crosstab_pct(m.forecast_errors(pred), "s", "day_of_week", range(7))
    for r in wide.collect():
        assert sum(r[str(d)] for d in range(7)) == pytest.approx(100)


def test_topk_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("g", v) for v in "bbaacdd"], "g string, v string")
    assert [(r.v, r.position) for r in m.topk_values(df, "g", "v", 2).orderBy("position").collect()] == [("a", 1), ("b", 2)]
    assert rows(m.most_frequent(df, "g", "v")) == [("g", "a")]


def test_totals_and_top_groups(pred):
    daily = m.actual_vs_predicted(pred, ["date"], "y", "prediction")
    assert daily.agg(F.sum("actual")).first()[0] == pred.agg(F.sum("y")).first()[0]
    top = m.top_groups_daily(pred, "s", 1, "y", "prediction")
    assert top.select("s").distinct().count() == 1
    weekly = m.weekly_actual_vs_predicted(pred, y="y", prediction="prediction")
    assert rows(weekly)[0][0] == day(0) and weekly.count() == 5


def test_model_pivot_roundtrip(spark):
    df = spark.createDataFrame([("f", "a", 0.123), ("f", "b", 0.5), ("g", "a", 1.0)], "family string, model string, r2 double")
    wide = m.model_pivot(df, "family", "model", ["a", "b"])
    assert rows(wide) == [("f", 0.12, 0.5), ("g", 1.0, None)]
    assert ("f", "a", 0.12) in rows(m.model_melt(wide, "family", ["a", "b"]))


def test_fleet_summary(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 0.1), ("b", 2.0, 1.0, 0.9), ("c", 3.0, 1.0, 0.4)], "family string, rmse double, mae double, r2 double")
    got = m.fleet_summary(df, "family").first()
    assert (got.models, got.median_r2, got.best_family, got.worst_family) == (3, 0.4, "b", "a")


def test_prediction_sample_is_ordered_and_signed_by_the_prediction(pred):
    got = m.prediction_sample(pred.filter("s = 'short'").union(pred.filter("s = 'zero'")), ["s", "date"], 2).collect()
    assert [(r.s, r.error, r.abs_error, r.pct_error) for r in got] == [("short", -2.0, 2.0, 50.0), ("zero", 1.0, 1.0, None)]


def test_rows_without_prediction_are_left_out(spark):
    data = [("a", day(0), 1.0, 2.0), ("a", day(1), 3.0, 2.0), ("a", day(2), 100.0, None)]
    df = spark.createDataFrame(data, "s string, date date, y double, prediction double")
    got = m.regression_metrics(df).first()
    assert (got["sample_count"], got["avg_actual"], got["r2"]) == (2, 2.0, 0.0)
    assert abs(m.metrics_by_series(df, ["s"], seasonality=1).first()["sMAPE"] - (2 / 3 + 0.4) / 2) < 1e-12
    assert m.metrics_by_series(df, ["s"], seasonality=1).first()["wMAPE"] == 0.5
    assert tuple(m.unpaired(df).first()) == (3, 1)


def test_negative_predictions_count_as_zero_in_rmsle(spark):
    df = spark.createDataFrame([(1.0, 1.5), (1.0, -3.0)], "y double, prediction double")
    logs = [math.log1p(1.5) - math.log1p(1), -math.log1p(1)]
    assert abs(m.rmsle(df).first()[0] - math.sqrt(sum(x * x for x in logs) / 2)) < 1e-12


def test_levels_equal_the_single_ones_with_one_more_exchange(spark):
    data = [
        (f, s, day(n), None if n == 5 else float((n * 7 + k) % 11), None if n == 9 else float((n * 3 + k) % 13))
        for k, (f, s) in enumerate([("A", "N"), ("A", "S"), ("B", "N"), (None, "N")]) for n in range(30)
    ]
    df = spark.createDataFrame(data, "family string, state string, date date, y double, prediction double")
    keys = ["family", "state"]
    found = m.metrics_levels(df, keys, [keys, ["family"], []])
    got = {(r.level, r.family, r.state): (r.sMAPE, r.wMAPE, r.MASE) for r in found.collect()}
    want = {("family, state", r.family, r.state): (r.sMAPE, r.wMAPE, r.MASE) for r in m.metrics_by_series(df, keys).collect()}
    want |= {("family", r.family, None): (r.sMAPE, r.wMAPE, r.MASE) for r in m.metrics_portfolio(df, keys, by=["family"]).collect()}
    want |= {("portfolio", None, None): (r.sMAPE, r.wMAPE, r.MASE) for r in m.metrics_portfolio(df, keys).collect()}
    assert got.keys() == want.keys()
    for key, figures in want.items():
        assert got[key] == pytest.approx(figures)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Window [") <= 2
    with pytest.raises(ValueError, match="series key"):
        m.metrics_levels(df, keys, [["city"]])
