from __future__ import annotations

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.plans import backtest as bt
from demandflow.plans.baselines import seasonal_naive


@pytest.fixture
def series(spark):
    data = [("x", day(n), float(n * 3 % 17)) for n in range(60)] + [("y", day(2 * n), float(n)) for n in range(30)]
    return spark.createDataFrame(data, "s string, date date, sales double")


@pytest.mark.parametrize(("folds", "horizon", "step"), [(4, 14, 14), (3, 10, 4), (2, 3, 9)])
def test_folds_against_brute_force(series, folds, horizon, step):
    expected_cut, expected_test = set(), set()
    for s, pdf in series.toPandas().sort_values("date").groupby("s"):
        days, n = list(pdf["date"]), len(pdf)
        for k in range(folds):
            cut = n - (horizon + k * step)
            if cut < 1:
                continue
            expected_cut.add((s, k, cut, horizon, days[cut - 1]))
        for k in range(folds):
            cut = n - (horizon + k * step)
            expected_test |= {(s, d, k, i + 1) for i, d in enumerate(days[max(cut, 0) : cut + horizon]) if cut >= 0}
    assert set(rows(bt.backtest_folds(series, ["s"], folds, horizon, step))) == expected_cut
    tested = bt.with_test_folds(series, ["s"], folds, horizon, step)
    got = [(r.s, r.date, r.fold, r.step_ahead) for r in tested.collect()]
    inside = {t for t in got if (t[0], t[2]) in {(c[0], c[1]) for c in expected_cut}}
    assert len(got) == len(set(got)) and inside == {t for t in expected_test if (t[0], t[2]) in {(c[0], c[1]) for c in expected_cut}}


def test_naive_predictions_only_use_rows_up_to_the_cutoff(series):
    before = bt.naive_backtest(series, ["s"], 3, 14, 7)
    for fold in range(3):
        cutoff = bt.backtest_folds(series, ["s"], 3, 14, 7).filter((F.col("fold") == fold) & (F.col("s") == "x")).first()
        shifted = series.withColumn(
            "sales", F.when(F.col("date") > cutoff.cutoff_date, F.col("sales") + 1000).otherwise(F.col("sales"))
        )
        mine = (F.col("fold") == fold) & (F.col("s") == "x")
        after = bt.naive_backtest(shifted, ["s"], 3, 14, 7)
        assert rows(before.filter(mine).select("date", "prediction")) == rows(after.filter(mine).select("date", "prediction"))
    assert before.filter("s = 'x' AND fold = 0").count() == 14


def test_train_rows_end_at_the_cutoff(series):
    train = bt.train_rows(series, ["s"], 1, 14, 7)
    folds = {r.s: r for r in bt.backtest_folds(series, ["s"], 2, 14, 7).filter("fold = 1").collect()}
    got = {r.s: (r.n, r.d) for r in train.groupBy("s").agg(F.count("*").alias("n"), F.max("date").alias("d")).collect()}
    assert got == {s: (f.train_rows, f.cutoff_date) for s, f in folds.items()}


def test_metrics_per_fold(series):
    metrics = bt.backtest_metrics(bt.naive_backtest(series, ["s"], 2, 14, 14), ["s"])
    assert [r.fold for r in metrics.orderBy("fold").collect()] == [0, 1]


def test_baselines(series):
    got = seasonal_naive(series, ["s"], (1, 7), (3,)).filter("s = 'y'")
    assert {r.model_name: r["count"] for r in got.groupBy("model_name").count().collect()} == {"naive_1": 29, "naive_7": 23, "ma_3": 29}
    assert rows(got.filter("model_name = 'naive_7'").select("date", "prediction"))[0] == (day(14), 0.0)
