from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.plans import gold_forecast as gf
from demandflow.plans import growth
from demandflow.plans.models import scenario_features
from demandflow.sources.contracts import FORECAST_FACT

RUN, LATER = "2024-03-01 00:00:00", "2024-04-01 00:00:00"


@pytest.fixture
def sales(spark):
    data = [(day(n), "F", 1, float(n)) for n in range(3)]
    return spark.createDataFrame(data, "date date, family string, store_nbr int, sales double")


@pytest.fixture
def predictions(spark):
    def one(d, name, version, value, hour):
        return (day(d), "F", 1, name, version, "t", "global", 3, value, datetime(2024, 2, 1, hour), "test")

    return spark.createDataFrame(
        [one(1, "a", "v1", 2.0, 1), one(1, "a", "v2", 3.0, 2), one(1, "b", "v1", 0.0, 1), one(5, "a", "v1", 9.0, 1),
         one(2, "a", "v1", 1.0, 5), one(2, "a", "v2", 2.5, 5)],
        "date date, family string, store_nbr bigint, model_name string, model_version string, model_type string, "
        "model_strategy string, best_iteration int, prediction double, prediction_timestamp timestamp_ntz, split string",
    )


@pytest.fixture
def fact(sales, predictions):
    return gf.sales_forecast_fact(sales, predictions, RUN)


def test_fact_has_the_full_schema_for_every_record_type(fact):
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FORECAST_FACT]
    counts = {r.record_type: r["count"] for r in fact.groupBy("record_type").count().collect()}
    assert counts == {"actual": 3, "backtest": 5, "forecast": 6}
    assert {r.split for r in fact.select("record_type", "split").filter("record_type = 'actual'").collect()} == {"train"}
    assert fact.filter("record_type = 'forecast' AND sales IS NOT NULL").count() == 0
    summary = rows(gf.record_type_summary(fact))
    assert ("actual", None, 3, day(0), day(2)) in summary


def test_forecast_records_of_named_models(predictions):
    assert gf.forecast_records(predictions, RUN, ["b"]).count() == 1


def test_latest_forecast_prefers_time_then_version(fact):
    got = {(r.date, r.model_name): (r.model_version, r.forecast) for r in gf.latest_forecasts(fact).collect()}
    assert got == {
        (day(1), "a"): ("v2", 3.0), (day(1), "b"): ("v1", 0.0), (day(5), "a"): ("v1", 9.0), (day(2), "a"): ("v2", 2.5),
    }


def test_combined_view_and_future(fact):
    view = gf.combined_view(fact)
    assert {r.data_type: r["count"] for r in view.groupBy("data_type").count().collect()} == {"actual": 3, "forecast": 4}
    assert rows(gf.future_forecasts(fact, str(day(2)), 1)) == [(day(2), "F", 1, 2.5, "a", "v2")]


def test_accuracy_ignores_zero_sales_in_mape(fact, sales):
    acc = {(r.model_name, r.model_version): r for r in gf.forecast_accuracy(fact).collect()}
    assert acc["a", "v1"].num_predictions == 2 and acc["a", "v1"].mae == 1.0
    assert acc["b", "v1"].mape == 1.0
    zero = gf.sales_forecast_fact(sales.withColumn("sales", F.lit(0.0)), gf_predictions(fact), RUN)
    assert {r.mape for r in gf.forecast_accuracy(zero).collect()} == {None}
    rollup = {(r.model_name): r.total_predictions for r in gf.accuracy_rollup(gf.forecast_accuracy(fact)).collect()}
    assert rollup == {"a": 4, "b": 1}


def gf_predictions(fact):
    return fact.filter("record_type = 'forecast'").withColumnRenamed("forecast", "prediction").drop("sales")


def test_drilldown(fact):
    got = gf.family_drilldown(fact, "F", 1, 2).collect()
    assert [(r.date, r.model_version) for r in got] == [(day(2), "v1"), (day(2), "v2")]
    assert got[0].pct_error == 50.0


def test_refresh_touches_one_model_and_is_idempotent(fact, predictions):
    latest = gf.latest_forecasts(fact)
    new = predictions.filter("model_name = 'a' AND model_version = 'v1'").withColumns(
        {"prediction": F.lit(7.0), "model_version": F.lit("v9"), "date": F.date_add("date", 1)}
    )
    once = gf.refresh_forecasts(latest, new, "a", LATER)
    got = {(r.date, r.model_name): (r.forecast, r.model_version, r.created_at) for r in once.collect()}
    assert got[day(2), "a"][:2] == (7.0, "v9") and got[day(2), "a"][2] == datetime(2024, 3, 1)
    assert got[day(6), "a"] == (7.0, "v9", datetime(2024, 4, 1))
    assert got[day(1), "b"][0] == 0.0 and got[day(1), "a"][0] == 3.0
    assert rows(gf.refresh_forecasts(once, new, "a", LATER)) == rows(once)


# --- growth --------------------------------------------------------------------------------------


@pytest.fixture
def stack(spark):
    data = [
        (date(2022, 12, 31), 1, "F", "Q", 99.0, "Actual"),
        (date(2023, 1, 10), 1, "F", "Q", 10.0, "Actual"),
        (date(2023, 1, 10), 2, "F", "Q", 30.0, "Actual"),
        (date(2023, 4, 1), 1, "F", "Q", 50.0, "Actual"),
        (date(2024, 2, 1), 1, "F", "Q", 15.0, "Actual"),
        (date(2024, 3, 1), 1, "F", "Q", 5.0, "Forecast - current"),
        (date(2024, 3, 1), 1, "F", "Q", 9.0, "Forecast - onpromotion_2x"),
        (date(2024, 3, 2), 2, "F", "Q", 60.0, "Forecast - current"),
        (date(2024, 3, 2), 2, "F", "Q", 70.0, "Forecast - onpromotion_2x"),
        (date(2024, 3, 3), 1, "F", "Q", 1000.0, "Validation"),
    ]
    return spark.createDataFrame(data, "date date, store_nbr int, family string, city string, actual_sales double, data_type string")


def test_growth_compares_the_same_months_per_scenario(stack):
    period = growth.Period.of(stack)
    assert period == growth.Period(2024, 3)
    totals = growth.scenario_totals(growth.ytd_segments(stack, period))
    assert ("2x_promos", 24.0) in {(r.scenario, r.total_sales) for r in totals.collect()}
    by_mean = {r.scenario: r for r in growth.growth_by(totals, "city", period).collect()}
    assert by_mean["1x_promos"]["2023"] == 20.0 and by_mean["1x_promos"]["2024"] == 40.0
    assert by_mean["1x_promos"].ytd_growth == pytest.approx(100.0)
    by_sum = {r.scenario: r for r in growth.growth_by(totals, "family", period, agg="sum").collect()}
    assert by_sum["2x_promos"]["2024"] == 94.0
    delta = growth.growth_delta(growth.growth_by(totals, "family", period)).first()
    assert delta["diff"] == pytest.approx(delta["2x_promos"] - delta["1x_promos"]) and delta["diff"] > 0


def test_growth_without_a_year_before_is_null(stack):
    period = growth.Period(2024, 3)
    totals = growth.scenario_totals(growth.ytd_segments(stack.filter("date >= '2024-01-01'"), period))
    assert {r.ytd_growth for r in growth.growth_by(totals, "city", period).collect()} == {None}


def test_weekly_resample_fills_empty_weeks(spark):
    df = spark.createDataFrame(
        [("a", day(0), 1.0), ("a", day(6), 2.0), ("a", day(21), 4.0), ("b", day(8), 5.0)], "g string, date date, sales double"
    )
    assert rows(growth.weekly_resample(df, ["g"])) == [
        ("a", day(6), 3.0), ("a", day(13), 0.0), ("a", day(20), 0.0), ("a", day(27), 4.0), ("b", day(13), 5.0),
    ]


def test_year_pivot_and_bounds(stack):
    wide = growth.family_year_pivot(stack.withColumnRenamed("actual_sales", "sales"), [2022, 2023, 2024]).first()
    assert (wide["2022"], wide["2023"]) == (99.0, 90.0)
    assert growth.rows_per_year(stack).first()[0] == 2024
    assert ("Validation", date(2024, 3, 3), date(2024, 3, 3)) in rows(growth.data_type_bounds(stack))


def test_scenario_features_keep_rows_and_types(spark):
    df = spark.createDataFrame([(1, 3, 0.5)], "id int, onpromotion int, lag double")
    got = scenario_features(df, "onpromotion", {"current": 1, "onpromotion_2x": 2})
    assert got.schema["onpromotion"].dataType == df.schema["onpromotion"].dataType
    assert rows(got) == [(1, 3, 0.5, "current"), (1, 6, 0.5, "onpromotion_2x")]
