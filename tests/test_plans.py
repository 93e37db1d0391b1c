"""Shapes of physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest

from demandflow import session
from demandflow.operators import clean, features
from demandflow.plans import growth
from demandflow.plans.medallion import Medallion
from demandflow.queries import load_all
from demandflow.sources.retail import Retail


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tiers(spark, folder):
    return Medallion(Retail(spark, folder))


def test_gold_fact_shuffles_once_and_broadcasts_its_dimensions(tiers):
    text = plan(tiers.gold)
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1
    assert text.count("BroadcastHashJoin") == 4 and "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_needed_columns(tiers):
    text = plan(tiers.retail.sales)
    lineitem = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_tax" not in lineitem and "l_extendedprice" not in lineitem


def test_deduplication_limits_before_the_shuffle(tiers):
    text = plan(clean.clean_sales(tiers.retail.sales_raw))
    before, after = text.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_all_series_features_share_one_shuffle(tiers):
    stored = tiers.retail.stored_sales
    keys = ["store_nbr", "family"]
    for df in (
        features.rolling_stats(stored, keys),
        features.stable_period(stored, keys),
        features.trainable_series(stored, keys, 90),
        features.densify(stored, "date", keys),
        features.build_features(stored, "date", "sales", keys, [1, 7], [7], pre_aggregate=False),
    ):
        assert plan(df).count("Exchange hashpartitioning") == 1


def test_comparable_period_reaches_the_scan(tiers):
    stored = tiers.retail.stored_sales.selectExpr("date", "store_nbr", "family", "'c' AS city", "sales AS actual_sales", "'Actual' AS data_type")
    text = plan(growth.ytd_segments(stored, growth.Period(2001, 11)))
    assert "GreaterThanOrEqual(date,2000-01-01)" in text


@pytest.mark.parametrize("name", ["split_train_val_test", "scenario_totals", "backtest_naive_predictions", "holiday_calendar", "row_policy"])
def test_no_cross_joins(spark, folder, name):
    text = plan(load_all()[name](spark, folder))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_daily_fact_is_spread_by_its_number_of_items(spark, folder, monkeypatch):
    """A task holds as many rows of the daily fact at any size of the table, and sums none up before the shuffle."""
    monkeypatch.setattr(session, "TASK_ROWS", 400)
    r = Retail(spark, folder)
    wanted = -(-r.table("lineitem").count() // 400)
    text = plan(r.sales)
    assert re.search(rf"hashpartitioning\(date#\d+, family#\d+, store_nbr#\d+L?, {wanted}\), REPARTITION_BY_NUM", text)
    assert text.count("Exchange hashpartitioning") == 1


def test_predictions_share_one_pass_over_the_recent_days(spark, folder):
    r = Retail(spark, folder)
    for df in (r.scenario_pred, r.validation_pred, r.model_pred):
        assert "Window" not in plan(df) and "recent_sales" in plan(df)
