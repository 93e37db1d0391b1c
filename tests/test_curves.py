from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import day

from demandflow.plans import curves
from demandflow.plans.local_models import fit_predict_local, seasonal_forecast

WEEK = np.array([0.0, 1, 2, 3, 8, 9, 4])


def series(values):
    return pd.Series(np.asarray(values, float), pd.date_range("2024-01-01", periods=len(values), freq="D"))


def broken(n, breaks, slopes, noise=0.5, seed=1):
    t = np.arange(n)
    trend = slopes[0] * t
    for place, before, after in zip(breaks, slopes, slopes[1:], strict=False):
        trend = trend + (after - before) * np.maximum(t - place, 0)
    return trend + WEEK[t % 7] + np.random.default_rng(seed).normal(0, noise, n)


@pytest.mark.parametrize(("breaks", "slopes"), [([200], [0.1, -0.3]), ([100, 250], [0.0, 0.5, 0.05]), ([150], [-0.2, 0.4])])
def test_turns_of_the_trend_are_found(breaks, slopes):
    y = series(broken(430, breaks, slopes))
    known, ahead = y[:400], y[400:]
    model = curves.fit_additive(known)
    assert model.slopes()[0] == pytest.approx(slopes[0], abs=0.1)
    assert model.slopes()[-1] == pytest.approx(slopes[-1], abs=0.06)
    error = np.abs(curves.additive_forecast(known, 30) - ahead).mean()
    assert error < 2.5 and error < 0.5 * np.abs(seasonal_forecast(known, 30) - ahead).mean()


def test_yearly_waves_are_chosen_when_they_are_there():
    t = np.arange(1200)
    noise = np.random.default_rng(2).normal(0, 0.3, 1200)
    flat, wavy = series(WEEK[t % 7] + noise), series(WEEK[t % 7] + noise + 6 * np.sin(2 * np.pi * t / 365.25) + 3 * np.cos(4 * np.pi * t / 365.25))
    assert curves.fit_additive(flat).order == 0 and curves.fit_additive(wavy).order >= 2
    assert curves.fit_additive(wavy[:200]).order == 0  # less than a year


def test_further_columns_are_used():
    t = np.arange(200)
    holiday = (t % 17 == 0).astype(float)
    y = series(WEEK[t % 7] + 50 * holiday)
    got = curves.additive_forecast(y[:160], 40, holiday[:160, None], holiday[160:, None])
    np.testing.assert_allclose(got, y[160:], atol=0.5)


@pytest.mark.parametrize("n", [1, 2, 5, 8, 13, 14, 20])
def test_short_series(n):
    y = series(np.arange(n) + 3.0)
    for fn in (curves.additive_forecast, curves.holt_winters_forecast):
        got = fn(y, 5)
        assert got.shape == (5,) and np.isfinite(got).all()


def recursion(values, a, b, g, damping, season=7):
    """The textbook recursion for one set of parameters."""
    whole = len(values) >= 2 * season
    level = sum(values[:season]) / season if whole else values[0]
    trend = (sum(values[season : 2 * season]) / season - level) / season if whole else 0.0
    waves = [v - level for v in values[:season]] if whole else [0.0] * season
    errors = 0.0
    for i, v in enumerate(values):
        s = waves[i % season]
        errors += (v - (level + damping * trend + s)) ** 2
        old = level
        level = a * (v - s) + (1 - a) * (old + damping * trend)
        trend = b * (level - old) + (1 - b) * damping * trend
        if whole:
            waves[i % season] = g * (v - level) + (1 - g) * s
    ahead = []
    for h in range(1, 15):
        ahead.append(level + sum(damping**k for k in range(1, h + 1)) * trend + waves[(len(values) + h - 1) % season])
    return errors, ahead


@pytest.mark.parametrize("n", [6, 14, 30, 101])
def test_smoothing_equals_the_plain_recursion(n, monkeypatch):
    values = broken(n, [40], [0.1, 0.4], seed=n)
    sets = np.random.default_rng(n).random((20, 4))
    got = curves.smooth(values, sets)
    for k, p in enumerate(sets):
        errors, ahead = recursion(list(values), *p)
        assert got.errors[k] == pytest.approx(errors)
        monkeypatch.setattr(curves, "best_smoothing", lambda v, p=p: p)
        np.testing.assert_allclose(curves.holt_winters_forecast(series(values), 14), ahead)


def test_search_is_no_worse_than_its_grid_and_stays_within():
    values = broken(200, [60, 120], [0.2, -0.1, 0.3], noise=2.0)
    best = curves.best_smoothing(values)
    grid = np.array([[a, b, g, d] for a in curves.GRID["level"] for b in curves.GRID["trend"] for g in curves.GRID["season"] for d in curves.GRID["damping"]])
    assert curves.smooth(values, best[None, :]).errors[0] <= curves.smooth(values, grid).errors.min()
    assert (best >= grid.min(axis=0)).all() and (best <= grid.max(axis=0)).all()


def test_smoothing_follows_level_and_week():
    y = series(np.tile(WEEK, 20) + 100)
    np.testing.assert_allclose(curves.holt_winters_forecast(y, 14), np.tile(WEEK, 2) + 100, atol=1e-6)


def test_by_name_over_many_series(spark):
    data = [(s, day(i), float(k * 10 + WEEK[i % 7] + 20 * (i % 17 == 0)), int(i % 17 == 0)) for k, s in enumerate("ab") for i in range(150)]
    data += [("c", day(140), 1.0, 0)]
    df = spark.createDataFrame(data, "s string, date date, sales double, holiday int")
    train, test = df.where(f"date < '{day(120)}'"), df.where(f"date >= '{day(120)}'")
    got = {(r.s, r.date): (r.y, r.prediction) for r in fit_predict_local(train, test, "additive_local", ["s"], regressors=["holiday"]).collect()}
    assert len(got) == 61 and got["c", day(140)][1] is None
    assert max(abs(y - p) for (s, _), (y, p) in got.items() if s != "c") < 1.0
    smoothed = fit_predict_local(train, test, "holt_winters", ["s"])
    assert smoothed.count() == 61 and smoothed.where("prediction IS NULL").count() == 1
    with pytest.raises(ValueError, match="takes no regressors"):
        fit_predict_local(train, test, "holt_winters", ["s"], regressors=["holiday"])
