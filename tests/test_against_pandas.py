"""Series operators against pandas on many random series with gaps, one-row series and zero sales."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import day

from demandflow.operators.clean import fill_gaps
from demandflow.operators.features import active_period, densify, stable_period
from demandflow.plans.growth import weekly_resample

SERIES = 40


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    data = []
    for s in range(SERIES):
        days = sorted(rng.choice(90, size=rng.integers(1, 60), replace=False))
        data += [(f"s{s}", day(int(d)), float(rng.integers(0, 4)) * float(rng.integers(0, 2))) for d in days]
    df = spark.createDataFrame(data, "s string, date date, sales double")
    pdf = df.toPandas().assign(date=lambda p: pd.to_datetime(p["date"])).sort_values(["s", "date"])
    return df, pdf


def ours(df, *columns):
    pdf = df.select("s", "date", *columns).toPandas().assign(date=lambda p: pd.to_datetime(p["date"]))
    return pdf.sort_values(["s", "date"], ignore_index=True)


def per_series(pdf, fn):
    parts = [fn(g.set_index("date")["sales"]).rename("sales").rename_axis("date").reset_index().assign(s=s) for s, g in pdf.groupby("s")]
    return pd.concat(parts)[["s", "date", "sales"]].sort_values(["s", "date"], ignore_index=True)


def same(left, right):
    pd.testing.assert_frame_equal(left, right, check_dtype=False, check_index_type=False)


def test_densify(panel):
    df, pdf = panel
    same(ours(densify(df, "date", ["s"], {"sales": 0.0}), "sales"), per_series(pdf, lambda y: y.asfreq("D", fill_value=0.0)))


def test_fill_gaps(spark, panel):
    _, pdf = panel
    holes = pdf.assign(sales=pdf["sales"].where(pdf["sales"] > 0))
    rows = [(r.s, r.date.date(), None if np.isnan(r.sales) else r.sales) for r in holes.itertuples()]
    df = spark.createDataFrame(rows, "s string, date date, sales double")
    expected = per_series(holes, lambda y: y.asfreq("D").ffill().bfill()).dropna(ignore_index=True)
    same(ours(fill_gaps(df, "date", "sales", ["s"]), "sales"), expected)


def test_weekly_resample(panel):
    df, pdf = panel
    same(ours(weekly_resample(df, ["s"]), "sales"), per_series(pdf, lambda y: y.resample("W").sum()))


def test_active_and_stable_periods(panel):
    df, pdf = panel

    def active(y):
        return y[y.index >= y[y > 0].index.min()] if (y > 0).any() else y[:0]

    def stable(y):
        dense = (y > 0).rolling(10, min_periods=1).sum() >= 4
        return y[y.index >= dense[dense].index.min()] if dense.any() else y[:0]

    same(ours(active_period(df, ["s"]), "sales"), per_series(pdf, active))
    same(ours(stable_period(df, ["s"], span=10, needed=4), "sales"), per_series(pdf, stable))
