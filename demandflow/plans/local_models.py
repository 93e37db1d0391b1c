"""One small model per series, fitted in parallel by Spark.

The days of a series are gathered into one row, whose size is bounded by the length of the
calendar; a task reads many such rows as Arrow batches. Parameters travel in the closure of the function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.plans.curves import additive_forecast, holt_winters_forecast
from demandflow.session import ship_package

Forecaster = Callable[[pd.Series, int], np.ndarray]
WEEK = 7
THURSDAY = 3  # weekday of 1970-01-01
WELL_CONDITIONED = 1e-6  # smallest share of the largest eigenvalue


def seasonal_design(weekday: int, t: np.ndarray) -> np.ndarray:
    """Weekdays, trend and one yearly wave of the days ``t`` after a first day."""
    year = 2 * np.pi * t / 365.25
    return np.column_stack([np.eye(WEEK)[(weekday + t) % WEEK], t, np.sin(year), np.cos(year)])


@lru_cache(maxsize=4 * WEEK)
def seasonal_table(weekday: int, days: int) -> np.ndarray:
    return seasonal_design(weekday, np.arange(days))


def seasonal_fit(known: np.ndarray, ahead: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The least-squares fit of ``values`` on the rows of ``known``, at the rows of ``ahead``.

    By the normal equations where they are well conditioned, which takes a fraction of the time; short histories, whose
    columns depend on each other, have the solution of smallest norm.
    """
    last = ahead[-1, WEEK] if len(ahead) else known[-1, WEEK]
    scale = np.ones(known.shape[1])
    scale[WEEK] = 1.0 / max(last, 1.0)  # the trend reaches 1 on the last day
    gram = (known.T @ known) * np.outer(scale, scale)
    spread = np.linalg.eigvalsh(gram)
    if spread[0] > WELL_CONDITIONED * spread[-1]:
        coefficients = np.linalg.solve(gram, (known.T @ values) * scale)
    else:
        coefficients = np.linalg.lstsq(known * scale, values, rcond=None)[0]
    return (ahead * scale) @ coefficients


def seasonal_days(values: np.ndarray, first: int, horizon: int) -> np.ndarray:
    """``seasonal_forecast`` of a value per day from day ``first`` since 1970 on."""
    n = len(values)
    table = seasonal_table((first + THURSDAY) % WEEK, 1 << (n + horizon - 1).bit_length())
    return seasonal_fit(table[:n], table[n : n + horizon], values)


def seasonal_forecast(y: pd.Series, horizon: int) -> np.ndarray:
    """Additive model by least squares: trend, weekly pattern and one yearly wave; ``y`` is indexed by day."""
    days = y.index.append(pd.date_range(y.index[-1], periods=horizon + 1, freq=y.index.freq or "D")[1:])
    design = seasonal_design(days[0].dayofweek, (days - days[0]).days.to_numpy())
    return seasonal_fit(design[: len(y)], design[len(y) :], y.to_numpy(float))


def arima_forecast(order: tuple[int, int, int]) -> Forecaster:
    """ARIMA(p, d, q) by two least-squares passes: a long autoregression gives the shocks, then both lags are fitted."""
    p, d, q = order

    def lags(x: np.ndarray, n: int, start: int) -> np.ndarray:
        return np.column_stack([x[start - k : len(x) - k] for k in range(1, n + 1)]) if n else np.empty((len(x) - start, 0))

    def forecast(y: pd.Series, horizon: int) -> np.ndarray:
        levels = [y.to_numpy(float)]
        for _ in range(d):
            levels.append(np.diff(levels[-1]))
        x = levels[-1]
        long = min(max(p, q) + 7, len(x) // 3)
        if long <= max(p, q):
            return np.repeat(y.to_numpy(float)[-1], horizon)
        first = np.column_stack([np.ones(len(x) - long), lags(x, long, long)])
        shocks = np.concatenate([np.zeros(long), x[long:] - first @ np.linalg.lstsq(first, x[long:], rcond=None)[0]])
        second = np.column_stack([np.ones(len(x) - long), lags(x, p, long), lags(shocks, q, long)])
        beta = np.linalg.lstsq(second, x[long:], rcond=None)[0]
        past, noise = list(x), list(shocks)
        for _ in range(horizon):
            row = [1.0, *past[: -p - 1 : -1], *noise[: -q - 1 : -1]]
            past.append(float(np.dot(row, beta)))
            noise.append(0.0)
        steps = np.array(past[len(x) :])
        for level in reversed(levels[:-1]):
            steps = level[-1] + np.cumsum(steps)
        return steps

    return forecast


def forecaster_of(model_type: str, order: tuple[int, int, int]) -> Forecaster:
    """A local model by name."""
    known: dict[str, Forecaster] = {
        "seasonal_local": seasonal_forecast,
        "arima_local": arima_forecast(order),
        "additive_local": additive_forecast,
        "holt_winters": holt_winters_forecast,
    }
    if model_type not in known:
        raise ValueError(f"unknown local model {model_type!r}")
    return known[model_type]


def fit_predict_local(
    train: DataFrame,
    test: DataFrame,
    model_type: str,
    group_cols: Sequence[str],
    horizon: int = 0,
    date_col: str = "date",
    target_col: str = "sales",
    order: tuple[int, int, int] = (1, 1, 1),
    freq: str = "D",
    regressors: Sequence[str] = (),
) -> DataFrame:
    """Fit each series and pair its forecast with every test row.

    A series is put on a regular index of ``freq`` first, missing days between two
    observations being interpolated, and is forecast up to its own last test day,
    ``horizon`` periods at least. Test rows of a series without training rows have
    no prediction. ``regressors``, such as holidays, are columns of both parts that the additive model
    takes; days without a row, or without a value, have 0.
    """
    forecaster = forecaster_of(model_type, order)
    if regressors and model_type != "additive_local":
        raise ValueError(f"{model_type} takes no regressors")
    ship_package(train.sparkSession)
    keys = list(group_cols)
    names = [*keys, date_col, "prediction"]
    schema = T.StructType(
        [*[train.schema[c] for c in keys], T.StructField(date_col, T.DateType()), T.StructField("prediction", T.DoubleType())]
    )

    def one_series(days: np.ndarray, values: np.ndarray, goal: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The days of ``goal`` that the forecast reaches and its values there."""
        past = days[~goal]
        wanted = np.unique(days[goal])
        order_ = np.argsort(past, kind="stable")
        past, past_values = past[order_], values[~goal][order_]
        once = np.append(True, past[1:] != past[:-1]) if len(past) else np.empty(0, bool)
        past, past_values = past[once], past_values[once]
        known = ~np.isnan(past_values)
        if not known.any() or not len(wanted):
            return wanted[:0], np.empty(0)
        first, last, end = int(past[0]), int(past[-1]), int(days.max())
        if freq == "D":
            grid = np.arange(first, last + 1)
            y = np.interp(grid, past[known], past_values[known])  # ends keep the nearest value
            count = max(end - last, horizon)
            ahead = last + 1 + np.arange(count)
        else:
            index = pd.DatetimeIndex(past.astype("datetime64[D]"))
            regular = pd.Series(past_values, index).asfreq(freq).interpolate().ffill().bfill()
            until = pd.Timestamp(np.datetime64(end, "D"))
            future = pd.date_range(regular.index[-1], max(until, regular.index[-1]), freq=freq)[1:]
            if len(future) < horizon:
                future = pd.date_range(regular.index[-1], periods=horizon + 1, freq=freq)[1:]
            grid, ahead = (i.to_numpy().astype("datetime64[D]").astype(np.int64) for i in (regular.index, future))
            y, count = regular.to_numpy(float), len(ahead)
        reached = np.isin(wanted, ahead)
        if not reached.any():
            return wanted[:0], np.empty(0)
        if freq == "D" and forecaster is seasonal_forecast:
            predicted = seasonal_days(y, first, count)
        else:
            if freq == "D":
                index = pd.date_range(np.datetime64(first, "D"), periods=len(y), freq="D")
                regular = pd.Series(y, index)
            if regressors:
                by_day = pd.DataFrame(extra, days)
                by_day = by_day[~by_day.index.duplicated()].reindex([*grid, *ahead]).fillna(0.0).to_numpy()
                predicted = forecaster(regular, count, by_day[: len(y)], by_day[len(y) :])
            else:
                predicted = forecaster(regular, count)
        return wanted[reached], np.asarray(predicted, float)[np.searchsorted(ahead, wanted[reached])]

    def many_series(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(len(keys))
            ends = np.cumsum(pc.list_value_length(points).to_numpy(zero_copy_only=False))
            columns = points.flatten().flatten()
            days = columns[0].cast(pa.int32()).to_numpy(zero_copy_only=False).astype(np.int64)
            goal = columns[2].to_numpy(zero_copy_only=False).astype(bool)
            values, *extra = [pc.fill_null(c, np.nan).to_numpy(zero_copy_only=False) for c in (columns[1], *columns[3:])]
            extra = np.column_stack(extra) if extra else np.empty((len(days), 0))
            found = [
                one_series(days[a:b], values[a:b], goal[a:b], extra[a:b])
                for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)
            ]
            series = pa.array(np.repeat(np.arange(len(found)), [len(d) for d, _ in found]))
            at = np.concatenate([d for d, _ in found]) if found else np.empty(0)
            predictions = np.concatenate([p for _, p in found]) if found else np.empty(0)
            out = [pa.array(at.astype(np.int32), pa.int32()).cast(pa.date32()), pa.array(predictions, pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(series) for i in range(len(keys))], *out], names)

    def points_of(df: DataFrame, value: Column, goal: bool) -> DataFrame:
        more = [F.col(c).cast("double").alias(c) for c in regressors]
        day = F.col(date_col).cast("date").alias("day")
        return df.where(F.col(date_col).isNotNull()).select(
            *keys, F.struct(day, value.cast("double").alias("value"), F.lit(goal).alias("goal"), *more).alias("point")
        )

    # Only the days of the test part are forecast; its other columns stay out of the groups.
    goals = points_of(test.select(*keys, date_col, *regressors).distinct(), F.lit(None), True)
    points = points_of(train, F.col(target_col), False).unionByName(goals)
    whole = points.groupBy(*keys).agg(F.collect_list("point").alias("points"))
    forecasts = whole.mapInArrow(many_series, schema)
    actuals = test.select(*keys, date_col, test[target_col].alias("y"))
    return actuals.join(forecasts, [*keys, date_col], "left").select(*keys, date_col, "y", "prediction")
