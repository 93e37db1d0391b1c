"""Forecasters of one series for ``fit_predict_local``: an additive curve and exponential smoothing.

Both take a series on a regular index of days and the number of days to forecast; a group is bounded by the calendar.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd

CHANGES = 20  # places where the trend may turn, at most
APART = 14  # days between two of them, at least
SETTLED = 0.8  # share of the history that they lie in
ORDERS = (0, 1, 2, 3, 5)  # pairs of yearly waves to choose from
PRICES = (1.0, 4.0, 16.0, 64.0)  # of a turn, in residual variances, to choose from
REWEIGHTED = 8  # rounds in which small turns are shrunk away
YEAR = 365.25


@dataclass(frozen=True)
class Additive:
    """A fitted additive curve: coefficients of the ``columns`` of its design, and what was chosen."""

    coefficients: np.ndarray
    changes: np.ndarray  # days since the start
    order: int
    price: float
    span: float

    def design(self, days: pd.DatetimeIndex, start: pd.Timestamp, extra: np.ndarray | None) -> np.ndarray:
        return additive_design(days, start, self.changes, self.order, self.span, extra)

    def slopes(self) -> np.ndarray:
        """Change per day before the first turn and after each."""
        first = 7
        return np.cumsum(self.coefficients[first : first + 1 + len(self.changes)]) / self.span


def additive_design(
    days: pd.DatetimeIndex, start: pd.Timestamp, changes: np.ndarray, order: int, span: float, extra: np.ndarray | None
) -> np.ndarray:
    """Weekdays, trend, turns of the trend, yearly waves, further columns."""
    t = (days - start).days.to_numpy(float)
    weekday = np.eye(7)[days.dayofweek.to_numpy()]
    turns = np.maximum(t[:, None] - changes[None, :], 0.0) / span
    angle = 2 * np.pi * t[:, None] * np.arange(1, order + 1)[None, :] / YEAR
    parts = [weekday, t[:, None] / span, turns, np.sin(angle), np.cos(angle)]
    return np.column_stack(parts if extra is None else [*parts, extra])


def shrunk(gram: np.ndarray, right: np.ndarray, turns: slice, price: float) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients by ridge on the turns, and the inverse they come from.

    The penalty of a turn falls with its square from round to round, so that in the end every turn that is
    left costs about ``price`` and small ones are gone.
    """
    penalty = np.full(len(right), 1e-8)  # keeps a short history solvable
    weight = np.full(turns.stop - turns.start, 1e-3)
    for _ in range(REWEIGHTED if len(weight) else 1):
        penalty[turns] = price * weight
        inverse = np.linalg.pinv(gram + np.diag(penalty), hermitian=True)
        coefficients = inverse @ right
        if len(weight):
            size = coefficients[turns] ** 2
            weight = 1.0 / (size + max(1e-6 * size.max(), 1e-12))
    return coefficients, inverse


def fit_additive(y: pd.Series, extra: np.ndarray | None = None) -> Additive:
    """Least squares with a penalty on the turns alone.

    The number of yearly waves (none without a whole year) and the price of a turn are those with the smallest Bayesian
    information criterion, the trace of the smoothing matrix being the number of parameters.
    """
    n, start = len(y), y.index[0]
    span = max(float((y.index[-1] - start).days), 1.0)
    places = int(min(CHANGES, SETTLED * span // APART))
    changes = np.linspace(0, SETTLED * span, places + 2)[1:-1] if places > 0 else np.empty(0)
    turns = slice(8, 8 + len(changes))
    values = y.to_numpy(float)
    best: tuple[float, Additive] | None = None
    for order in [k for k in ORDERS if k == 0 or span >= YEAR]:
        x = additive_design(y.index, start, changes, order, span, extra)
        gram, right = x.T @ x, x.T @ values
        free = np.linalg.lstsq(x, values, rcond=None)[0]
        noise = max(float(((values - x @ free) ** 2).sum()) / max(n - x.shape[1], 1), 1e-12)
        for price in PRICES if len(changes) else (0.0,):
            coefficients, inverse = shrunk(gram, right, turns, price * noise)
            rest = float(((values - x @ coefficients) ** 2).sum())
            freedom = float(np.trace(inverse @ gram))
            score = n * np.log(max(rest / n, 1e-12)) + np.log(max(n, 2)) * freedom
            if best is None or score < best[0] - 1e-9:
                best = score, Additive(coefficients, changes, order, price, span)
    assert best is not None
    return best[1]


def additive_forecast(
    y: pd.Series, horizon: int, known: np.ndarray | None = None, ahead: np.ndarray | None = None
) -> np.ndarray:
    """The additive curve of ``y`` carried on for ``horizon`` days with its last slope.

    ``known`` and ``ahead`` are further columns, such as holidays, for the days of ``y`` and those to come.
    """
    model = fit_additive(y, known)
    days = pd.date_range(y.index[-1], periods=horizon + 1, freq=y.index.freq or "D")[1:]
    return model.design(days, y.index[0], ahead) @ model.coefficients


# --- exponential smoothing --------------------------------------------------------------------------

SEASON = 7
GRID = {
    "level": (0.05, 0.1, 0.2, 0.35, 0.5, 0.8),
    "trend": (0.0, 0.02, 0.1, 0.3),
    "season": (0.0, 0.05, 0.15, 0.4),
    "damping": (0.8, 0.9, 0.97, 1.0),
}
REFINEMENTS = 3  # rounds of finer steps around the best of the grid


@dataclass
class Smoothed:
    """Level, trend and season (of the last days) at the end of a series, and the squared errors on the way.

    Every entry belongs to one set of parameters: many sets run through the series together.
    """

    level: np.ndarray
    trend: np.ndarray
    season: np.ndarray
    errors: np.ndarray


def smooth(values: np.ndarray, params: np.ndarray, season: int = SEASON) -> Smoothed:
    """The recursion of level, damped trend and additive season over ``values``, for each row of ``params``.

    It starts from the means of the first two seasons; with fewer days than that there is no season and no trend at the start.
    """
    a, b, g, damping = params.T
    whole = len(values) >= 2 * season
    first = values[:season].mean() if whole else values[0]
    level = np.full(len(params), first)
    trend = np.full(len(params), (values[season : 2 * season].mean() - first) / season if whole else 0.0)
    waves = np.tile(values[:season] - first if whole else np.zeros(season), (len(params), 1))
    errors = np.zeros(len(params))
    for i, value in enumerate(values):
        wave = waves[:, i % season]
        ahead = level + damping * trend
        errors += (value - ahead - wave) ** 2
        new = a * (value - wave) + (1 - a) * ahead
        trend = b * (new - level) + (1 - b) * damping * trend
        if whole:
            waves[:, i % season] = g * (value - new) + (1 - g) * wave
        level = new
    # The wave of the first day to come first.
    return Smoothed(level, trend, np.roll(waves, -(len(values) % season), axis=1), errors)


def best_smoothing(values: np.ndarray, season: int = SEASON) -> np.ndarray:
    """The parameters (level, trend, season, damping) with the smallest one-day errors, each within the bounds of ``GRID``."""
    sets = np.array(list(product(*GRID.values())))
    low, high = sets.min(axis=0), sets.max(axis=0)
    best = sets[smooth(values, sets, season).errors.argmin()]
    width = (high - low) / 4
    for _ in range(REFINEMENTS):
        width = width / 2
        steps = np.array(list(product((0, -1, 1), repeat=4)))  # the best so far first, so that it wins ties
        around = np.clip(best + steps * width, low, high)
        best = around[smooth(values, around, season).errors.argmin()]
    return best


def holt_winters_forecast(y: pd.Series, horizon: int) -> np.ndarray:
    """Level, damped trend and weekly season of ``y`` carried on for ``horizon`` days."""
    values = y.to_numpy(float)
    params = best_smoothing(values)
    end = smooth(values, params[None, :])
    damped = np.cumsum(params[3] ** np.arange(1, horizon + 1))
    return end.level[0] + damped * end.trend[0] + end.season[0][np.arange(horizon) % SEASON]
