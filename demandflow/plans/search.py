"""Sequential search for parameters.

Trials are proposed from earlier ones: of points drawn near the good trials the one is taken where good trials are densest
compared with bad ones. Every round starts a few trials on few trees and grows only the better part of them, so most of
the cost goes to parameters that deserve it. Finished trials are written as they come; a search that is started
again on the same table goes on behind them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.operators.metrics import rmsle
from demandflow.operators.splits import VALIDATION, part
from demandflow.plans.models import fit_log_boosting, predict_log
from demandflow.session import new_dir, side_by_side

TRIAL = "trial int, round int, budget int, params map<string,double>, loss double"
GOOD = 0.15  # share of the trials that count as good
DRAWN = 64  # points that a proposal is chosen from
EVEN = 0.1  # weight of an even density, the same for good and bad trials: empty places favour neither
NARROWEST = 0.05  # of a parameter's range, the least width of a kernel, about


@dataclass(frozen=True)
class Span:
    """The values a parameter may have; ``log`` searches orders of magnitude."""

    low: float
    high: float
    whole: bool = False
    log: bool = False

    def value(self, share: float) -> float:
        low, high = (math.log(self.low), math.log(self.high)) if self.log else (self.low, self.high)
        at = low + min(max(share, 0.0), 1.0) * (high - low)
        found = float(math.exp(at) if self.log else at)
        return float(round(found)) if self.whole else found

    @property
    def narrowest(self) -> float:
        """The least width of a kernel, as a share: whole numbers reach their neighbours."""
        return max(NARROWEST, 1 / (self.high - self.low)) if self.whole and self.high > self.low else NARROWEST

    def share(self, value: float) -> float:
        low, high, at = (math.log(v) for v in (self.low, self.high, value)) if self.log else (self.low, self.high, value)
        return (at - low) / (high - low) if high > low else 0.5


Space = Mapping[str, Span]


@dataclass(frozen=True)
class Trial:
    """One evaluation; a trial that grows has a row per budget."""

    trial: int
    round: int
    budget: int
    params: Mapping[str, float]
    loss: float


def below(x: np.ndarray) -> np.ndarray:
    """Share of a standard normal distribution below ``x``."""
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2)))


def widths(points: np.ndarray, space: Space) -> np.ndarray:
    """Widths of the kernels around ``points``, by their spread and number."""
    count, dims = points.shape
    return np.maximum(points.std(axis=0) * count ** (-1 / (dims + 4)), [s.narrowest for s in space.values()])


def density(points: np.ndarray, at: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Density of ``points`` at the places ``at``: kernels around the points, cut off at the edges, and one over all."""
    inside = below((1 - points) / width) - below(-points / width)
    distance = (at[:, None, :] - points[None, :, :]) / width
    shapes = np.exp(-0.5 * distance**2) / (width * math.sqrt(2 * math.pi) * inside[None, :, :])
    return (1 - EVEN) * shapes.prod(axis=2).mean(axis=1) + EVEN


def standing(history: Sequence[Trial]) -> list[Trial]:
    """Every trial at its largest budget, the best first.

    Losses of smaller budgets are moved by the median change that trials saw when they went on to the next.
    """
    by_budget: dict[int, dict[int, Trial]] = {}
    for t in history:
        by_budget.setdefault(t.budget, {})[t.trial] = t
    budgets = sorted(by_budget, reverse=True)
    moved: dict[int, tuple[float, Trial]] = {}
    change = 0.0
    for i, budget in enumerate(budgets):
        if i:
            above = by_budget[budgets[i - 1]]
            change += float(np.median([t.loss - by_budget[budget][n].loss for n, t in above.items() if n in by_budget[budget]] or [0.0]))
        for n, t in by_budget[budget].items():
            moved.setdefault(n, (t.loss + change, t))
    return [t for _, t in sorted(moved.values(), key=lambda x: (x[0], x[1].trial))]


def propose(
    history: Sequence[Trial], space: Space, random: np.random.Generator, pending: Sequence[Mapping[str, float]] = ()
) -> dict[str, float]:
    """Parameters of the next trial; the draw is even until there are enough trials to tell good from bad.

    ``pending`` ones, proposed but not yet known, count as bad, so that a round does not try one place many times.
    """
    names = list(space)
    ordered = standing(history)
    if len(ordered) < 2 * len(names) + 2:
        chosen = random.random(len(names))
    else:
        points = np.array([[space[n].share(t.params[n]) for n in names] for t in ordered])
        good = max(2, math.ceil(GOOD * len(ordered)))
        bad = np.array([*points[good:].tolist(), *([space[n].share(p[n]) for n in names] for p in pending)])
        spread = widths(points[:good], space)
        drawn = points[random.integers(0, good, DRAWN)] + random.normal(size=(DRAWN, len(names))) * spread
        # What falls off an edge is reflected; a few even draws keep the rest of the space in view.
        drawn = 1 - np.abs(1 - np.abs(drawn) % 2)
        drawn = np.concatenate([drawn, random.random((DRAWN // 8, len(names)))])
        better = density(points[:good], drawn, spread) / density(bad, drawn, widths(bad, space))
        chosen = drawn[np.argmax(better)]
    return {n: space[n].value(s) for n, s in zip(names, chosen, strict=True)}


def search(
    evaluate: Callable[[Mapping[str, float], int], float],
    space: Space,
    budgets: Sequence[int],
    rounds: int,
    width: int,
    seed: int = 42,
    keep: float = 1 / 3,
    done: Sequence[Trial] = (),
    record: Callable[[Sequence[Trial]], None] = lambda trials: None,
) -> list[Trial]:
    """All trials of ``rounds`` rounds of ``width`` new ones each, in the order they ran.

    Those of a round run side by side on the first of ``budgets``; the best ``keep`` of them, one at least,
    run again on the next, and so on. ``record`` gets the trials of every step when they are finished. Trials in
    ``done``, from an earlier run with the same arguments, are not evaluated again; the proposals are the same.
    """
    known = {(t.trial, t.budget): t for t in done}
    history: list[Trial] = []
    for turn in range(rounds):
        random = np.random.default_rng([seed, turn])
        proposed: list[dict[str, float]] = []
        for _ in range(width):
            proposed.append(propose(history, space, random, proposed))
        runners = [(turn * width + k, params) for k, params in enumerate(proposed)]
        for budget in budgets:

            def run(runner: tuple[int, dict[str, float]], budget: int = budget, turn: int = turn) -> Trial:
                number, params = runner
                old = known.get((number, budget))
                return old or Trial(number, turn, budget, params, float(evaluate(params, budget)))

            step = side_by_side(run, runners)
            fresh = [t for t in step if (t.trial, t.budget) not in known]
            if fresh:
                record(fresh)
            history += step
            best = sorted(step, key=lambda t: (t.loss, t.trial))[: max(1, math.floor(keep * len(step)))]
            runners = [(t.trial, dict(t.params)) for t in best]
    return history


def best_trial(trials: Sequence[Trial]) -> Trial:
    """The best trial of the largest budget."""
    top = max(t.budget for t in trials)
    return min((t for t in trials if t.budget == top), key=lambda t: (t.loss, t.trial))


def read_trials(spark: SparkSession, path: str) -> list[Trial]:
    """The trials written below ``path``, a few rows each round."""
    rows = spark.read.schema(TRIAL).parquet(f"{path}/part=*").collect()
    return [Trial(r["trial"], r["round"], r["budget"], r["params"], r["loss"]) for r in rows]


BOOSTING_SPACE: Space = {
    "maxDepth": Span(2, 6, whole=True),
    "stepSize": Span(0.03, 0.5, log=True),
    "subsamplingRate": Span(0.5, 1.0),
}


def search_boosting(
    split: DataFrame,
    target_col: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    space: Space = BOOSTING_SPACE,
    budgets: Sequence[int] = (4, 12),
    rounds: int = 3,
    width: int = 6,
    seed: int = 42,
    path: str | None = None,
) -> DataFrame:
    """Trial, round, budget (trees), params and loss (RMSLE of the later validation rows) of every trial.

    ``split`` is read by every trial, so pass a written table. The table below ``path`` grows by every step of a round;
    the same call on a table that is there already goes on where it ended.
    """
    spark = split.sparkSession
    path = path or new_dir(spark, "trials")
    # The empty first part makes the table readable before there is a trial.
    spark.createDataFrame([], TRIAL).write.mode("overwrite").parquet(f"{path}/part=-1")
    done = read_trials(spark, path)

    def evaluate(params: Mapping[str, float], trees: int) -> float:
        typed: dict[str, Any] = {n: int(v) if space[n].whole else v for n, v in params.items()}
        model = fit_log_boosting(split, target_col, categorical, numeric, {**typed, "maxIter": trees, "seed": seed})
        return rmsle(predict_log(model, part(split, VALIDATION), [], target_col)).first()["rmsle"]

    def record(trials: Sequence[Trial]) -> None:
        rows = [(t.trial, t.round, t.budget, dict(t.params), t.loss) for t in trials]
        name = f"{trials[0].round}-{trials[0].budget}-{trials[0].trial}"
        spark.createDataFrame(rows, TRIAL).coalesce(1).write.mode("overwrite").parquet(f"{path}/part={name}")

    search(evaluate, space, budgets, rounds, width, seed, done=done, record=record)
    trials = spark.read.schema(TRIAL).parquet(f"{path}/part=*")
    return trials.orderBy(F.desc("budget"), "loss", "trial")
