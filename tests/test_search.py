from __future__ import annotations

import itertools
import math
import threading

import numpy as np
import pytest
from conftest import day
from pyspark.sql import functions as F

from demandflow.operators import splits as sp
from demandflow.plans import search as se
from demandflow.session import materialize, new_dir

SPACE = {"a": se.Span(0.0, 10.0), "b": se.Span(0.001, 10.0, log=True), "c": se.Span(1, 9, whole=True)}
BUDGETS = (1, 3, 9)


def planted(params, budget):
    """Best at a = 7.3, b = 0.02, c = 4; few trees blur it."""
    far = ((params["a"] - 7.3) / 10) ** 2 + (math.log10(params["b"] / 0.02) / 4) ** 2 + ((params["c"] - 4) / 8) ** 2
    return far + 0.02 / budget * (1 + math.sin(50 * params["a"]))


def test_beats_a_grid_of_equal_cost():
    ours, grids = [], []
    for seed in range(8):
        trials = se.search(planted, SPACE, BUDGETS, rounds=8, width=9, seed=seed)
        ours.append(planted(se.best_trial(trials).params, 9))
        points = int(sum(t.budget for t in trials) / 9)
        side = max(2, round(points ** (1 / 3)))
        shares = (np.arange(side) + 0.5) / side
        grid = itertools.product(shares, repeat=3)
        grids.append(min(planted({n: s.value(x) for (n, s), x in zip(SPACE.items(), p, strict=True)}, 9) for p in grid))
    # 0.029 against 0.056 in the median of these seeds.
    assert np.median(ours) < 0.6 * np.median(grids)
    assert sum(a < b for a, b in zip(ours, grids, strict=True)) >= 6


def test_later_rounds_are_better_than_the_first():
    trials = se.search(planted, SPACE, BUDGETS, rounds=8, width=9, seed=1)
    first = np.median([planted(t.params, 9) for t in trials if t.round == 0 and t.budget == 1])
    last = np.median([planted(t.params, 9) for t in trials if t.round >= 6 and t.budget == 1])
    assert last < first / 2


def test_only_the_better_part_grows():
    trials = se.search(planted, SPACE, BUDGETS, rounds=2, width=9, seed=3)
    for turn in range(2):
        of = {b: [t for t in trials if t.round == turn and t.budget == b] for b in BUDGETS}
        assert [len(of[b]) for b in BUDGETS] == [9, 3, 1]
        assert {t.trial for t in of[3]} == {t.trial for t in sorted(of[1], key=lambda t: t.loss)[:3]}


def test_seeded_and_resumed():
    whole = se.search(planted, SPACE, BUDGETS, rounds=4, width=6, seed=5)
    assert whole == se.search(planted, SPACE, BUDGETS, rounds=4, width=6, seed=5)
    assert whole != se.search(planted, SPACE, BUDGETS, rounds=4, width=6, seed=6)
    calls, lock, kept = [], threading.Lock(), []

    def counted(params, budget):
        with lock:
            calls.append(budget)
        return planted(params, budget)

    again = se.search(counted, SPACE, BUDGETS, rounds=4, width=6, seed=5, done=whole[:13], record=kept.extend)
    assert again == whole and len(calls) == len(whole) - 13 == len(kept)


def test_values_stay_in_their_span():
    rng = np.random.default_rng(0)
    history = [se.Trial(i, 0, 1, {"a": 10.0, "b": 10.0, "c": 9.0}, float(i)) for i in range(20)]
    for _ in range(50):
        p = se.propose(history, SPACE, rng)
        assert 0 <= p["a"] <= 10 and 0.001 <= p["b"] <= 10.000001 and p["c"] == int(p["c"]) and 1 <= p["c"] <= 9
    assert se.Span(2, 2, whole=True).share(2) == 0.5


def test_trial_table_grows_and_is_taken_up_again(spark):
    series = spark.range(240).select(
        F.date_add(F.lit(day(0)), (F.col("id") / 2).cast("int")).alias("date"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("family"),
        (F.col("id") % 14).cast("double").alias("x"),
        (5 + 3 * (F.col("id") % 14) + F.col("id") % 5).cast("double").alias("sales"),
    )
    split = materialize(sp.split_last_days(series, 28), "split")
    path = new_dir(spark, "trials")
    how = {"budgets": (1, 2), "width": 3, "space": {"maxDepth": se.Span(1, 4, whole=True)}}
    one = se.search_boosting(split, "sales", ["family"], ["x"], rounds=1, path=path, **how).collect()
    assert [r["budget"] for r in one] == [2, 1, 1, 1] and all(r["loss"] > 0 for r in one)
    two = se.search_boosting(split, "sales", ["family"], ["x"], rounds=2, path=path, **how).collect()
    assert len(two) == 8 and {tuple(sorted(r["params"].items())) for r in one} <= {tuple(sorted(r["params"].items())) for r in two}
    assert {(r["trial"], r["budget"]): r["loss"] for r in one}.items() <= {(r["trial"], r["budget"]): r["loss"] for r in two}.items()
    with pytest.raises(ValueError, match="max"):
        se.best_trial([])
