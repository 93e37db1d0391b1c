from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandflow.operators import drift as dr


def frame(spark, parts):
    rows = [(split, None if v is None else float(v)) for split, values in parts.items() for v in values]
    return spark.createDataFrame(rows, "split string, x double").repartition(3)


def plain(base, other, edges):
    """The figures of one feature from its values."""

    def bins(values):
        out = {}
        for v in values:
            b = -1 if v is None or math.isnan(v) else sum(v > e for e in edges)
            out[b] = out.get(b, 0) + 1
        return out

    a, b = bins(base), bins(other)
    share = lambda c, k: max(c.get(k, 0) / sum(c.values()), 1e-4)
    psi = sum((share(b, k) - share(a, k)) * math.log(share(b, k) / share(a, k)) for k in a.keys() | b.keys())
    below = lambda c, k: sum(n for j, n in c.items() if 0 <= j <= k) / sum(n for j, n in c.items() if j >= 0)
    return psi, max(abs(below(a, k) - below(b, k)) for k in a.keys() | b.keys() if k >= 0)


def test_equals_the_plain_figures(spark):
    rng = np.random.default_rng(1)
    base, other = [*rng.normal(0, 1, 800), None, None], [*rng.normal(0.7, 1.5, 300), *[None] * 30, math.nan]
    df = frame(spark, {"train": base, "test": other, "validation": [1e9] * 50})
    edges = {"x": [-1.0, 0.0, 1.0]}
    got = dr.split_drift(df, ["x"], edges=edges).first()
    psi, ks = plain(base, other, edges["x"])
    assert got["psi"] == pytest.approx(psi) and got["ks"] == pytest.approx(ks)
    assert got["base_null_share"] == pytest.approx(2 / 802) and got["other_null_share"] == pytest.approx(31 / 331)


def test_quantile_bins_see_a_shift_and_no_shift(spark):
    rng = np.random.default_rng(2)
    same = dr.split_drift(frame(spark, {"train": rng.normal(0, 1, 4000), "test": rng.normal(0, 1, 4000)}), ["x"]).first()
    moved = dr.split_drift(frame(spark, {"train": rng.normal(0, 1, 4000), "test": rng.normal(1, 1, 4000)}), ["x"]).first()
    assert same["psi"] < 0.02 and same["ks"] < 0.05
    assert moved["psi"] > 0.5 and moved["ks"] == pytest.approx(0.383, abs=0.05)  # of two normal distributions one apart


def test_edges_are_quantiles_of_both_parts(spark):
    df = frame(spark, {"train": range(0, 500), "test": range(500, 1000)})
    assert dr.quantile_edges(df, ["x"], 4)["x"] == pytest.approx([250, 500, 750], abs=2)
    hot = frame(spark, {"train": [7] * 900 + list(range(100)), "test": [7] * 50})
    assert dr.quantile_edges(hot, ["x"])["x"] == [7.0]


def test_several_features_in_one_pass(spark):
    df = frame(spark, {"train": range(50), "test": range(25, 90)}).withColumn("y", F.lit(1)).withColumn("z", F.lit(None).cast("double"))
    counts = dr.bin_counts(df, {"x": [30.0], "y": [1.0], "z": []}, F.col("split") == "train", F.col("split") == "test")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    got = {(r["feature"], r["bin"]): (r["base_count"], r["other_count"]) for r in counts.collect()}
    assert got == {("x", 0): (31, 6), ("x", 1): (19, 59), ("y", 0): (50, 65), ("z", -1): (50, 65)}
    out = {r["feature"]: r for r in dr.drift(counts).collect()}
    assert out["y"]["psi"] == 0 and out["y"]["ks"] == 0 and out["z"]["ks"] is None and out["z"]["base_null_share"] == 1


def test_missing_part_and_empty_table(spark):
    one = dr.split_drift(frame(spark, {"train": range(20)}), ["x"]).first()
    assert one["ks"] is None and one["other_null_share"] == 0
    assert dr.split_drift(frame(spark, {"train": range(3)}).where("false"), ["x"]).count() == 0
