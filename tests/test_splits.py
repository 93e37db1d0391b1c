from __future__ import annotations

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.operators import splits as sp


@pytest.fixture
def series(spark):
    data = [("x", day(n), float(n)) for n in range(50)] + [("y", day(n), 1.0) for n in range(12)]
    return spark.createDataFrame(data, "s string, date date, sales double")


def sizes(split):
    return {(r["s"], r["split"]): r["count"] for r in split.groupBy("s", "split").count().collect()}


def test_parts_are_disjoint_and_cover_the_input(series):
    for split in (
        sp.split_by_date(series, "2024-01-20"),
        sp.split_train_val_test(series, 10, 5),
        sp.split_last_days(series, 7),
        sp.split_fraction(series, ["s"]).drop("split_date"),
    ):
        assert rows(split.drop("split")) == rows(series)
        assert split.filter("split is null").count() == 0


def test_horizon_takes_the_last_rows_and_drops_short_series(series):
    assert sizes(sp.split_horizon(series, ["s"], 5, 10)) == {("x", "train"): 45, ("x", "test"): 5}
    assert sizes(sp.split_horizon(series, ["s"], 5, 7))[("y", "test")] == 5
    test = sp.part(sp.split_horizon(series, ["s"], 5, 10), sp.TEST)
    assert [r.date for r in test.orderBy("date").collect()] == [day(n) for n in range(45, 50)]


def test_date_split_boundary_belongs_to_training(series):
    split = sp.split_by_date(series.filter("s = 'x'"), str(day(10)))
    assert sp.part(split, sp.TRAIN).agg(F.max("date")).first()[0] == day(10)


def test_three_way_boundaries(series):
    split = sp.split_train_val_test(series.filter("s = 'x'"), 10, 5)
    bounds = {r["split"]: (r["a"], r["b"]) for r in split.groupBy("split").agg(F.min("date").alias("a"), F.max("date").alias("b")).collect()}
    assert bounds == {"train": (day(0), day(34)), "validation": (day(35), day(39)), "test": (day(40), day(49))}
    shares = {r["split"]: r["share_pct"] for r in sp.split_shares(split).collect()}
    assert shares == {"train": 70.0, "validation": 10.0, "test": 20.0}
    short = sp.short_groups(sp.split_train_val_test(series, 10, 30), ["s"], 11)
    assert rows(short) == [("x", 10), ("y", 10)]


def test_fraction_uses_each_groups_own_span(series):
    cuts = {(r.s, r.split_date) for r in sp.split_fraction(series, ["s"]).select("s", "split_date").distinct().collect()}
    assert cuts == {("x", day(39)), ("y", day(8))}


def test_min_history(series):
    assert {r.s for r in sp.with_min_history(series, ["s"], 13).collect()} == {"x"}


def test_eligibility_reasons(spark):
    def group(name, n, nulls=0, span=1):
        return [(name, day(i * span), 1.0, None if i < nulls else 1.0) for i in range(n)]

    late = [("late", day(0), 1.0, 1.0)] + [("late", day(1000 + i), 1.0, 1.0) for i in range(20)]
    df = spark.createDataFrame(
        group("few", 9) + group("nulls", 20, 15) + group("good", 20) + late, "g string, date date, sales double, f double"
    )
    got = {r.g: r for r in sp.training_eligibility(df, ["g"], ["f"], 10, 5, 3).collect()}
    assert {g: r.reason for g, r in got.items()} == {
        "few": "insufficient_data", "nulls": "too_many_nulls", "good": "eligible", "late": "insufficient_split",
    }
    assert (got["good"].train_rows, got["good"].test_rows) == (15, 5)
    assert (got["late"].train_rows, got["late"].test_rows) == (1, 20)
