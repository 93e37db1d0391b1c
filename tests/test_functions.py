from __future__ import annotations

from datetime import date

from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.functions import calendar as cal
from demandflow.functions.scalars import from_log1p, guarded_pct_error, normalize_flag, pct_error, ratio


def test_weekend_is_saturday_and_sunday_everywhere(spark):
    df = spark.createDataFrame([(day(n),) for n in range(7)], "date date")
    got = df.select(
        "date",
        cal.gold_calendar()["is_weekend"].alias("gold"),
        cal.season_flags()["is_weekend"].alias("season"),
        cal.iso_calendar()["is_weekend"].alias("iso"),
    )
    assert [r[1:] for r in rows(got)] == [(0, 0, 0)] * 5 + [(1, 1, 1)] * 2


def test_calendar_uses_the_named_date_column(spark):
    df = spark.createDataFrame([(date(2024, 1, 15),), (date(2024, 4, 30),), (date(2024, 2, 5),)], "d date")
    got = df.select("d", *[c.alias(n) for n, c in cal.series_calendar("d").items()])
    assert [r.is_salary_day for r in got.orderBy("d").collect()] == [1, 0, 1]
    flags = df.select(*[c.alias(n) for n, c in cal.season_flags("d").items()], "d").orderBy("d").collect()
    assert [(r.quarter, r.is_month_start, r.is_month_end) for r in flags] == [(1, 0, 0), (1, 1, 0), (2, 0, 1)]


def test_weeks_run_from_monday_to_sunday(spark):
    df = spark.createDataFrame([(day(0),), (day(6),), (day(7),)], "date date")
    got = rows(df.select("date", cal.week_start("date"), cal.week_end("date")))
    assert [(s, e) for _, s, e in got] == [(day(0), day(6))] * 2 + [(day(7), day(13))]


def test_date_spine_has_every_day_once(spark):
    df = spark.createDataFrame([(day(9),), (day(0),), (day(4),)], "date date")
    assert [r[0] for r in rows(cal.date_spine(df))] == [day(n) for n in range(10)]


def test_normalize_flag(spark):
    texts = ["True", "true", "1", "False", "false", "0", "yes", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(normalize_flag(F.col("t"))).collect()] == [1, 1, 1, 0, 0, 0, 0, 0]


def test_guards_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([(0.0, 2.0), (4.0, 2.0)], "y double, p double")
    got = df.select(
        pct_error(F.col("y"), F.col("p")), ratio(F.col("p"), F.col("y")), guarded_pct_error(F.col("y"), F.col("p"))
    ).collect()
    assert tuple(got[0])[:2] == (0.0, None) and got[0][2] < -1e11
    assert tuple(got[1])[:2] == (50.0, 0.5)
    negative = spark.createDataFrame([(-3.0,)], "v double").select(from_log1p(F.col("v"))).first()[0]
    assert negative == 0.0
