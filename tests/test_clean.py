from __future__ import annotations

from conftest import day, rows
from pyspark.sql import functions as F

from demandflow.operators.clean import (
    clean_future,
    clean_sales,
    clean_stores,
    fill_gaps,
    holiday_calendar,
    holiday_wide,
    keep_first,
    reconcile,
)

SALES = "id bigint, date date, store_nbr bigint, family string, sales double, onpromotion int"
PRICES = "date date, price double"
HOLIDAYS = "date date, type string, locale string, locale_name string, description string, transferred boolean"
STORES = "store_nbr bigint, city string, state string, type string, cluster int"


def test_clean_sales_drops_missing_and_keeps_the_smallest_duplicate(spark):
    df = spark.createDataFrame(
        [
            (1, day(1), 1, "A", 5.0, 0),
            (1, day(0), 2, "B", 7.0, 1),
            (2, day(0), 1, None, 5.0, 0),
            (3, day(0), 1, "A", None, 0),
            (None, day(0), 1, "A", 1.0, 0),
            (4, day(2), 1, "A", 0.0, 0),
        ],
        SALES,
    )
    assert rows(clean_sales(df)) == [(1, day(0), 2, "B", 7.0, 1), (4, day(2), 1, "A", 0.0, 0)]
    assert [r[0] for r in rows(clean_future(df.drop("sales")))] == [1, 3, 4]
    assert rows(reconcile(df, clean_sales(df))) == [("after", 2, 7.0), ("before", 6, 18.0)]


def test_keep_first_does_not_depend_on_partitioning(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 5003).alias("v"))
    expected = rows(keep_first(df, ["k"]))
    assert expected == rows(keep_first(df.repartition(13), ["k"])) == rows(keep_first(df.coalesce(1), ["k"]))
    assert len(expected) == 3


def test_clean_stores(spark):
    df = spark.createDataFrame([(1, "b", "S", "A", 1), (1, "a", "S", "A", 1), (None, "c", "S", "A", 1)], STORES)
    assert rows(clean_stores(df)) == [(1, "a", "S", "A", 1)]


def test_fill_gaps_forward_then_backward(spark):
    df = spark.createDataFrame(
        [(day(0), None), (day(2), 10.0), (day(3), None), (day(5), 12.0), (day(7), None)], PRICES
    )
    got = [r[1] for r in rows(fill_gaps(df, "date", "price"))]
    assert got == [10.0, 10.0, 10.0, 10.0, 10.0, 12.0, 12.0, 12.0]


def test_fill_gaps_per_series_and_beyond_the_end(spark):
    df = spark.createDataFrame(
        [("x", day(0), 1.0), ("x", day(2), 3.0), ("y", day(1), None), ("y", day(2), 5.0), ("z", day(1), None)],
        "s string, date date, price double",
    )
    assert rows(fill_gaps(df, "date", "price", ["s"])) == [
        ("x", day(0), 1.0), ("x", day(1), 1.0), ("x", day(2), 3.0), ("y", day(1), 5.0), ("y", day(2), 5.0),
    ]
    until = spark.createDataFrame([(day(4),)], "d date")
    longer = rows(fill_gaps(df.filter("s = 'x'"), "date", "price", ["s"], until=until))
    assert longer[-2:] == [("x", day(3), 3.0), ("x", day(4), 3.0)]


def test_holiday_calendar(spark):
    stores = spark.createDataFrame(
        [(1, "Q", "North", "A", 1), (2, "G", "South", "A", 1), (3, "H", "South", "B", 1)], STORES
    )
    holidays = spark.createDataFrame(
        [
            (day(0), "Holiday", "National", "ALL", None, False),
            (day(0), "Holiday", "Regional", "South", None, False),
            (day(2), "Holiday", "National", "ALL", None, True),
            (day(3), "Holiday", "Regional", "South", None, False),
            (day(4), "Holiday", "Local", "Q", None, False),
            (day(5), "Holiday", "National", "ALL", None, None),
        ],
        HOLIDAYS,
    )
    calendar = holiday_calendar(holidays, stores, "ALL")
    got = rows(calendar)
    assert len(got) == 6 * 2
    assert {(d, s) for d, s, flag in got if flag == 1} == {(day(0), "North"), (day(0), "South"), (day(3), "South")}
    by_city = rows(holiday_calendar(holidays, stores, "ALL", match_city=True))
    assert (day(4), "North", 1) in by_city
    spine = spark.createDataFrame([(day(-2),), (day(8),)], "date date")
    assert len(rows(holiday_calendar(holidays, stores, "ALL", spine=spine))) == 11 * 2
    assert rows(holiday_wide(calendar, ["North", "South"]))[3] == (day(3), 0, 1)


def test_gaps_are_filled_when_a_date_is_delivered_twice(spark):
    data = [(day(0), None), (day(1), 5.0), (day(1), 6.0), (day(1), 5.0), (day(3), 7.0), (day(3), 7.0)]
    df = spark.createDataFrame(data, "date date, v double")
    assert [r[1] for r in rows(fill_gaps(df, "date", "v"))] == [6.0, 6.0, 6.0, 7.0]
