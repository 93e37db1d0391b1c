from __future__ import annotations

import pytest
from conftest import day, rows

from demandflow.operators.clean import fill_gaps
from demandflow.session import new_dir
from demandflow.sources.contracts import PRICE_FEED
from demandflow.sources.files import write_json_lines
from demandflow.streaming import prices


@pytest.fixture
def feed(spark):
    paths = prices.FeedPaths.below(new_dir(spark, "feed"))

    def land(*data):
        write_json_lines(spark.createDataFrame([(day(d), p) for d, p in data], PRICE_FEED).coalesce(1), paths.landing)

    return paths, land


def test_two_hops_resume_without_duplicates(spark, feed):
    paths, land = feed
    land((0, 50.0), (1, 51.0))
    assert rows(prices.run_feed(spark, paths)) == [(day(0), 50.0), (day(1), 51.0)]
    assert prices.run_feed(spark, paths).count() == 2
    land((2, 52.0))
    assert rows(prices.run_feed(spark, paths)) == [(day(0), 50.0), (day(1), 51.0), (day(2), 52.0)]
    assert spark.read.parquet(paths.bronze).count() == 3


def test_merge_takes_new_dates_once_and_late_ones_too(spark, feed):
    paths, land = feed
    known = spark.createDataFrame([(day(1), 40.0)], "date date, dcoilwtico double")
    land((1, 51.0), (3, 53.0))
    land((3, 53.0))
    prices.ingest(spark, paths)
    first = prices.stream_into_prices(spark, paths, known)
    assert rows(first) == [(day(1), 40.0), (day(3), 53.0)]
    land((0, 49.0), (3, 99.0))
    prices.ingest(spark, paths)
    second = prices.stream_into_prices(spark, paths, known)
    assert rows(second) == [(day(0), 49.0), (day(1), 40.0), (day(3), 53.0)]
    assert rows(prices.stream_into_prices(spark, paths, known)) == rows(second)
    # Gap filling after the merge covers the streamed dates as well.
    assert [r[1] for r in rows(fill_gaps(second, "date", "dcoilwtico"))] == [49.0, 40.0, 40.0, 53.0]


def test_a_lost_checkpoint_neither_loses_nor_repeats_prices(spark, feed):
    from dataclasses import replace

    paths, land = feed
    known = spark.createDataFrame([(day(1), 40.0)], "date date, dcoilwtico double")
    land((0, 49.0), (2, 52.0))
    prices.ingest(spark, paths)
    prices.stream_into_prices(spark, paths, known)
    land((5, 55.0))
    fresh = replace(paths, progress=f"{paths.progress}-fresh", bronze=f"{paths.bronze}-fresh")
    prices.ingest(spark, fresh)
    expected = [(day(0), 49.0), (day(1), 40.0), (day(2), 52.0), (day(5), 55.0)]
    assert rows(prices.stream_into_prices(spark, fresh, known)) == expected
