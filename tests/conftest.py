from __future__ import annotations

import os
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not available")
    return SMALL


def day(n: int) -> date:
    """Day ``n`` of a calendar that starts on a Monday."""
    return date(2024, 1, 1) + timedelta(days=n)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(type(v)), v) for v in t))
