from __future__ import annotations

import pytest
from conftest import day, rows

from demandflow import session
from demandflow.operators import quality as q
from demandflow.operators.policy import CityPolicy, apply_row_policy, publish_view
from demandflow.sources.contracts import STORES, TRANSACTIONS


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "a", day(0), 1.0), (1, "a", day(0), 2.0), (2, "b", day(1), None), (3, None, day(1), 3.0)],
        "id int, name string, date date, sales double",
    )


def test_duplicates(df):
    assert rows(q.duplicate_keys(df, ["id"])) == [(1, 2)]
    q.assert_unique(df, ["id", "sales"])
    with pytest.raises(ValueError, match=r"\(1,\)"):
        q.assert_unique(df, ["id"])


def test_orphans_ignore_null_keys(spark, df):
    parent = spark.createDataFrame([("a",)], "name string")
    assert [r.id for r in q.orphan_rows(df, parent, "name", "name").collect()] == [2]


def test_profiles(df):
    assert ("name", 4, 1) in rows(q.null_profile(df)) and ("id", 4, 0) in rows(q.null_profile(df))
    grains = {r.grain: (r.distinct_keys, r.is_unique) for r in q.grain_profile(df, {"id": ["id"], "all": ["id", "sales"]}).collect()}
    assert grains == {"id": (3, False), "all": (4, True)}


def test_functional_dependency(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "a", None), (2, "a", "x")], "k int, a string, b string")
    assert rows(q.fd_violations(df, "k", ["a", "b"])) == [(2, 2)]


def test_contract_report(spark):
    stores = spark.createDataFrame([(1, "Q", "N", "A", 1)], STORES.schema)
    visits = spark.createDataFrame([(day(0), 1, 5), (day(0), 1, 6), (None, 2, 7)], "date date, store_nbr bigint, transactions int")
    got = {r.rule: r.violations for r in q.contract_report(TRANSACTIONS, {"stores": stores, "transactions": visits}).collect()}
    assert got == {
        "key(date, store_nbr)": 1, "not_null(date)": 1, "not_null(store_nbr)": 0, "foreign(store_nbr -> stores.store_nbr)": 1,
    }


def test_schema_diff_total_and_description(df):
    got = {r.column_name: r.present_in for r in q.schema_diff(df, df.drop("sales")).collect()}
    assert got["sales"] == "left" and got["id"] == "both"
    assert q.daily_total(df, str(day(0))).first()[0] == 3.0
    stats = q.describe(df, "sales").first()
    assert (stats.min_sales, stats.avg_sales, stats.max_sales, stats.std_sales) == (1.0, 2.0, 3.0, 1.0)


@pytest.mark.parametrize(
    ("groups", "visible"),
    [
        (["admins"], {"Q", "R", None}),
        (["city_readers"], {"Q"}),
        (["other_readers"], {"R"}),
        (["city_readers", "other_readers"], {"Q", "R"}),
        ([], set()),
        (["someone"], set()),
    ],
)
def test_row_policy(spark, groups, visible):
    df = spark.createDataFrame([("Q",), ("R",), (None,)], "city string")
    policy = CityPolicy("Q")
    assert {r.city for r in apply_row_policy(df, policy, groups).collect()} == visible
    assert {r.city for r in publish_view(df, policy, groups, "seen").collect()} == visible
    policy.register(spark, groups, "may_see")
    df.createOrReplaceTempView("cities")
    assert {r.city for r in spark.sql("SELECT city FROM cities WHERE may_see(city)").collect()} == visible


def test_missing_rows_are_distinct_and_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(2, None), (3, "d")], "k int, v string")
    assert rows(q.missing_rows(left, right)) == [(1, "a"), (3, "c")]


def test_grains_of_many_keys_are_spread_and_counted_exactly(spark, monkeypatch):
    """Null keys count, tasks get a bounded number of keys, and no row is expanded once per grain."""
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    monkeypatch.setattr(q, "TASK_ROWS", 50)
    data = [(i % 400 if i % 7 else None, i % 3, "x") for i in range(1200)] * 2
    df = spark.createDataFrame(data, "a int, b int, c string").repartition(4)
    out = q.grain_profile(df, {"a": ["a"], "b": ["b"], "ab": ["a", "b"], "bc": ["c", "b"], "all": ["c", "b", "a"]})
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "REPARTITION_BY_NUM" in text
    expected = {"a": {(r[0],) for r in data}, "b": {r[1:2] for r in data}, "ab": {r[:2] for r in data}, "bc": {r[1:] for r in data}, "all": set(data)}
    assert {tuple(r) for r in out.collect()} == {(name, len(keys), 2400, False) for name, keys in expected.items()}
    nothing = q.grain_profile(df.where("a < 0"), {"a": ["a"], "ab": ["a", "b"]}).collect()
    assert sorted(tuple(r) for r in nothing) == [("a", 0, None, None), ("ab", 0, None, None)]
