"""Every registered query runs; those with reference SQL give the same rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from demandflow.queries.oracle import TABLES

# The text-corpus queries have their own tests.
QUERIES = {n: fn for n, fn in entry.queries().items() if n not in entry.LLM_QUERIES}
ORACLE = {n: sql for n, sql in entry.oracle_sql().items() if n in QUERIES}
# Fitted models: slow, and covered by test_models on small frames.
MODELS = {name for name, fn in QUERIES.items() if fn.__module__.endswith(".models")}


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_reference_statement_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == (MODELS - set(ORACLE)) | {"hash_sample", "hashed_features"}
    assert not {n for n in TABLES if n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_reference_sql(spark, folder, db, name):
    df = QUERIES[name](spark, folder)
    kinds = [(r[0], r[1]) for r in db.execute(f"DESCRIBE {ORACLE[name]}").fetchall()]
    assert check.type_difference(df.dtypes, kinds) == ""
    assert check.compare(df.toPandas(), db.execute(ORACLE[name]).df()) == "ok"


@pytest.mark.parametrize("name", ["global_forecast", "scenario_forecast", "local_forecast", "hashed_features", "hash_sample"])
def test_model_queries_run(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.count() > 0
    for column in ("prediction", "predicted_sales"):
        if column in df.columns:
            assert df.filter(f"{column} IS NULL").count() == 0


def test_entry_has_a_stable_schema(spark, folder):
    df = entry.entry(spark)
    assert df.columns[:4] == ["id", "date", "store_nbr", "family"] and df.count() > 0
