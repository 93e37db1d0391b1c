from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from demandflow.plans import grouped_models as gm
from demandflow.session import materialize

NUMERIC = ["x", "z", "year"]


@pytest.fixture(scope="module")
def data(spark):
    """Three families of different slopes; one column hardly varies against its size, one is constant in a family."""
    n = F.col("id")
    frame = spark.range(900).select(
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit(None)), (n % 3 + 1).cast("int")).alias("family"),
        "id",
        (F.pmod(F.hash("id"), F.lit(1000)) / 100).alias("x"),
        F.when(n % 3 == 1, 5.0).otherwise(F.pmod(F.hash(n + 7), F.lit(50)).cast("double")).alias("z"),
        (2000 + F.pmod(n, F.lit(7))).alias("year"),
        F.element_at(F.array(F.lit("N"), F.lit("S")), (n % 2 + 1).cast("int")).alias("state"),
    )
    noise = F.pmod(F.hash(F.col("id") * 31), F.lit(100)) / 25
    sales = (n % 3 + 1) * F.col("x") - 0.5 * F.col("z") + 3 * (F.col("year") - 2000) + noise + F.when(F.col("state") == "S", 4).otherwise(0)
    return materialize(frame.withColumn("sales", sales.cast("double")), "grouped")


def plain(rows, features, reg_param):
    named = rows.select("sales", *[c.alias(f"f{i}") for i, c in enumerate(features.values())])
    assembled = VectorAssembler(inputCols=named.columns[1:], outputCol="features").transform(named)
    model = LinearRegression(featuresCol="features", labelCol="sales", regParam=reg_param, solver="normal").fit(assembled)
    return [*model.coefficients, model.intercept]


@pytest.mark.parametrize("reg_param", [0.0, 0.1, 5.0])
def test_all_families_equal_a_fit_each(data, reg_param):
    features = gm.features_of(NUMERIC, {"state": ["S"]})
    models, scored = gm.train_together(data, data, ("global", "by_family"), "sales", features, ["id"], reg_param)
    got = {(r.model_strategy, r.model_name): [*r.coefficients, r.intercept] for r in models.collect()}
    assert len(got) == 4
    for (strategy, name), found in got.items():
        rows = data if strategy == "global" else data.where(F.col("family").eqNullSafe(F.lit(name)))
        want = plain(rows, features, reg_param)
        np.testing.assert_allclose(found, want, rtol=1e-6, atol=1e-6 * max(1, abs(want[-1])))
    assert scored.count() == 1800 and scored.where("prediction IS NULL").count() == 0


def test_jobs_do_not_grow_with_the_families(spark, data):
    features = gm.features_of(NUMERIC)
    jobs = []
    for families in (2, 60):
        rows = materialize(data.withColumn("family", (F.col("id") % families).cast("string")), "families")
        group = f"families-{families}"
        spark.sparkContext.setJobGroup(group, group)
        models, scored = gm.train_together(rows, rows, ("by_family",), "sales", features, ["id"], 0.1)
        assert models.count() == families and scored.count() == 900
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[0] == jobs[1]


def test_one_exchange_for_all_models(data):
    sums = gm.moments(gm.with_models(data, ("global", "by_family")), ["model_strategy", "model_name"], gm.features_of(NUMERIC), "sales")
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_sums_of_days_add_up(data):
    features = gm.features_of(NUMERIC)
    centre = gm.centres(data, features, "sales")
    daily = gm.moments(data.withColumn("day", F.col("id") % 5), ["family", "day"], features, "sales", centre)
    whole = gm.moments(data, ["family"], features, "sales", centre)
    merged = gm.added(daily, ["family"], len(features))
    by = ["family"]
    a, b = ({r.family: [*r.coefficients, r.intercept] for r in gm.solved(s, by, features, "sales", centre, 0.1).collect()} for s in (whole, merged))
    assert a.keys() == b.keys()
    for family, found in a.items():
        np.testing.assert_allclose(found, b[family], rtol=1e-9)


def test_rows_that_lack_something(spark):
    rows = [("a", 1, 1.0, 3.0), ("a", 2, 2.0, 5.0), ("a", 3, None, 9.0), ("a", 4, 4.0, None), ("a", 5, float("nan"), 1.0), ("b", 6, 1.0, 7.0), ("c", 7, 1.0, None)]
    df = spark.createDataFrame(rows, "family string, id int, x double, sales double")
    features = gm.features_of(["x"])
    models, scored = gm.train_together(df, df, ("by_family",), "sales", features, ["id"])
    got = {r.id: r.prediction for r in scored.collect()}
    assert got[1] == pytest.approx(3.0) and got[4] == pytest.approx(9.0) and got[3] is None and np.isnan(got[5])
    assert got[6] == pytest.approx(7.0) and got[7] is None
    few, _ = gm.train_together(df, df, ("by_family",), "sales", features, ["id"], min_rows=2)
    assert [r.model_name for r in few.collect()] == ["a"]
    none, _ = gm.train_together(df.where("false"), df, ("global",), "sales", features, ["id"])
    assert none.count() == 0


def test_groups_of_families(spark, data):
    groups = spark.createDataFrame([("A", "low"), ("B", "low")], "family string, family_group string")
    features = gm.features_of(NUMERIC)
    models, scored = gm.train_together(data, data, gm.STRATEGIES, "sales", features, ["id"], 0.1, family_groups=groups)
    sizes = {(r.model_strategy, r.model_name): r.n for r in models.collect()}
    assert sizes == {("global", "global"): 900, ("by_family", "A"): 300, ("by_family", "B"): 300, ("by_family", None): 300, ("by_family_group", "low"): 600}
    assert scored.count() == 900 + 900 + 600
    with pytest.raises(ValueError, match="unknown strategy"):
        gm.with_models(data, ("per_store",))
    with pytest.raises(ValueError, match="family groups"):
        gm.with_models(data, gm.STRATEGIES)
