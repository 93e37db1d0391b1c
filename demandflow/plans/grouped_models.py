"""Linear models of all groups at once, from sums that add up.

One aggregation holds all that a least-squares fit needs of a group: its number of rows and the sums of the features, of
their products with each other and with the target. So the models of any number of families, and of
several strategies, cost one shuffle of a row per group and task, a hot family is no heavier than others, and the
sums of new days can be added to stored ones without reading the old days again. Every group is then solved by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import add, and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.session import dimension_join, materialize, ship_package, sized

Features = dict[str, Column]


def features_of(numeric: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None) -> Features:
    """Numbers as they are, and a 0/1 column per listed level of a category; other levels are 0 everywhere."""
    columns = {c: F.col(c).cast("double") for c in numeric}
    for c, values in (levels or {}).items():
        columns |= {f"{c}={v}": F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for v in values}
    return columns


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def _usable(columns: Sequence[Column]) -> Column:
    return reduce(and_, [c.isNotNull() & ~F.isnan(c) for c in columns], F.lit(True))


def centres(rows: DataFrame, features: Features, target: str) -> dict[str, float]:
    """The means over all rows, rounded: sums of what is left after subtracting them do not cancel."""
    every = {**features, target: F.col(target).cast("double")}
    found = rows.where(_usable(list(every.values()))).agg(*[F.avg(c).alias(n) for n, c in every.items()]).first()
    return {n: round(found[i] or 0.0, 3) for i, n in enumerate(every)}


def moments(
    rows: DataFrame, by: Sequence[str], features: Features, target: str, centre: Mapping[str, float] | None = None
) -> DataFrame:
    """Per group n and the sums y, yy, x, xy and xx (upper half), of values less their ``centre``.

    Rows that lack the target or a feature do not count.
    """
    centre = centre or {}
    x = [c - centre.get(n, 0.0) for n, c in features.items()]
    y = F.col(target).cast("double") - centre.get(target, 0.0)
    named = rows.where(_usable([*x, y])).select(*by, y.alias("_y"), *[c.alias(f"_x{i}") for i, c in enumerate(x)])
    xs = [F.col(f"_x{i}") for i in range(len(x))]
    sums = {"y": F.col("_y"), "yy": F.col("_y") * F.col("_y")}
    sums |= {f"x{i}": c for i, c in enumerate(xs)} | {f"xy{i}": c * F.col("_y") for i, c in enumerate(xs)}
    sums |= {f"xx{i}_{j}": xs[i] * xs[j] for i, j in _pairs(len(x))}
    flat = named.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    return flat.select(
        *by,
        "n",
        F.col("_y").alias("y"),
        F.col("_yy").alias("yy"),
        F.array(*[F.col(f"_x{i}") for i in range(len(x))]).cast("array<double>").alias("x"),
        F.array(*[F.col(f"_xy{i}") for i in range(len(x))]).cast("array<double>").alias("xy"),
        F.array(*[F.col(f"_xx{i}_{j}") for i, j in _pairs(len(x))]).cast("array<double>").alias("xx"),
    )


def added(sums: DataFrame, by: Sequence[str], p: int) -> DataFrame:
    """``moments`` of coarser groups, or of stored and new days together, without the rows; all have the same centres."""

    def total(name: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(F.col(name), F.lit(i))) for i in range(size)]).cast("array<double>").alias(name)

    whole = [F.sum(c).alias(c) for c in ("n", "y", "yy")]
    return sums.groupBy(*by).agg(*whole, total("x", p), total("xy", p), total("xx", p * (p + 1) // 2))


def ridge(n: int, y: float, yy: float, x: np.ndarray, xy: np.ndarray, xx: np.ndarray, reg_param: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept (for centred values) that ``LinearRegression`` with this ``regParam`` has.

    The penalty is on standardised coefficients. Constant features get 0; features that
    determine each other share the effect.
    """
    p = len(x)
    mean, mean_y = x / n, y / n
    products = np.zeros((p, p))
    products[np.triu_indices(p)] = xx / n
    covariance = products + np.triu(products, 1).T - np.outer(mean, mean)
    # What rounding leaves of a constant's variance is none.
    own = np.diag(products)
    variance = np.where(np.diag(covariance) > 1e-12 * np.maximum(own, 1e-300), np.diag(covariance), 0.0)
    scale_y = np.sqrt(max(yy / n - mean_y**2, 0.0))
    used = np.flatnonzero(variance)
    coefficients = np.zeros(p)
    if len(used) and scale_y > 1e-9 * max(1.0, abs(mean_y)):
        scale = np.sqrt(variance[used])
        matrix = covariance[np.ix_(used, used)] / np.outer(scale, scale) + reg_param / scale_y * np.eye(len(used))
        right = (xy / n - mean * mean_y)[used] / (scale * scale_y)
        solved = np.linalg.lstsq(matrix, right, rcond=1e-12)[0]
        coefficients[used] = solved * scale_y / scale
    return coefficients, float(mean_y - mean @ coefficients)


def solved(
    sums: DataFrame,
    by: Sequence[str],
    features: Features,
    target: str,
    centre: Mapping[str, float] | None = None,
    reg_param: float = 0.0,
    min_rows: int = 1,
) -> DataFrame:
    """``by``, n, intercept and coefficients of every group with ``min_rows`` usable rows, from its ``moments``."""
    ship_package(sums.sparkSession)
    middle = np.array([(centre or {}).get(n, 0.0) for n in features])
    middle_y = (centre or {}).get(target, 0.0)
    kinds = [*[sums.schema[c] for c in by], T.StructField("n", T.LongType()), T.StructField("intercept", T.DoubleType())]
    schema = T.StructType([*kinds, T.StructField("coefficients", T.ArrayType(T.DoubleType()))])

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for r in part.itertuples():
                arrays = [np.asarray(a, dtype=float) for a in (r.x, r.xy, r.xx)]
                b, intercept = ridge(r.n, r.y, r.yy, *arrays, reg_param)
                found.append((intercept + middle_y - float(middle @ b), b.tolist()))
            out = part[[*by, "n"]].copy()
            out["intercept"] = [a for a, _ in found]
            out["coefficients"] = [b for _, b in found]
            yield out

    return sums.where(F.col("n") >= min_rows).mapInPandas(solve, schema)


def predicted(
    rows: DataFrame, models: DataFrame, by: Sequence[str], features: Features, keys: Sequence[str], target: str | None = None
) -> DataFrame:
    """Keys, actual ``y`` where known and prediction of the row's own group.

    Rows of a group without a model, and rows that lack a feature, have no prediction.
    """
    renamed = models.select(*[F.col(c).alias(f"_of_{c}") for c in by], "intercept", "coefficients")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by], F.lit(True))
    terms = [F.get(F.col("coefficients"), F.lit(i)) * c for i, c in enumerate(features.values())]
    value = reduce(add, terms, F.col("intercept"))
    columns = [*keys, *([F.col(target).alias("y")] if target else [])]
    return rows.join(sized(renamed), same, "left").select(*columns, value.alias("prediction"))


# --- strategies -------------------------------------------------------------------------------------

STRATEGIES = ("global", "by_family", "by_family_group")  # fixed names


def with_models(rows: DataFrame, strategies: Sequence[str], family_groups: DataFrame | None = None) -> DataFrame:
    """Every row once per strategy, with model_strategy and model_name, the model it belongs to.

    Families without a group are in no model of ``by_family_group``.
    """
    unknown = set(strategies) - set(STRATEGIES)
    if unknown:
        raise ValueError(f"unknown strategy {sorted(unknown)}")
    names = {"global": F.lit("global"), "by_family": F.col("family").cast("string"), "by_family_group": F.col("_group")}
    if "by_family_group" in strategies:
        if family_groups is None:
            raise ValueError("by_family_group needs the family groups")
        rows = dimension_join(rows, family_groups.select("family", F.col("family_group").alias("_group")), "family")
    else:
        rows = rows.withColumn("_group", F.lit(None).cast("string"))
    each = F.inline(F.array(*[F.struct(F.lit(s).alias("model_strategy"), names[s].alias("model_name")) for s in strategies]))
    spread = rows.select("*", each)
    return spread.where("model_strategy <> 'by_family_group' OR model_name IS NOT NULL").drop("_group")


def train_together(
    train: DataFrame,
    test: DataFrame,
    strategies: Sequence[str],
    target: str,
    features: Features,
    keys: Sequence[str],
    reg_param: float = 0.0,
    min_rows: int = 1,
    family_groups: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The models of all strategies and their predictions for ``test``, however many families there are.

    A fixed number of jobs: the means, the sums of all models, the solutions. ``train`` is read twice.
    """
    by = ["model_strategy", "model_name"]
    centre = centres(train, features, target)
    sums = moments(with_models(train, strategies, family_groups), by, features, target, centre)
    models = materialize(solved(sums, by, features, target, centre, reg_param, min_rows), "grouped_models")
    rows = with_models(test, strategies, family_groups)
    return models, predicted(rows, models, by, features, [*keys, *by], target)
