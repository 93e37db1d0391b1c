"""Global, per-group and scenario models on pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.functions.scalars import from_log1p
from demandflow.operators.metrics import regression_metrics, rmsle
from demandflow.operators.splits import TRAIN, VALIDATION, part
from demandflow.session import dimension_join, materialize, new_dir, side_by_side
from demandflow.sources.files import write_partitioned

# Fixed names of the model types.
ESTIMATORS: dict[str, type[Estimator]] = {
    "spark_gbt": GBTRegressor,
    "spark_rf": RandomForestRegressor,
    "glm": LinearRegression,
}
LOCAL_MODELS = ("seasonal_local", "arima_local")
CURVE_MODELS = ("additive_local", "holt_winters")
UNUSABLE_CODE = "keep"  # unseen categories get their own index


def make_estimator(kind: str, params: Mapping[str, Any] | None = None) -> Estimator:
    """A regressor by name."""
    if kind not in ESTIMATORS:
        raise ValueError(f"unknown model type {kind!r}; known: {sorted(ESTIMATORS)} and local {[*LOCAL_MODELS, *CURVE_MODELS]}")
    return ESTIMATORS[kind](featuresCol="features", labelCol="label", **(params or {}))


def make_pipeline(categorical: Sequence[str], numeric: Sequence[str], estimator: Estimator) -> Pipeline:
    """Alphabetical index and one-hot of the categories, assembled with the numbers, then the regressor."""
    stages: list[Estimator | VectorAssembler] = []
    if categorical:
        index = [f"{c}_index" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=list(categorical),
                outputCols=index,
                handleInvalid=UNUSABLE_CODE,
                stringOrderType="alphabetAsc",
            )
        )
        stages.append(OneHotEncoder(inputCols=index, outputCols=[f"{c}_onehot" for c in categorical]))
    inputs = [*numeric, *[f"{c}_onehot" for c in categorical]]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    return Pipeline(stages=[*stages, estimator])


def fit_global(
    train: DataFrame,
    target_col: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    estimator: Estimator,
    label: Column | None = None,
    keep: Sequence[str] = (),
) -> PipelineModel:
    """One model over all series. Only the columns it needs take part."""
    target = F.col(target_col).cast("double") if label is None else label
    rows = train.select(*categorical, *numeric, *keep, target.alias("label"))
    return make_pipeline(categorical, numeric, estimator).fit(rows)


def predict_global(
    model: PipelineModel, rows: DataFrame, keys: Sequence[str], target_col: str | None = None
) -> DataFrame:
    """Keys, actual ``y`` where known, and prediction; a row that lacks a number has no prediction."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    complete = reduce(and_, [F.col(c).isNotNull() for c in assembler.getInputCols() if c in rows.columns], F.lit(True))
    # Missing numbers become 0 for the assembler, which refuses them, and their predictions are dropped.
    filled = {c: F.coalesce(c, F.lit(0).cast(rows.schema[c].dataType)) for c in assembler.getInputCols() if c in rows.columns}
    kept = {f"_kept_{c}": F.col(c) for c in [*keys, *([target_col] if target_col else [])]}
    scored = model.transform(rows.withColumns({**kept, "_complete": complete}).withColumns(filled))
    columns = [F.col(f"_kept_{c}").alias(c) for c in keys] + ([F.col(f"_kept_{target_col}").alias("y")] if target_col else [])
    return scored.select(*columns, F.when(F.col("_complete"), F.col("prediction")).alias("prediction"))


def log_target(target_col: str) -> Column:
    return F.log1p(F.greatest(F.col(target_col).cast("double"), F.lit(0.0)))


def fit_log_boosting(
    split: DataFrame,
    target_col: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    params: Mapping[str, Any] | None = None,
) -> PipelineModel:
    """Boosted trees on the log target that stop adding trees when the validation rows no longer gain."""
    estimator = GBTRegressor(
        featuresCol="features",
        labelCol="label",
        validationIndicatorCol="is_validation",
        **{"seed": 42, **(params or {})},
    )
    rows = split.filter(F.col("split").isin(TRAIN, VALIDATION)).withColumn("is_validation", F.col("split") == VALIDATION)
    return fit_global(
        rows, target_col, categorical, numeric, estimator, label=log_target(target_col), keep=["is_validation"]
    )


def predict_log(model: PipelineModel, rows: DataFrame, keys: Sequence[str], target_col: str | None = None) -> DataFrame:
    """Predictions back on the original scale, never negative."""
    return predict_global(model, rows, keys, target_col).withColumn("prediction", from_log1p(F.col("prediction")))


def reload_difference(model: PipelineModel, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Save and reload a fitted pipeline; mean absolute difference of its predictions (must be 0)."""
    path = new_dir(rows.sparkSession, "pipeline")
    model.write().save(path)
    twice = PipelineModel.load(path)
    features = [c for c in rows.columns if c not in keys]
    scored = model.transform(rows.select(*keys, *features)).select(*rows.columns, F.col("prediction").alias("_kept"))
    both = twice.transform(scored)
    return both.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(F.abs(F.col("prediction") - F.col("_kept"))).alias("mean_abs_difference"),
    )


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Importance per assembled feature, one-hot slots summed to their column, largest first."""
    tree = model.stages[-1]
    attributes = model.transform(rows.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    weights = tree.featureImportances
    spark = rows.sparkSession
    names = [
        (a["name"].split("_onehot_")[0], float(weights[int(a["idx"])])) for kind in attributes.values() for a in kind
    ]
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    slots = spark.createDataFrame(names, schema)
    return slots.groupBy("feature").agg(F.sum("importance").alias("importance")).orderBy(F.desc("importance"), "feature")


# --- several models ------------------------------------------------------------------------------


def by_group(df: DataFrame, col: str) -> Iterable[tuple[str | None, DataFrame]]:
    """Each value of a column with its rows, read from a table partitioned by that column.

    The frame is computed once; each model then reads its own partition only.
    Values come over one at a time. Null and the empty string are groups of
    their own: a folder name can hold neither, so the folders carry a mark.
    """
    spark = df.sparkSession
    path = new_dir(spark, f"by_{col}")
    folder = F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))
    write_partitioned(df.withColumn("_group", folder), path, by=["_group"])
    table = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_group", T.StringType())])).parquet(path)
    for row in table.select("_group").distinct().orderBy("_group").toLocalIterator():
        name = row["_group"][1:] if row["_group"] != "null" else None
        yield name, table.filter(F.col("_group") == row["_group"]).drop("_group")


def train_by_strategy(
    split: DataFrame,
    strategy: str,
    fit_and_score: Callable[[DataFrame], DataFrame],
    family_groups: DataFrame | None = None,
) -> DataFrame:
    """Predictions of one global model, one model per family or one per family group.

    ``fit_and_score`` takes the split rows of one model and returns predictions.
    ``family_groups`` holds (family, family_group).
    """
    if strategy == "global":
        models: Iterable[tuple[str, DataFrame]] = [("global", split)]
    elif strategy == "by_family":
        models = by_group(split, "family")
    elif strategy == "by_family_group":
        if family_groups is None:
            raise ValueError("by_family_group needs the family groups")
        grouped = dimension_join(split, family_groups.select("family", "family_group"), "family", "inner")
        models = ((name, rows.drop("family_group")) for name, rows in by_group(grouped, "family_group"))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    # Each model's predictions are written as it finishes, so the result is one table however many models there are.
    path = new_dir(split.sparkSession, "model_predictions")

    def scored(numbered: tuple[int, tuple[str | None, DataFrame]]) -> T.StructType:
        i, (name, rows) = numbered
        named = {"model_name": F.lit(name).cast("string"), "model_strategy": F.lit(strategy)}
        out = fit_and_score(rows).withColumns(named)
        out.write.parquet(f"{path}/model={i}")
        return out.schema

    schemas = side_by_side(scored, enumerate(models))
    if not schemas:
        raise ValueError("there are no rows to train on")
    return split.sparkSession.read.schema(schemas[0]).parquet(f"{path}/model=*")


def grid(**options: Sequence[Any]) -> list[dict[str, Any]]:
    """All combinations of the given options."""
    return [dict(zip(options, values, strict=True)) for values in product(*options.values())]


def tune(
    split: DataFrame,
    trials: Sequence[Mapping[str, Any]],
    target_col: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
) -> DataFrame:
    """RMSLE of each parameter set on the later validation rows, best first.

    ``split`` is read by every trial, so pass a written table.
    """

    def scored(trial: tuple[int, Mapping[str, Any]]) -> DataFrame:
        number, params = trial
        model = fit_log_boosting(split, target_col, categorical, numeric, params)
        return rmsle(predict_log(model, part(split, VALIDATION), [], target_col)).select(
            F.lit(number).alias("trial"),
            F.lit(", ".join(f"{k}={v}" for k, v in params.items())).alias("params"),
            "rmsle",
        )

    return reduce(DataFrame.unionByName, side_by_side(scored, enumerate(trials))).orderBy("rmsle", "trial")


def fit_tuned(
    split: DataFrame,
    trials: Sequence[Mapping[str, Any]],
    target_col: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
) -> PipelineModel:
    """The model of the best parameter set."""
    best = tune(split, trials, target_col, categorical, numeric).first()
    return fit_log_boosting(split, target_col, categorical, numeric, trials[best["trial"]])


def compare_models(predictions: DataFrame) -> DataFrame:
    """Error figures per model and split from the stacked predictions."""
    return regression_metrics(predictions, [c for c in ("model_name", "split") if c in predictions.columns])


# --- what-if scenarios ---------------------------------------------------------------------------


def scenario_features(rows: DataFrame, feature: str, multipliers: Mapping[str, float]) -> DataFrame:
    """Every row once per scenario with one feature scaled; all scenarios are then scored in one go."""
    plans = F.array(
        *[
            F.struct(F.lit(name).alias("scenario"), (F.col(feature) * factor).cast(rows.schema[feature].dataType).alias(feature))
            for name, factor in multipliers.items()
        ]
    )
    others = [c for c in rows.columns if c != feature]
    return rows.select(*others, F.inline(plans)).select(*rows.columns, "scenario")


@dataclass(frozen=True)
class ForecastRun:
    """The frames of one end-to-end run."""

    features: DataFrame
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    metrics_by_series: DataFrame
    metrics_portfolio: DataFrame
    backtest: DataFrame | None
