"""Clusters of forecast errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.operators.metrics import most_frequent
from demandflow.session import side_by_side

# Fixed values.
CLUSTER_FEATURES = (
    "error", "abs_error", "pct_error", "y", "prediction", "day_of_week", "month", "is_weekend", "family_code",
)
SEED = 42


def scaled_features(errors: DataFrame, features: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """The features with mean 0 and deviation 1 in one vector; missing values count as 0."""
    steps = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        ]
    )
    filled = errors.fillna(0, subset=list(features))
    return steps.fit(filled).transform(filled).drop("_raw")


def fit_clusters(scaled: DataFrame, k: int) -> KMeansModel:
    return KMeans(k=k, seed=SEED, featuresCol="features", predictionCol="cluster").fit(scaled)


def elbow_curve(scaled: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Within-cluster sum of squares for each number of clusters."""
    costs = side_by_side(lambda k: (k, float(fit_clusters(scaled, k).summary.trainingCost)), ks)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("inertia", T.DoubleType())])
    return scaled.sparkSession.createDataFrame(costs, schema)


def assign_clusters(scaled: DataFrame, k: int = 2) -> DataFrame:
    """Each row with its cluster."""
    return fit_clusters(scaled, k).transform(scaled).drop("features")


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size, error statistics and most frequent family of each cluster."""
    stats = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.avg("error"), 2).alias("error_mean"),
        F.round(F.stddev_samp("error"), 2).alias("error_std"),
        F.round(F.min("error"), 2).alias("error_min"),
        F.round(F.max("error"), 2).alias("error_max"),
        F.round(F.avg("abs_error"), 2).alias("abs_error_mean"),
        F.round(F.stddev_samp("abs_error"), 2).alias("abs_error_std"),
        F.round(F.avg("pct_error"), 2).alias("pct_error_mean"),
        F.round(F.stddev_samp("pct_error"), 2).alias("pct_error_std"),
        F.round(F.avg("y"), 2).alias("y_mean"),
        F.round(F.avg("prediction"), 2).alias("prediction_mean"),
    )
    return stats.join(most_frequent(clustered, "cluster", "family"), "cluster")
