"""Settings of a forecast run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class DataConfig:
    date_col: str = "date"
    target_col: str = "sales"
    group_cols: tuple[str, ...] = ("family", "store_nbr")
    min_train_periods: int = 56


@dataclass(frozen=True)
class AggregationConfig:
    target_agg: str = "sum"
    extra_aggs: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FeatureConfig:
    lags: tuple[int, ...] = (1, 7, 14, 28)
    spans: tuple[int, ...] = (7, 28)
    time_signals: bool = True


@dataclass(frozen=True)
class SplitConfig:
    mode: str = "horizon"
    train_end_date: str = ""
    test_horizon: int = 28


@dataclass(frozen=True)
class ModelConfig:
    type: str = "spark_gbt"
    params: Mapping[str, Any] = field(default_factory=lambda: {"maxDepth": 7, "maxIter": 100})


@dataclass(frozen=True)
class BacktestConfig:
    enabled: bool = True
    folds: int = 4
    fold_horizon: int = 14
    step: int = 14


@dataclass(frozen=True)
class EvaluationConfig:
    mase_seasonality: int = 7
    backtest: BacktestConfig = field(default_factory=BacktestConfig)


@dataclass(frozen=True)
class ForecastConfig:
    data: DataConfig = field(default_factory=DataConfig)
    aggregation: AggregationConfig = field(default_factory=AggregationConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    split: SplitConfig = field(default_factory=SplitConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    evaluation: EvaluationConfig = field(default_factory=EvaluationConfig)
