"""Regression metrics in one aggregate, plus what is derived from metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import absolute_residual, as_double, residual
from .order_stats import exact_quantiles

# Fixed value: the smallest denominator of a relative error, 2^-52.
EPSILON = 2.220446049250313e-16

METRICS = ("rmse", "mae", "r2", "mape")


def metric_columns(actual: str, predicted: str, prefix: str = "") -> list[Column]:
    """rmse, mae, r2 and mape (percent) as aggregates."""
    e, y = residual(actual, predicted), as_double(actual)
    y = F.when(e.isNotNull(), y)
    squares = F.sum(e * e)
    spread = F.var_pop(y) * F.count(y)
    r2 = F.when(spread > 0, 1 - F.try_divide(squares, spread)).when(squares == 0, 1.0).when(squares > 0, 0.0)
    return [
        F.sqrt(F.avg(e * e)).alias(f"{prefix}rmse"),
        F.avg(F.abs(e)).alias(f"{prefix}mae"),
        r2.alias(f"{prefix}r2"),
        (F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPSILON))) * 100).alias(f"{prefix}mape"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str, prefix: str = "", by: Sequence[str] = ()) -> DataFrame:
    """One row of metrics, or one per group."""
    columns = metric_columns(actual, predicted, prefix)
    return df.groupBy(*by).agg(*columns) if by else df.agg(*columns)


def extended_metrics(df: DataFrame, actual: str, predicted: str, prefix: str = "") -> DataFrame:
    """The metrics plus the largest and the median absolute error."""
    error = absolute_residual(actual, predicted)
    median = exact_quantiles(df, [0.5], exprs={"error": error})["error"][0]
    return df.agg(*metric_columns(actual, predicted, prefix), F.max(error).alias(f"{prefix}max_error")).withColumn(
        f"{prefix}median_error", F.lit(median).cast("double")
    )


def as_dict(row_frame: DataFrame) -> dict[str, float]:
    """A one-row frame of metrics as a dict of plain floats."""
    row = row_frame.first()
    return {k: (None if v is None else float(v)) for k, v in row.asDict().items()}


def overfit_flag(train_rmse: Column, test_rmse: Column) -> Column:
    """True where the training error is more than one unit below the test error."""
    return (train_rmse - test_rmse) < -1.0


def cv_summary(fold_scores: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """cv_mean, cv_std (population), cv_min, cv_max of the fold scores."""
    s = F.col(score)
    columns = [
        F.avg(s).alias("cv_mean"),
        F.stddev_pop(s).alias("cv_std"),
        F.min(s).alias("cv_min"),
        F.max(s).alias("cv_max"),
    ]
    return fold_scores.groupBy(*by).agg(*columns) if by else fold_scores.agg(*columns)


COMPARISON = [f"{part}_{m}" for part in ("train", "test") for m in METRICS] + ["cv_rmse_mean", "cv_rmse_std"]


def comparison_table(long_metrics: DataFrame, columns: Sequence[str] = tuple(COMPARISON)) -> DataFrame:
    """(model, metric, value) rows turned into one row per model."""
    return long_metrics.groupBy("model").pivot("metric", list(columns)).agg(F.first("value", ignorenulls=True))


def higher_is_better(metric: str) -> bool:
    return "r2" in metric.lower()


def flag_best(comparison: DataFrame, metric: str = "test_rmse") -> DataFrame:
    """(model, value, best): the model to highlight, the first name on ties."""
    value = F.col(metric)
    top = comparison.agg((F.max if higher_is_better(metric) else F.min)(metric)).scalar()
    best = comparison.where(value == top).agg(F.min("model")).scalar()
    is_best = F.coalesce(F.col("model") == best, F.lit(False))
    return comparison.select("model", value.alias("value"), is_best.alias("best"))


def best_name(test_metrics: Mapping[str, Mapping[str, float]], metric: str = "test_rmse") -> str:
    """The best of {model: metrics on test rows}; the first one on ties.

    'test_' is dropped from the name; names with 'r2' are maximised, all others minimised.
    """
    if not test_metrics:
        raise ValueError("no trained models")
    name = metric.replace("test_", "")
    scores = {m: v[name] for m, v in test_metrics.items() if v.get(name) is not None}
    if not scores:
        raise ValueError(f"metric '{metric}' not found")
    return max(scores, key=scores.get) if higher_is_better(metric) else min(scores, key=scores.get)


def optimisation_gain(baseline_rmse: float, optimized_rmse: float) -> tuple[float, float]:
    """The fall of the error and its share of the baseline in percent."""
    gain = baseline_rmse - optimized_rmse
    return gain, gain / baseline_rmse * 100
