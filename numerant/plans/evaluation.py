"""Evaluation of a saved model and the data behind its charts."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import absolute_residual, as_double, numeric_columns, percentage_residual, residual
from ..operators.metrics import as_dict, extended_metrics, flag_best, regression_metrics
from ..operators.stats import correlations, describe, histogram, iqr_bounds, outlier_counts, quartiles, value_range
from ..session import cached
from ..sources.documents import save_metrics
from .models import PREDICTION, feature_importance, predict

log = logging.getLogger(__name__)

CHART_POINTS = 10_000


def residual_points(df: DataFrame, actual: str, predicted: str, keep: Sequence[str] = ()) -> DataFrame:
    """y, prediction, residual, absolute and percentage error of every row."""
    return df.select(
        *keep,
        as_double(actual).alias("actual"),
        as_double(predicted).alias("predicted"),
        residual(actual, predicted).alias("residual"),
        absolute_residual(actual, predicted).alias("absolute_error"),
        percentage_residual(actual, predicted).alias("percentage_error"),
    )


def sample_points(points: DataFrame, most: int = CHART_POINTS) -> DataFrame:
    """``most`` chart points, or all rows if there are fewer: those with the smallest hashes, the same ones however rows are dealt.

    Each task keeps its ``most`` smallest and the merge keeps as many again, so what is drawn does not grow with the rows.
    """
    return points.orderBy(F.xxhash64(*points.columns), *points.columns).limit(most)


def residual_histogram(points: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(points, ["residual"], bins)


def error_distribution(points: DataFrame, bins: int = 30) -> tuple[DataFrame, DataFrame]:
    """Histograms of the absolute and the percentage errors, and their means."""
    means = points.agg(F.avg("absolute_error").alias("mean_absolute"), F.avg("percentage_error").alias("mean_percentage"))
    return histogram(points, ["absolute_error", "percentage_error"], bins), means


def prediction_summary(points: DataFrame) -> DataFrame:
    """min_value, max_value over both axes and r2: the frame of predicted against actual."""
    limits = value_range(points, ["actual", "predicted"]).first()
    r2 = regression_metrics(points, "actual", "predicted").select("r2")
    return r2.select(F.lit(limits.min_value).alias("min_value"), F.lit(limits.max_value).alias("max_value"), "r2")


def model_comparison_chart(comparison: DataFrame, metric: str = "test_rmse") -> DataFrame:
    return flag_best(comparison, metric)


def box_plot(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5) -> DataFrame:
    """Five numbers, mean, deviation, IQR bounds and outliers of each column."""
    columns = list(columns or numeric_columns(df))
    with cached(df.select(*columns)) as data:
        marks = quartiles(data, columns)
        counts = outlier_counts(data, iqr_bounds(data, columns, factor, marks=marks)).select("column", "lower", "upper", "outliers")
        counts = df.sparkSession.createDataFrame(counts.collect(), counts.schema)  # one row per column
        return describe(data, columns, marks=marks).join(counts, "column")


def correlation_heat_map(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return correlations(df, columns)


class ModelEvaluator:
    """Measures a saved model and writes its report."""

    def __init__(self, spark: SparkSession, model_path: str, model_name: str | None = None, target: str = "MEDV"):
        self.spark, self.target = spark, target
        self.model_name = model_name or model_path.rstrip("/").rsplit("/", 1)[-1]
        try:
            self.model = PipelineModel.load(model_path)
        except Exception as e:
            if "Path" in str(e) or "path" in str(e):
                raise FileNotFoundError(f"no model at {model_path}") from e
            raise
        self.metrics_: dict[str, float | bool] = {}
        self.points_: DataFrame | None = None

    def evaluate(self, test: DataFrame, train: DataFrame | None = None) -> dict:
        """test_* metrics, with a train frame also train_* metrics and the overfit flag."""
        with cached(predict(self.model, test).select(self.target, PREDICTION)) as scored:
            self.metrics_ = as_dict(extended_metrics(scored, self.target, PREDICTION, "test_"))
        self.points_ = residual_points(predict(self.model, test), self.target, PREDICTION)
        if train is not None:
            with cached(predict(self.model, train).select(self.target, PREDICTION)) as scored:
                self.metrics_.update(as_dict(extended_metrics(scored, self.target, PREDICTION, "train_")))
            if self.metrics_["train_rmse"] - self.metrics_["test_rmse"] < -1.0:
                log.warning("overfitting: train rmse %s, test rmse %s", self.metrics_["train_rmse"], self.metrics_["test_rmse"])
        return self.metrics_

    @property
    def overfit(self) -> bool | None:
        if "train_rmse" not in self.metrics_:
            return None
        return self.metrics_["train_rmse"] - self.metrics_["test_rmse"] < -1.0

    def chart_data(self, bins: int = 30, points: int = CHART_POINTS) -> dict[str, DataFrame]:
        """The tables behind the charts of the test rows.

        ``points``: how many rows are drawn as points at most, the same ones each time; histograms, means and summary are of all rows.
        """
        if self.points_ is None:
            raise ValueError("evaluate first")
        drawn = sample_points(self.points_, points)
        errors, means = error_distribution(self.points_, bins)
        charts = {
            "residuals_test": drawn.select("predicted", "residual"),
            "residual_histogram_test": residual_histogram(self.points_, bins),
            "predictions_test": drawn.select("actual", "predicted"),
            "prediction_summary_test": prediction_summary(self.points_),
            "errors_test": errors,
            "error_means_test": means,
        }
        importance = feature_importance(self.model, self.spark)
        if importance is not None:
            charts["feature_importance"] = importance
        return charts

    def generate_report(self, folder: str, points: int = CHART_POINTS) -> str:
        """Metrics as JSON, chart tables as Parquet (points: see ``chart_data``); returns the path of the JSON."""
        base = f"{folder.rstrip('/')}/{self.model_name}"
        save_metrics(f"{base}_metrics.json", self.metrics_, self.spark)
        with cached(self.points_):
            for name, table in self.chart_data(points=points).items():
                table.write.mode("overwrite").parquet(f"{base}_{name}")
        return f"{base}_metrics.json"
