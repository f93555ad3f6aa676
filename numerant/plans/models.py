"""Regressors: from configured names and parameters to MLlib estimators."""

from __future__ import annotations

import importlib
import inspect
import logging
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .boosting import HistogramBoosting, parameters
from .gram import Penalty

log = logging.getLogger(__name__)

VECTOR = "_features"
LABEL = "_label"
PREDICTION = "prediction"


@dataclass(frozen=True)
class LabelStats:
    """What the penalties of linear models depend on."""

    rows: int
    std: float  # population deviation


Builder = Callable[[dict[str, Any], LabelStats], Any]

# Parameters that steer speed or printing elsewhere and have no meaning here.
NO_EFFECT = {"n_jobs", "verbose", "verbosity", "logging_level", "train_dir", "thread_count", "silent"}
DEEPEST = 30  # levels that MLlib grows


def _depth(levels: int) -> int:
    if levels > DEEPEST:
        raise ValueError(f"a depth of {levels} is asked for; MLlib grows {DEEPEST} levels at most")
    return levels


def _leftover(name: str, params: Mapping[str, Any]) -> None:
    rest = sorted(k for k in params if k not in NO_EFFECT)
    if rest:
        log.warning("%s: parameters without an equivalent are not used: %s", name, rest)


def _subset(share: Any) -> str:
    if share is None or share == 1.0:
        return "all"
    return share if isinstance(share, str) else str(share)


def _tree_columns(estimator):
    return estimator.setFeaturesCol(VECTOR).setLabelCol(LABEL).setPredictionCol(PREDICTION)


def _random_forest(params: dict[str, Any], stats: LabelStats):
    """100 trees over all features on bootstrap samples; without a depth, the 30 levels MLlib grows at most.

    Splits are looked for among ``max_bins`` (default 32, MLlib's own) quantile bins of each feature.
    """
    depth = params.pop("max_depth", None)
    out = RandomForestRegressor(
        numTrees=int(params.pop("n_estimators", 100)),
        maxDepth=_depth(int(depth)) if depth else DEEPEST,
        bootstrap=bool(params.pop("bootstrap", True)),
        minInstancesPerNode=int(params.pop("min_samples_leaf", 1)),
        featureSubsetStrategy=_subset(params.pop("max_features", 1.0)),
        maxBins=int(params.pop("max_bins", 32)),
        seed=int(params.pop("random_state", 42)),
        checkpointInterval=10,
    )
    _leftover("random forest", params)
    return _tree_columns(out)


def _boosting(growth: str, depth_key: str, **defaults: Any) -> Builder:
    def build(params: dict[str, Any], stats: LabelStats | None = None):
        spec, rest = parameters(params, growth, depth_key, **defaults)
        _leftover("boosting", rest)
        return HistogramBoosting(spec, VECTOR, LABEL, PREDICTION)

    build.side_by_side = True  # the models of all folds grow in the same passes
    return build


def _linear(regularization: float, mix: float, params: dict[str, Any]):
    out = LinearRegression(
        featuresCol=VECTOR, labelCol=LABEL, predictionCol=PREDICTION, solver="normal", standardization=False,
        regParam=regularization, elasticNetParam=mix, fitIntercept=bool(params.pop("fit_intercept", True)),
        maxIter=int(params.pop("max_iter", 10_000)), tol=float(params.pop("spark_tol", 1e-12)),
    )
    params.pop("random_state", None)
    params.pop("tol", None)
    _leftover("linear model", params)
    return out


def _ridge(params: dict[str, Any], stats: LabelStats):
    """min sum e^2 + alpha |w|^2. MLlib averages the loss and scales the label, hence std / n."""
    return _linear(float(params.pop("alpha", 1.0)) * stats.std / stats.rows, 0.0, params)


def _elastic_net(params: dict[str, Any], stats: LabelStats):
    """min sum e^2 / 2n + alpha l1 |w|_1 + alpha (1 - l1) |w|^2 / 2, on MLlib's scaled label."""
    alpha, l1 = float(params.pop("alpha", 1.0)), float(params.pop("l1_ratio", 0.5))
    total = alpha * (l1 + stats.std * (1 - l1))
    return _linear(total, alpha * l1 / total if total else 0.0, params)


def _ridge_penalty(params: dict[str, Any]) -> Penalty:
    return Penalty(l2=float(params.get("alpha", 1.0)), intercept=bool(params.get("fit_intercept", True)))


def _elastic_net_penalty(params: dict[str, Any]) -> Penalty:
    alpha, l1 = float(params.get("alpha", 1.0)), float(params.get("l1_ratio", 0.5))
    return Penalty(alpha * l1, alpha * (1 - l1), True, bool(params.get("fit_intercept", True)), int(params.get("max_iter", 10_000)))


#: Builders whose models come from Gram matrices when many are fitted to parts of the same rows.
PENALTIES: dict[Builder, Callable[[dict[str, Any]], Penalty]] = {_ridge: _ridge_penalty, _elastic_net: _elastic_net_penalty}

# Configured (module, class) names and the default parameters they stand for.
REGISTRY: dict[tuple[str, str], Builder] = {
    ("sklearn.ensemble", "RandomForestRegressor"): _random_forest,
    ("xgboost", "XGBRegressor"): _boosting("by_level", "max_depth", depth=6, step=0.3, rounds=100, lambda_=1.0),
    ("lightgbm", "LGBMRegressor"): _boosting("by_leaf", "num_leaves", leaves=31, depth=64, step=0.1, rounds=100, lambda_=0.0, least_rows=20),
    ("catboost", "CatBoostRegressor"): _boosting("symmetric", "depth", depth=6, step=0.03, rounds=1000, lambda_=3.0),
    ("sklearn.linear_model", "Ridge"): _ridge,
    ("sklearn.linear_model", "ElasticNet"): _elastic_net,
}


def load_model_class(module: str, name: str) -> Builder:
    """The builder behind a configured (module, class).

    Names in the registry map to MLlib; ``pyspark.ml`` classes are used as they are. ImportError
    for a module that is not there, AttributeError for a class that is not in it.
    """
    if (module, name) in REGISTRY:
        return REGISTRY[(module, name)]
    if any(m == module for m, _ in REGISTRY):
        raise AttributeError(f"no regressor '{name}' for module '{module}'; available: {sorted(c for m, c in REGISTRY if m == module)}")
    try:
        found = getattr(importlib.import_module(module), name)
    except ImportError as e:
        raise ImportError(f"module '{module}' cannot be imported: {e}") from e
    if not module.startswith("pyspark.ml") or not inspect.isclass(found):
        raise ImportError(f"'{module}.{name}' does not train on Spark; use a pyspark.ml regressor")

    def build(params: dict[str, Any], stats: LabelStats):
        return found(**params).setFeaturesCol(VECTOR).setLabelCol(LABEL).setPredictionCol(PREDICTION)

    return build


def assembler(features: Sequence[str]) -> VectorAssembler:
    """NULL in a feature is an error: impute first."""
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")


def assemble(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector and label (plus ``keep``), nothing else."""
    data = assembler(features).transform(df)
    return data.select(VECTOR, F.col(f"`{target}`").cast("double").alias(LABEL), *keep)


def label_stats(assembled: DataFrame) -> LabelStats:
    row = assembled.agg(F.count(LABEL).alias("n"), F.stddev_pop(LABEL).alias("s")).first()
    if not row.n:
        raise ValueError("no rows to train on")
    return LabelStats(row.n, row.s or 0.0)


def label_stats_without(assembled: DataFrame, part: str) -> dict[Any, LabelStats]:
    """For each value of ``part`` the label statistics of all other rows: one pass for all of them.

    Means and squared deviations of the parts are put together, not raw squares, which would lose digits.
    """
    rows = assembled.groupBy(part).agg(F.count(LABEL).alias("n"), F.avg(LABEL).alias("m"), F.var_pop(LABEL).alias("v")).collect()
    out = {}
    for left_out in rows:
        n, mean, squares = 0, 0.0, 0.0
        for r in rows:
            if r is left_out or not r["n"]:
                continue
            gap, total = r["m"] - mean, n + r["n"]
            squares += r["v"] * r["n"] + gap * gap * n * r["n"] / total
            mean, n = mean + gap * r["n"] / total, total
        if not n:
            raise ValueError("no rows to train on")
        out[left_out[part]] = LabelStats(n, math.sqrt(squares / n))
    return out


def fit_regressor(builder: Builder, params: Mapping[str, Any], assembled: DataFrame, stats: LabelStats | None = None):
    """Fit one estimator on assembled rows, whose label statistics may be known."""
    shared_folder(assembled.sparkSession)  # trees checkpoint their node assignments there
    return builder(dict(params), stats or label_stats(assembled)).fit(assembled)


def as_pipeline(model, features: Sequence[str]) -> PipelineModel:
    """Assembler plus model: predicts from plain feature columns and saves as one unit."""
    return PipelineModel([assembler(features), model])


def predict(model: PipelineModel, df: DataFrame, column: str = PREDICTION) -> DataFrame:
    """The frame plus its predictions."""
    out = model.transform(df).drop(VECTOR)
    return out if column == PREDICTION else out.withColumnRenamed(PREDICTION, column)


def feature_importance(model: PipelineModel, spark, top: int | None = 15) -> DataFrame | None:
    """(feature, importance), largest first; None for models without importances."""
    assembled, fitted = model.stages[0], model.stages[-1]
    if not hasattr(fitted, "featureImportances"):
        return None
    values = fitted.featureImportances.toArray().tolist()
    table = spark.createDataFrame(list(zip(assembled.getInputCols(), values)), "feature string, importance double")
    table = table.orderBy(F.desc("importance"), "feature")
    return table.limit(top) if top else table
