"""Training, cross-validation, comparison, selection and hyper-parameter search."""

from __future__ import annotations

import logging
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns, quoted
from ..operators.metrics import as_dict, best_name, comparison_table, cv_summary, metric_columns, optimisation_gain
from ..operators.split import assign_folds
from ..operators.stats import columns_by_missing
from ..session import cached
from ..sources.runs import RunLog
from ..sources.tables import ROW_ID, load_processed_data
from .gram import Grams, fold_grams, fold_scores
from .models import LABEL, PENALTIES, PREDICTION, VECTOR, as_pipeline, assemble, fit_regressor, label_stats_without, load_model_class, predict

log = logging.getLogger(__name__)

FOLD = "_fold"

# Scoring names, the metric they stand for and their factor.
SCORINGS: dict[str, tuple[str, float]] = {
    "neg_root_mean_squared_error": ("rmse", 1.0),
    "neg_mean_absolute_error": ("mae", 1.0),
    "neg_mean_absolute_percentage_error": ("mape", 0.01),
    "r2": ("r2", 1.0),
}


def cross_validate(
    builder, params: Mapping[str, Any], folded: DataFrame, folds: int,
    scoring: str = "neg_root_mean_squared_error", parallelism: int = 2, grams: Grams | None = None,
) -> DataFrame:
    """(fold, score) of a regressor on assembled rows with a fold column. Errors ('neg_' names) come out positive.

    Ridge and elastic net take one scan for all folds (``gram``), and none if the matrices of the rows are given. Boosted models of all folds grow
    side by side (``boosting``). Other fits are distributed jobs;
    ``parallelism`` of them are in flight at a time.
    """
    if scoring not in SCORINGS:
        raise ValueError(f"unknown scoring '{scoring}', only {sorted(SCORINGS)}")
    metric, factor = SCORINGS[scoring]
    spark = folded.sparkSession
    if builder in PENALTIES:
        grams = grams or fold_grams(folded, VECTOR, LABEL, FOLD)
        found = fold_scores(folded, grams, [PENALTIES[builder](dict(params))], metric, VECTOR, LABEL, FOLD)[0]
        return spark.createDataFrame([(f, s * factor) for f, s in sorted(found.items())], "fold int, score double")
    if getattr(builder, "side_by_side", False):
        found = builder(dict(params)).fold_scores(folded, FOLD, folds, metric)
        return spark.createDataFrame([(f, s * factor) for f, s in sorted(found.items())], "fold int, score double")
    stats = label_stats_without(folded, FOLD)

    def score(fold: int) -> tuple[int, float]:
        model = fit_regressor(builder, params, folded.where(F.col(FOLD) != fold), stats[fold])
        held_out = model.transform(folded.where(F.col(FOLD) == fold))
        row = held_out.agg(*metric_columns(LABEL, PREDICTION)).first()
        return fold, row[metric] * factor

    with ThreadPoolExecutor(max(1, min(parallelism, folds))) as pool:
        scores = list(pool.map(inheritable_thread_target(spark)(score), range(folds)))
    return spark.createDataFrame(scores, "fold int, score double")


class ModelTrainer:
    """Trains the configured models on a train frame and judges them on a test frame.

    ``order_by`` names the columns that put rows in order for the contiguous folds
    (``validation.order_by`` in the configuration). Without one, ``_row_id`` is used if the frame
    has it, else a hash of the row: reproducible, but not the order of the file.
    """

    def __init__(self, config: Mapping, spark: SparkSession, order_by: Sequence[str] | None = None, parallelism: int = 2):
        self.config = dict(config)
        self.spark = spark
        training = self.config.get("training", {})
        self.target = training.get("target_column", "MEDV")
        self.model_dir = training.get("model_dir")
        validation = self.config.get("validation") or {}
        self.folds = validation.get("cv_folds", 5)
        self.scoring = validation.get("cv_scoring", "neg_root_mean_squared_error")
        self.order_by = list(order_by or validation.get("order_by") or [])
        self.parallelism = parallelism
        self.passthrough = [ROW_ID, *self.order_by]
        self._grams: tuple[DataFrame | None, Grams | None] = (None, None)  # of the rows that were folded last
        self.models_: dict[str, PipelineModel] = {}
        self.metrics_: dict[str, dict] = {}

    @property
    def run_log(self) -> RunLog | None:
        return RunLog(self.spark, self.model_dir) if self.model_dir else None

    def load_data(self, data_dir: str | None = None, target: str | None = None) -> tuple[DataFrame, DataFrame]:
        """The processed pair; arguments override the configuration."""
        self.target = target or self.target
        return load_processed_data(self.spark, data_dir or self.config["training"]["data_dir"], self.target)

    def features(self, df: DataFrame) -> list[str]:
        return numeric_columns(df, [self.target, *self.passthrough])

    def fold_rows(self, train: DataFrame) -> DataFrame:
        """Assembled training rows with their fold."""
        features = self.features(train)
        order = self.order_by or ([ROW_ID] if ROW_ID in train.columns else [])
        if not order:
            train = train.withColumn("_hash", F.xxhash64(*[quoted(c) for c in train.columns]))
            order = ["_hash"]
        rows = train.select(*[quoted(c) for c in dict.fromkeys([*features, self.target, *order])])
        return assemble(assign_folds(rows, order, self.folds, FOLD), features, self.target, [FOLD])

    def train_model(self, name: str, spec: Mapping, folded: DataFrame, train: DataFrame, test: DataFrame, sizes: tuple[int, int]) -> dict | None:
        """Cross-validate, fit on all training rows, measure on both parts, save, log."""
        module, cls = spec.get("module"), spec.get("class")
        if not module or not cls:
            log.error("model '%s' skipped: 'module' or 'class' is missing", name)
            return None
        try:
            builder = load_model_class(module, cls)
        except (ImportError, AttributeError) as e:
            log.error("model '%s' skipped: %s", name, e)
            return None
        params = dict(spec.get("params") or {})
        if builder in PENALTIES and self._grams[0] is not folded:
            self._grams = (folded, fold_grams(folded, VECTOR, LABEL, FOLD))
        grams = self._grams[1] if builder in PENALTIES else None
        scores = cross_validate(builder, params, folded, self.folds, self.scoring, self.parallelism, grams)
        cv = as_dict(cv_summary(scores))
        features = self.features(train)
        model = as_pipeline(fit_regressor(builder, params, folded.drop(FOLD)), features)
        measured = {
            part: as_dict(predict(model, rows).agg(*metric_columns(self.target, PREDICTION)))
            for part, rows in (("train", train), ("test", test))
        }
        path, run_id = None, None
        if self.model_dir:
            path = f"{self.model_dir.rstrip('/')}/{name}_model"
            model.write().overwrite().save(path)
            prefix = (self.config.get("training", {}).get("mlflow") or {}).get("run_name_prefix", "model")
            run_id = self.run_log.append(
                f"{prefix}_{name}", name, params,
                {**cv, **{f"{part}_{k}": v for part, m in measured.items() for k, v in m.items()}},
                model_class=cls, model_module=module, n_features=len(features),
                n_train=sizes[0], n_test=sizes[1], model_path=path,
            )
        metadata = {
            "model_name": name, "model_class": cls, "model_module": module, "params": params,
            "train_metrics": measured["train"], "test_metrics": measured["test"], "cv_results": cv,
            "model_path": path, "run_id": run_id, "n_features": len(features),
        }
        return {"model": model, "metadata": metadata}

    def check_complete(self, train: DataFrame) -> None:
        """Models take no missing values: name the columns before the fits fail on them."""
        holed, _ = columns_by_missing(train, [*self.features(train), self.target])
        if holed:
            raise ValueError(f"missing values in {holed}: impute them, or give ratios over zero a value")

    def train_all_models(self, train: DataFrame, test: DataFrame) -> ModelTrainer:
        """Every enabled model; one that fails is logged and left out."""
        with cached(train) as train, cached(test) as test, cached(self.fold_rows(train)) as folded:
            self.check_complete(train)
            sizes = (train.count(), test.count())
            for name, spec in self.config["models"].items():
                if not spec.get("enabled", True):
                    log.info("model '%s' is disabled", name)
                    continue
                try:
                    result = self.train_model(name, spec, folded, train, test, sizes)
                except Exception:
                    log.exception("model '%s' failed", name)
                    continue
                if result:
                    self.models_[name] = result["model"]
                    self.metrics_[name] = result["metadata"]
        return self

    def get_best_model(self, metric: str = "test_rmse") -> tuple[str, PipelineModel, dict]:
        """Best by a test metric, or by 'cv_rmse_mean', which leaves the test rows out of the choice."""
        if metric == "cv_rmse_mean":
            name = best_name({m: {metric: d["cv_results"]["cv_mean"]} for m, d in self.metrics_.items()}, metric)
        else:
            name = best_name({m: d["test_metrics"] for m, d in self.metrics_.items()}, metric)
        return name, self.models_[name], self.metrics_[name]

    def compare_models(self) -> DataFrame:
        """One row per model: train, test and cross-validation figures."""
        rows = []
        for name, d in self.metrics_.items():
            rows += [(name, f"{p}_{k}", v) for p in ("train", "test") for k, v in d[f"{p}_metrics"].items()]
            rows += [(name, "cv_rmse_mean", d["cv_results"]["cv_mean"]), (name, "cv_rmse_std", d["cv_results"]["cv_std"])]
        return comparison_table(self.spark.createDataFrame(rows, "model string, metric string, value double"))


# What the search may try, as (kind, low, high).
_BOOSTING_SPACE = {
    "learning_rate": ("log", 0.01, 0.3),
    "n_estimators": ("int", 50, 500),
    "subsample": ("float", 0.6, 1.0),
    "colsample_bytree": ("float", 0.6, 1.0),
    "reg_alpha": ("float", 0.0, 1.0),
    "reg_lambda": ("float", 0.0, 1.0),
}
SEARCH_SPACES: dict[str, dict[str, tuple[str, float, float]]] = {
    "xgboost": {"max_depth": ("int", 3, 10), **_BOOSTING_SPACE},
    "lightgbm": {"num_leaves": ("int", 20, 150), **_BOOSTING_SPACE},
}


def sample_params(space: Mapping[str, tuple[str, float, float]], seed: int, trial: int) -> dict[str, float | int]:
    """The parameters of one trial; the same seed gives the same trials."""
    rng = random.Random(f"{seed}-{trial}")
    out: dict[str, float | int] = {}
    for name, (kind, low, high) in space.items():
        if kind == "int":
            out[name] = rng.randint(int(low), int(high))
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            out[name] = rng.uniform(low, high)
    return out


class ModelOptimizer:
    """Seeded random search that minimises the mean cross-validation error."""

    def __init__(self, model_name: str, trainer: ModelTrainer, seed: int = 42, spaces: Mapping = SEARCH_SPACES):
        if model_name not in spaces:
            raise ValueError(f"no search space for '{model_name}'")
        self.model_name, self.trainer, self.seed = model_name, trainer, seed
        self.space = spaces[model_name]
        spec = trainer.config["models"][model_name]
        self.fixed = {"random_state": 42}
        self.builder = load_model_class(spec["module"], spec["class"])
        self.trials: list[dict] = []
        self.best_params: dict | None = None
        self.best_value: float | None = None
        self.best_model: PipelineModel | None = None

    def optimize(self, train: DataFrame, n_trials: int = 100, parent_run_id: str | None = None) -> dict:
        """Run the trials; each becomes a row of the runs table below its parent run."""
        trainer = self.trainer
        with cached(trainer.fold_rows(train)) as folded:
            for trial in range(n_trials):
                params = sample_params(self.space, self.seed, trial)
                scores = cross_validate(
                    self.builder, {**self.fixed, **params}, folded, trainer.folds, trainer.scoring, trainer.parallelism
                )
                value = as_dict(cv_summary(scores))["cv_mean"]
                self.trials.append({"trial": trial, "params": params, "cv_rmse": value})
                if trainer.run_log:
                    trainer.run_log.append(
                        f"trial_{trial}", self.model_name, {**self.fixed, **params}, {"cv_rmse": value}, parent_run_id=parent_run_id
                    )
                better = self.best_value is None or (
                    value > self.best_value if trainer.scoring == "r2" else value < self.best_value
                )
                if better:
                    self.best_value, self.best_params = value, params
        return self.best_params

    def train_best_model(self, train: DataFrame, test: DataFrame) -> tuple[PipelineModel, dict[str, float]]:
        """Fit with the best parameters on all training rows; rmse, mae and r2 of both parts."""
        if self.best_params is None:
            raise ValueError("optimize first")
        trainer = self.trainer
        features = trainer.features(train)
        with cached(assemble(train, features, trainer.target)) as rows:
            fitted = fit_regressor(self.builder, {**self.fixed, **self.best_params}, rows)
        self.best_model = as_pipeline(fitted, features)
        out = {}
        for part, df in (("train", train), ("test", test)):
            m = as_dict(predict(self.best_model, df).agg(*metric_columns(trainer.target, PREDICTION)))
            out.update({f"{part}_{k}": m[k] for k in ("rmse", "mae", "r2")})
        return self.best_model, out

    def save_best_model(self, path: str) -> None:
        self.best_model.write().overwrite().save(path)

    def metadata(self, baseline: Mapping, optimized: Mapping[str, float]) -> dict:
        """What the search gained over the baseline."""
        before = baseline["test_metrics"]["rmse"]
        gain, percent = optimisation_gain(before, optimized["test_rmse"])
        return {
            "model_name": f"{self.model_name}_optimized", "base_model": self.model_name, "optimization": "random_search",
            "n_trials": len(self.trials), "best_params": self.best_params, "baseline_rmse": before,
            "optimized_rmse": optimized["test_rmse"], "improvement": gain, "improvement_percent": percent,
            "test_metrics": {k: optimized[f"test_{k}"] for k in ("rmse", "mae", "r2")},
            "train_metrics": {k: optimized[f"train_{k}"] for k in ("rmse", "mae", "r2")},
        }
