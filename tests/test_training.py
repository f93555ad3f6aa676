import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from numerant.plans.evaluation import ModelEvaluator, sample_points
from numerant.plans.models import REGISTRY, assemble, feature_importance, fit_regressor, load_model_class, predict
from numerant.plans.training import SEARCH_SPACES, ModelOptimizer, ModelTrainer, sample_params
from numerant.sources.documents import load_metrics
from numerant.sources.runs import RunLog

FEATURES = ["f1", "f2", "f3"]


def rows(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 2 * x[:, 0] + 3 * x[:, 1] - x[:, 2] + rng.normal(size=n) * 0.1
    data = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "key bigint, f1 double, f2 double, f3 double, target double"), x, y


@pytest.fixture(scope="module")
def data(spark):
    (train, x, y), (test, _, _) = rows(spark, 100, 0), rows(spark, 30, 1)
    return {"train": train.cache(), "test": test.cache(), "x": x, "y": y}


def config(tmp_path, **extra):
    models = {
        "random_forest": {"enabled": True, "module": "sklearn.ensemble", "class": "RandomForestRegressor", "params": {"n_estimators": 10, "max_depth": 3, "random_state": 42}},
        "ridge": {"module": "sklearn.linear_model", "class": "Ridge", "params": {"random_state": 42}},
        "off": {"enabled": False, "module": "sklearn.linear_model", "class": "Ridge"},
        "mlp": {"module": "sklearn.neural_network", "class": "MLPRegressor"},
        "broken": {"module": "sklearn.linear_model"},
        "failing": {"module": "sklearn.linear_model", "class": "Ridge", "params": {"alpha": -1.0}},
    }
    return {"models": models, "training": {"target_column": "target", "model_dir": str(tmp_path / "models")}, "validation": {"cv_folds": 3}, **extra}


def test_ridge_is_the_closed_form(spark, data):
    x, y = data["x"], data["y"]
    for alpha in (0.5, 1.0, 50.0):
        m = fit_regressor(REGISTRY["sklearn.linear_model", "Ridge"], {"alpha": alpha}, assemble(data["train"], FEATURES, "target"))
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert np.allclose(m.coefficients.toArray(), w, atol=1e-8) and math.isclose(m.intercept, y.mean() - x.mean(0) @ w, abs_tol=1e-8)


def test_elastic_net_is_coordinate_descent(spark, data):
    x, y = data["x"], data["y"]
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    for alpha, l1 in ((1.0, 0.5), (0.1, 0.9), (2.0, 0.2)):
        w = np.zeros(3)
        for _ in range(2000):
            for j in range(3):
                rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
                w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - l1))
        m = fit_regressor(REGISTRY["sklearn.linear_model", "ElasticNet"], {"alpha": alpha, "l1_ratio": l1}, assemble(data["train"], FEATURES, "target"))
        assert np.allclose(m.coefficients.toArray(), w, atol=1e-5)


def test_loading_of_model_classes():
    assert load_model_class("xgboost", "XGBRegressor")
    assert load_model_class("pyspark.ml.regression", "DecisionTreeRegressor")({}, None).getLabelCol() == "_label"
    with pytest.raises(ImportError):
        load_model_class("no_such_module", "X")
    with pytest.raises(AttributeError):
        load_model_class("sklearn.linear_model", "NoSuchModel")
    with pytest.raises(AttributeError):
        load_model_class("pyspark.ml.regression", "NoSuchModel")


@pytest.fixture(scope="module")
def trained(spark, data, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("trained")
    trainer = ModelTrainer(config(tmp), spark, ["key"])
    return trainer.train_all_models(data["train"], data["test"]), tmp


def test_what_is_trained(trained):
    trainer, _ = trained
    assert list(trainer.models_) == ["random_forest", "ridge"]
    meta = trainer.metrics_["ridge"]
    assert set(meta["test_metrics"]) == {"rmse", "mae", "r2", "mape"} and meta["test_metrics"]["r2"] > 0.9
    assert set(meta["cv_results"]) == {"cv_mean", "cv_std", "cv_min", "cv_max"} and meta["n_features"] == 3


def test_folds_are_contiguous(spark, data, trained):
    x, y = data["x"], data["y"]
    scores = []
    for part in np.array_split(np.arange(100), 3):
        rest = np.setdiff1d(np.arange(100), part)
        xc, mean = x[rest] - x[rest].mean(0), y[rest].mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ (y[rest] - mean))
        scores.append(math.sqrt((((x[part] - x[rest].mean(0)) @ w + mean - y[part]) ** 2).mean()))
    assert trained[0].metrics_["ridge"]["cv_results"]["cv_mean"] == pytest.approx(np.mean(scores), abs=1e-8)


def test_comparison_and_choice(trained):
    trainer, _ = trained
    table = trainer.compare_models()
    assert len(table.columns) == 11 and {r.model for r in table.collect()} == {"random_forest", "ridge"}
    for metric in ("test_rmse", "test_r2", "cv_rmse_mean"):
        assert trainer.get_best_model(metric)[0] == "ridge"
    with pytest.raises(ValueError):
        trainer.get_best_model("nothing")


def test_models_and_runs_persist(spark, data, trained):
    trainer, tmp = trained
    loaded = PipelineModel.load(trainer.metrics_["random_forest"]["model_path"])
    a = predict(loaded, data["test"]).select("prediction").collect()
    assert a == predict(trainer.models_["random_forest"], data["test"]).select("prediction").collect()
    runs = {r.run_name: r for r in trainer.run_log.read().collect()}
    assert set(runs) == {"model_random_forest", "model_ridge"}
    assert runs["model_ridge"].n_train == 100 and runs["model_ridge"].n_test == 30 and runs["model_ridge"].metrics["test_r2"] > 0.9
    assert RunLog(spark, str(tmp / "nowhere")).read().count() == 0


def test_importance(spark, trained):
    table = feature_importance(trained[0].models_["random_forest"], spark, 2).collect()
    assert [r.feature for r in table] == ["f2", "f1"] and table[0].importance > table[1].importance
    assert feature_importance(trained[0].models_["ridge"], spark) is None


def test_boosting_beats_the_mean(spark, data):
    for key, params in ((("xgboost", "XGBRegressor"), {"n_estimators": 10}), (("lightgbm", "LGBMRegressor"), {"n_estimators": 10}), (("catboost", "CatBoostRegressor"), {"iterations": 10, "learning_rate": 0.3})):
        m = fit_regressor(REGISTRY[key], params, assemble(data["train"], FEATURES, "target"))
        pred = np.array([r.prediction for r in m.transform(assemble(data["train"], FEATURES, "target", ["key"])).orderBy("key").collect()])
        assert ((data["y"] - pred) ** 2).mean() < data["y"].var() * 0.5


def test_search(spark, data, tmp_path):
    cfg = config(tmp_path)
    cfg["models"] = {"xgboost": {"module": "xgboost", "class": "XGBRegressor", "params": {"n_estimators": 3}}}
    trainer = ModelTrainer(cfg, spark, ["key"]).train_all_models(data["train"], data["test"])
    base = trainer.get_best_model()[2]
    space = {"xgboost": {"max_depth": ("int", 2, 3), "n_estimators": ("int", 2, 4), "learning_rate": ("log", 0.1, 0.3)}}
    search = ModelOptimizer("xgboost", trainer, spaces=space)
    best = search.optimize(data["train"], 2, base["run_id"])
    assert best in [t["params"] for t in search.trials] and search.best_value == min(t["cv_rmse"] for t in search.trials)
    _, measured = search.train_best_model(data["train"], data["test"])
    assert set(measured) == {f"{p}_{m}" for p in ("train", "test") for m in ("rmse", "mae", "r2")}
    meta = search.metadata(base, measured)
    assert meta["improvement"] == pytest.approx(base["test_metrics"]["rmse"] - measured["test_rmse"]) and meta["n_trials"] == 2
    trials = [r for r in trainer.run_log.read().collect() if r.parent_run_id == base["run_id"]]
    assert {r.run_name for r in trials} == {"trial_0", "trial_1"}
    with pytest.raises(ValueError):
        ModelOptimizer("ridge", trainer)


def test_search_space():
    for space in SEARCH_SPACES.values():
        for trial in range(50):
            params = sample_params(space, 1, trial)
            assert all(low <= params[k] <= high for k, (_, low, high) in space.items())
            assert params == sample_params(space, 1, trial)


def test_evaluation_report(spark, data, trained, tmp_path):
    path = trained[0].metrics_["ridge"]["model_path"]
    evaluator = ModelEvaluator(spark, path, target="target")
    found = evaluator.evaluate(data["test"], data["train"])
    assert {f"{p}_{m}" for p in ("train", "test") for m in ("rmse", "mae", "r2", "mape", "max_error", "median_error")} == set(found)
    assert evaluator.overfit is False and evaluator.model_name == "ridge_model"
    assert load_metrics(evaluator.generate_report(str(tmp_path))) == found
    assert spark.read.parquet(str(tmp_path / "ridge_model_residual_histogram_test")).count() == 30
    assert spark.read.parquet(str(tmp_path / "ridge_model_predictions_test")).count() == 30
    assert not (tmp_path / "ridge_model_feature_importance").exists()
    every = {tuple(r) for r in evaluator.points_.collect()}
    some = [tuple(r) for r in sample_points(evaluator.points_, 7).collect()]
    assert sample_points(evaluator.points_).count() == 30 and len(some) == 7 and set(some) <= every
    assert sorted(tuple(r) for r in sample_points(evaluator.points_.repartition(5), 7).collect()) == sorted(some)
    with pytest.raises(FileNotFoundError):
        ModelEvaluator(spark, str(tmp_path / "nothing"))
