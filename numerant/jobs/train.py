"""Train the configured models, compare, choose the best, optionally search its parameters."""

from __future__ import annotations

import argparse
import sys

from ..plans.training import ModelOptimizer, ModelTrainer
from ..sources.documents import load_config, save_yaml
from .common import log, parser, run


def arguments(argv=None) -> argparse.Namespace:
    p = parser("Train and compare regressors")
    p.add_argument("--config", default="numerant/configs/models.yaml")
    p.add_argument("--data-dir", default=None)
    p.add_argument("--models", nargs="+", default=None, help="train only these")
    p.add_argument("--optimize", action="store_true")
    p.add_argument("--n-trials", type=int, default=100)
    p.add_argument("--select-on", default="test_rmse", help="metric to choose by; cv_rmse_mean leaves the test rows out of it")
    p.add_argument("--order-by", nargs="+", default=None, help="columns that put rows in order for the folds")
    p.add_argument("--parallelism", type=int, default=2, help="fits in flight at a time")
    return p.parse_args(argv)


def train(spark, args) -> None:
    config = load_config(args.config, spark)
    if args.models:
        config["models"] = {k: v for k, v in config["models"].items() if k in args.models}
    trainer = ModelTrainer(config, spark, args.order_by, args.parallelism)
    rows_train, rows_test = trainer.load_data(args.data_dir)
    trainer.train_all_models(rows_train, rows_test)
    out = config["training"]["model_dir"].rstrip("/")
    comparison = trainer.compare_models()
    comparison.coalesce(1).write.mode("overwrite").csv(f"{out}/model_comparison_baseline.csv", header=True)
    for name, metadata in trainer.metrics_.items():
        save_yaml(f"{out}/{name}_metadata.yaml", metadata, spark)

    name, model, metadata = trainer.get_best_model(args.select_on)
    model.write().overwrite().save(f"{out}/best_model_baseline")
    save_yaml(f"{out}/best_model_baseline_metadata.yaml", metadata, spark)
    log.info("best model: %s, test rmse %s", name, metadata["test_metrics"]["rmse"])
    if args.optimize:
        try:
            optimizer = ModelOptimizer(name, trainer)
            optimizer.optimize(rows_train, args.n_trials, metadata["run_id"])
            best, measured = optimizer.train_best_model(rows_train, rows_test)
            described = optimizer.metadata(metadata, measured)
            optimizer.save_best_model(f"{out}/{name}_optimized")
            save_yaml(f"{out}/{name}_optimized_metadata.yaml", described, spark)
            trainer.run_log.append(
                f"{name}_optimized", f"{name}_optimized", optimizer.best_params, {**measured, "improvement": described["improvement"]},
                parent_run_id=metadata["run_id"], model_path=f"{out}/{name}_optimized",
            )
            model, metadata = best, described
        except Exception:
            log.exception("search failed; the baseline model stays")
    model.write().overwrite().save(f"{out}/best_model")
    save_yaml(f"{out}/best_model_metadata.yaml", metadata, spark)


def main(argv=None) -> int:
    return run("train", arguments(argv), train)


if __name__ == "__main__":
    sys.exit(main())
