"""Evaluate a saved model on the processed test rows and write the report."""

from __future__ import annotations

import argparse
import sys

from ..plans.evaluation import CHART_POINTS, ModelEvaluator
from ..sources.tables import load_processed_data
from .common import log, parser, run


def arguments(argv=None) -> argparse.Namespace:
    p = parser("Evaluate a model")
    p.add_argument("--model", required=True)
    p.add_argument("--data-dir", default="data/interim")
    p.add_argument("--output-dir", default="artifacts/evaluation")
    p.add_argument("--target-column", default="MEDV")
    p.add_argument("--include-train", action="store_true")
    p.add_argument("--points", type=int, default=CHART_POINTS, help="test rows written as chart points at most")
    return p.parse_args(argv)


def evaluate(spark, args) -> None:
    (test,) = load_processed_data(spark, args.data_dir, args.target_column, ("test",))
    train = None
    if args.include_train:
        try:
            (train,) = load_processed_data(spark, args.data_dir, args.target_column, ("train",))
        except FileNotFoundError as e:
            log.warning("no train rows: %s", e)
    evaluator = ModelEvaluator(spark, args.model, target=args.target_column)
    metrics = evaluator.evaluate(test, train)
    log.info("metrics: %s", metrics)
    evaluator.generate_report(args.output_dir, args.points)


def main(argv=None) -> int:
    return run("evaluate", arguments(argv), evaluate)


if __name__ == "__main__":
    sys.exit(main())
