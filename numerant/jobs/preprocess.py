"""Fit preprocessing and feature engineering on train, apply to both parts, write all of it."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from ..plans.base import column_changes
from ..plans.features import FeatureEngineer
from ..plans.preprocessing import DataPreprocessor
from ..sources.documents import load_config
from ..sources.tables import ROW_ID, load_split_data, save_processed_data
from .common import log, parser, run


def arguments(argv=None) -> argparse.Namespace:
    p = parser("Preprocess a split pair")
    p.add_argument("--config", default="numerant/configs/preprocessing.yaml")
    p.add_argument("--input-dir", default="data/processed")
    p.add_argument("--output-dir", default="data/interim")
    p.add_argument("--artifacts-dir", default="artifacts/preprocessors")
    p.add_argument("--target", default="MEDV")
    p.add_argument("--key", nargs="+", default=[ROW_ID], help="columns handed through unchanged")
    p.add_argument("--no-feature-engineering", action="store_true")
    p.add_argument("--winsor-mode", choices=["per_batch", "fitted"], default="per_batch")
    p.add_argument("--zero-division", choices=["null", "zero", "ieee"], default="zero", help="a housing ratio over zero; training takes no null")
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    return p.parse_args(argv)


def preprocess(spark, args) -> None:
    config = load_config(args.config, spark)
    train, test = load_split_data(spark, args.input_dir, args.target)
    passthrough = [args.target, *[c for c in args.key if c in train.columns]]
    preprocessor = DataPreprocessor(config["feature_processing"], passthrough, winsor_mode=args.winsor_mode)
    # a written table is read again in each pass, only the columns it needs: no copy of it in memory
    preprocessor.fit(train, cache=False)
    parts = {"train": preprocessor.transform_training(train), "test": preprocessor.transform(test)}
    base = args.artifacts_dir.rstrip("/")
    preprocessor.save(f"{base}/data_preprocessor")
    log.info("features removed and added: %s", column_changes(preprocessor.feature_names_in_, preprocessor.get_feature_names_out()))
    engineering = config.get("feature_engineering")
    if engineering and not args.no_feature_engineering:
        engineer = FeatureEngineer(engineering, passthrough, preprocessor.get_feature_names_out(), args.zero_division).fit(parts["train"])
        parts = {k: engineer.transform(v) for k, v in parts.items()}
        engineer.save(f"{base}/feature_engineer")
        log.info("features removed and added: %s", column_changes(engineer.feature_names_in_, engineer.get_feature_names_out()))
    labelled = parts["train"].withColumn("split", F.lit("train")).unionByName(parts["test"].withColumn("split", F.lit("test")))
    save_processed_data(labelled, args.output_dir, args.target, fmt=args.format)


def main(argv=None) -> int:
    return run("preprocess", arguments(argv), preprocess)


if __name__ == "__main__":
    sys.exit(main())
