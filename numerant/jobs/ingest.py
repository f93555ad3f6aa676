"""Read the raw table, split it, write both parts."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from ..operators.split import split_data
from ..operators.stats import split_summary
from ..session import scratch_path
from ..sources.tables import ROW_ID, load_raw_data, load_split_data, save_split_data, target_last, with_row_id
from .common import log, parser, run


def arguments(argv=None) -> argparse.Namespace:
    p = parser("Split a raw table into train and test")
    p.add_argument("--input", default="data/raw/housing.csv")
    p.add_argument("--output", default="data/processed")
    p.add_argument("--test-size", type=float, default=0.2)
    p.add_argument("--random-state", type=int, default=42)
    p.add_argument("--target", default="MEDV")
    p.add_argument("--key", nargs="+", default=None, help="columns that identify a row; numbered in file order if absent")
    p.add_argument("--stratify", default=None)
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    return p.parse_args(argv)


def ingest(spark, args) -> None:
    df = target_last(load_raw_data(spark, args.input), args.target)
    # cells are parsed and typed once, the passes of the split read the columns they need; row numbers must be the same in all of them
    path = scratch_path(spark, "typed")
    (df if args.key else with_row_id(df)).write.parquet(path)
    df, key = spark.read.schema(df.schema if args.key else with_row_id(df).schema).parquet(path), args.key or [ROW_ID]
    labelled = split_data(df, key, args.target, args.test_size, args.random_state, args.stratify)
    save_split_data(labelled, args.output, args.target, fmt=args.format)
    parts = zip(("train", "test"), load_split_data(spark, args.output, args.target))
    train, test = (df.select(args.target).withColumn("split", F.lit(name)) for name, df in parts)
    for r in split_summary(train.unionByName(test), args.target).collect():
        log.info("%s: %d rows (%.1f %%), target mean %s, std %s", r["split"], r["rows"], r["percent"], r["mean"], r["std"])


def main(argv=None) -> int:
    return run("ingest", arguments(argv), ingest)


if __name__ == "__main__":
    sys.exit(main())
