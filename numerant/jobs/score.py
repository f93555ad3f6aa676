"""Score a table of requests, or a folder of arriving files, with saved artifacts."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException

from ..functions.rules import HOUSING_SCHEMA
from ..plans.scoring import Scorer, invalid_rows, valid_rows, validate
from ..session import cached
from ..sources.tables import read_table
from ..streaming.scoring import read_requests, start_scoring
from .common import parser, run


def arguments(argv=None) -> argparse.Namespace:
    p = parser("Score requests")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--quarantine", default=None, help="where invalid rows go; default <output>_invalid")
    p.add_argument("--preprocessor", default="artifacts/preprocessors/data_preprocessor")
    p.add_argument("--engineer", default="artifacts/preprocessors/feature_engineer")
    p.add_argument("--model", default="artifacts/models/best_model")
    p.add_argument("--model-name", default="best_model")
    p.add_argument("--model-version", default="1.0.0")
    p.add_argument("--keep", nargs="*", default=[], help="columns handed through")
    p.add_argument("--stream", action="store_true", help="treat --input as a folder of arriving Parquet files")
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--files-per-trigger", type=int, default=None, help="stream: files in a micro-batch at most")
    p.add_argument("--once", action="store_true", help="stream: stop when all present files are scored")
    return p.parse_args(argv)


def score(spark, args) -> None:
    scorer = Scorer.load(
        args.preprocessor, args.engineer or None, args.model, model_name=args.model_name, model_version=args.model_version
    )
    quarantine = args.quarantine or f"{args.output.rstrip('/')}_invalid"
    if args.stream:
        try:
            schema = spark.read.parquet(args.input).schema  # as the files that are there have it
        except AnalysisException:
            schema = HOUSING_SCHEMA
        query = start_scoring(
            read_requests(spark, args.input, schema=schema, files_per_trigger=args.files_per_trigger), scorer, args.output, quarantine, args.checkpoint or f"{args.output.rstrip('/')}_checkpoint",
            args.keep, trigger={"availableNow": True} if args.once else None,
        )
        query.awaitTermination()
        return
    requests = read_table(spark, args.input)
    if requests.isEmpty():
        raise ValueError("no rows to score")
    with cached(validate(requests)) as validated:
        invalid_rows(validated).write.mode("overwrite").parquet(quarantine)
        # an empty table if no row is valid: the scores of an earlier run must not stay
        scorer.score(valid_rows(validated), args.keep, allow_empty=True).write.mode("overwrite").parquet(args.output)


def main(argv=None) -> int:
    return run("score", arguments(argv), score)


if __name__ == "__main__":
    sys.exit(main())
