"""Profile a table and write its tables and the configuration skeleton."""

from __future__ import annotations

import argparse
import sys

from ..plans.profile import profile
from ..sources.documents import save_yaml
from ..sources.tables import load_raw_data
from .common import parser, run


def arguments(argv=None) -> argparse.Namespace:
    p = parser("Profile a table")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--bins", type=int, default=30)
    return p.parse_args(argv)


def write_profile(spark, args) -> None:
    found = profile(load_raw_data(spark, args.input), bins=args.bins)
    base = args.output.rstrip("/")
    for name in ("nulls", "missing", "duplicates", "describe", "quartiles", "outliers", "histogram", "correlations"):
        if getattr(found, name) is None:
            continue
        getattr(found, name).coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")
    save_yaml(f"{base}/preprocessing.yaml", found.config, spark)


def main(argv=None) -> int:
    return run("profile", arguments(argv), write_profile)


if __name__ == "__main__":
    sys.exit(main())
