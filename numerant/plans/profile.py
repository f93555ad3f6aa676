"""Profile of a table and the configuration skeleton it suggests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..operators.stats import (
    columns_by_missing, correlations, describe, duplicate_rows, histogram, iqr_bounds, moments, null_counts,
    outlier_counts, quartile_profile, quartiles,
)
from ..session import cached


@dataclass
class Profile:
    """Tables of a profile. Each is small: rows per column, per bin or per pair of columns."""

    nulls: DataFrame
    missing: DataFrame
    duplicates: DataFrame
    describe: DataFrame
    quartiles: DataFrame
    outliers: DataFrame | None
    histogram: DataFrame
    correlations: DataFrame
    config: dict


def empty_config() -> dict:
    """The skeleton with its keys in the order they are written."""
    return {
        "feature_processing": {
            "handling_na": {"mean": [], "median": [], "most_frequent": [], "no_action": []},
            "handling_outliers": {"remove": [], "log_transform": [], "capping_iqr": [], "capping_winsor": [], "no_action": []},
            "handling_correlated_features": {"remove": [], "no_action": []},
            "scaler": "RobustScaler",
        },
        "feature_engineering": {"domain_features": True},
    }


def suggested_config(
    df: DataFrame, median: Sequence[str] = (), most_frequent: Sequence[str] = (), mean: Sequence[str] = (),
    complete: Sequence[str] | None = None,
) -> dict:
    """Complete columns go to 'no_action'; what to do with the others is the caller's decision.

    The rest of the skeleton keeps every column as it is.
    """
    config = empty_config()
    if complete is None:
        _, complete = columns_by_missing(df)
    na = config["feature_processing"]["handling_na"]
    na["mean"], na["median"], na["most_frequent"] = list(mean), list(median), list(most_frequent)
    na["no_action"] = [c for c in df.columns if c in set(complete)]
    config["feature_processing"]["handling_outliers"]["no_action"] = list(df.columns)
    config["feature_processing"]["handling_correlated_features"]["no_action"] = list(df.columns)
    return config


def profile(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30, cache: bool = True) -> Profile:
    columns = list(columns or numeric_columns(df))
    spark = df.sparkSession

    def kept(table: DataFrame) -> DataFrame:
        return spark.createDataFrame(table.collect(), table.schema)  # a few rows per column

    with cached(df, cache) as data:
        nulls, marks, basic = kept(null_counts(data)), quartiles(data, columns), moments(data, columns)
        counted = {c: b for c, b in iqr_bounds(data, columns, marks=marks).items() if b["lower"] is not None}
        return Profile(
            nulls=nulls,
            missing=nulls.where("nulls > 0").orderBy(F.desc("share"), "column"),
            duplicates=kept(duplicate_rows(data)),
            describe=describe(data, columns, marks=marks, basic=basic),
            quartiles=quartile_profile(data, columns, marks),
            outliers=kept(outlier_counts(data, counted)) if counted else None,
            histogram=kept(histogram(data, columns, bins, basic)),
            correlations=kept(correlations(data, columns, basic=basic)),
            config=suggested_config(data, complete=[r["column"] for r in nulls.collect() if r["nulls"] == 0]),
        )
