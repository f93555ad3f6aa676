"""Row-level expressions shared by stages, metrics and queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.NumericType, T.BooleanType)


def quoted(name: str) -> Column:
    """A column by its literal name; generated names hold blanks, carets and dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in floating columns: the one rule for missing values."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floating:
        return df
    return df.withColumns({c: F.when(~F.isnan(quoted(c)), quoted(c)) for c in floating})


def as_double(name: str) -> Column:
    """A feature as a double with NaN read as NULL."""
    return F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double"))


def safe_div(num: Column, den: Column, mode: str = "null") -> Column:
    """Division without the ANSI error.

    ``null``: a zero denominator gives NULL, what MLlib and the later stages want.
    ``ieee``: it gives infinity or NaN, as arrays of doubles do.
    ``zero``: it gives 0, for models that take no missing values.
    """
    if mode == "null":
        return F.try_divide(num, den)
    if mode == "zero":
        return F.when(den == 0, F.when(num.isNotNull(), 0.0)).otherwise(F.try_divide(num, den))
    if mode == "ieee":
        at_zero = (
            F.when(num > 0, F.lit(float("inf"))).when(num < 0, F.lit(float("-inf"))).when(num.isNotNull(), F.lit(float("nan")))
        )
        return F.when(den == 0, at_zero).otherwise(F.try_divide(num, den))
    raise ValueError(f"unknown division mode '{mode}'")


def log_magnitude(value: Column) -> Column:
    """log(1 + |x|): what the log treatment amounts to with and without negative values."""
    return F.log1p(F.abs(value))


def clip(value: Column, lower: float, upper: float) -> Column:
    """Clip to constant bounds; NULL stays NULL."""
    return F.when(value < lower, F.lit(lower)).when(value > upper, F.lit(upper)).otherwise(value)


def is_outlier(value: Column, lower: float, upper: float) -> Column:
    """True outside the bounds; NULL is no outlier."""
    return F.coalesce((value < lower) | (value > upper), F.lit(False))


def affine(value: Column, center: float, scale: float) -> Column:
    """(x - center) / scale with a scale that is never zero."""
    return (value - F.lit(center)) / F.lit(scale)


def residual(actual: str, predicted: str) -> Column:
    return as_double(actual) - as_double(predicted)


def absolute_residual(actual: str, predicted: str) -> Column:
    return F.abs(residual(actual, predicted))


def percentage_residual(actual: str, predicted: str) -> Column:
    """|e| / |y| * 100, NULL where y is zero."""
    return F.try_divide(absolute_residual(actual, predicted), F.abs(as_double(actual))) * 100


def key_hash_words(seed: int, key: Sequence[str]) -> list[Column]:
    """md5(seed-key) as three bigints whose order is the order of the hex text."""
    text = F.concat_ws("-", F.lit(str(seed)), *[quoted(c).cast("string") for c in key])
    digest = F.md5(text)

    def word(start: int, length: int) -> Column:
        return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")

    return [word(1, 15), word(16, 15), word(31, 2)]
