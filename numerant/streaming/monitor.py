"""Request metrics over event-time windows: throughput, error share, latency quantiles.

The stream forms drop rows that arrive later than the watermark, as Structured Streaming does;
the batch forms see every row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order_stats import grouped_quantiles

# A rate over five minutes, moved on every minute.
WINDOW_SECONDS = 300
SLIDE_SECONDS = 60
LATENCY_QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """The event time as a timestamp; a zone-less one is read in the session time zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df.withColumn(column, F.col(column).cast("timestamp"))
    return df


def _seconds(n: int) -> str:
    return f"{n} seconds"


def _window_counts(df: DataFrame, flags: Mapping[str, Column], by: Sequence[str], ts: str, window: int, slide: int) -> DataFrame:
    """Counts per sliding window.

    In batch, rows are first counted per slide; only those counts are spread over the
    window / slide windows that cover them, not the rows.
    """
    df = event_time(df, ts)
    if df.isStreaming:
        span = F.window(ts, _seconds(window), _seconds(slide))
        out = df.groupBy(span.alias("w"), *by).agg(*[F.sum(c.cast("bigint")).alias(n) for n, c in flags.items()])
        return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *flags)
    if window % slide:
        raise ValueError("the window must be a multiple of the slide")
    second = F.unix_seconds(ts)
    slot = second - F.pmod(second, F.lit(slide))
    counts = df.where(F.col(ts).isNotNull()).groupBy(slot.alias("slot"), *by).agg(*[F.sum(c.cast("bigint")).alias(n) for n, c in flags.items()])
    starts = F.sequence(F.col("slot") - (window - slide), F.col("slot"), F.lit(slide).cast("bigint"))
    spread = counts.withColumn("start", F.explode(starts)).groupBy("start", *by).agg(*[F.sum(n).alias(n) for n in flags])
    return spread.select(
        F.timestamp_seconds("start").alias("window_start"), F.timestamp_seconds(F.col("start") + window).alias("window_end"), *by, *flags
    )


def throughput(
    df: DataFrame, by: Sequence[str] = ("event_type",), ts: str = "ts", window: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS, watermark: str = "10 minutes",
) -> DataFrame:
    """(window_start, window_end, by, requests, per_second)."""
    if df.isStreaming:
        df = event_time(df, ts).withWatermark(ts, watermark)
    counts = _window_counts(df, {"requests": F.lit(1)}, list(by), ts, window, slide)
    return counts.withColumn("per_second", F.col("requests").cast("double") / window)


def error_rate(
    df: DataFrame, is_error: Column | None = None, ts: str = "ts", window: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS, watermark: str = "10 minutes",
) -> DataFrame:
    """(window_start, window_end, errors, requests, error_rate)."""
    is_error = F.col("event_type") == "error" if is_error is None else is_error
    if df.isStreaming:
        df = event_time(df, ts).withWatermark(ts, watermark)
    flag = F.coalesce(is_error, F.lit(False)).cast("int")
    counts = _window_counts(df, {"errors": flag, "requests": F.lit(1)}, [], ts, window, slide)
    return counts.withColumn("error_rate", F.col("errors").cast("double") / F.col("requests"))


def latency_quantiles(
    df: DataFrame, value: str = "value", ts: str = "ts", window: int = WINDOW_SECONDS,
    probs: Mapping[str, float] = LATENCY_QUANTILES, watermark: str = "10 minutes",
) -> DataFrame:
    """(window_start, quantiles) per tumbling window: exact in batch, bounded-error on streams."""
    df = event_time(df, ts)
    span = F.window(ts, _seconds(window))["start"].alias("window_start")
    if df.isStreaming:
        out = df.withWatermark(ts, watermark).groupBy(F.window(ts, _seconds(window)).alias("w"))
        out = out.agg(F.percentile_approx(value, list(probs.values()), 10_000).alias("q"))
        return out.select(F.col("w.start").alias("window_start"), *[F.col("q")[i].alias(n) for i, n in enumerate(probs)])
    return grouped_quantiles(df.select(span, value), ["window_start"], value, probs)
