"""Queries on streams: scoring with quarantine, request metrics in batch and streaming form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order_stats import grouped_quantiles
from ..plans.scoring import invalid_rows, validate
from ..session import scratch_path
from ..streaming.monitor import LATENCY_QUANTILES, error_rate, latency_quantiles, throughput
from ..streaming.scoring import start_scoring
from .modeling import SCORE_CTES, fitted_scorer
from .registry import H_CTE, housing, housing_of, query, r, rounded, scan, sql_r, table

ONCE = {"availableNow": True}


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    schema = scan(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _scored_stream(spark, sf_dir) -> tuple[str, str]:
    """Run the scoring stream over all of lineitem; paths of scores and quarantine."""
    base = scratch_path(spark, "stream")
    scorer = fitted_scorer(housing(spark, sf_dir))
    requests = housing_of(stream_of(spark, sf_dir, "lineitem"), scan(spark, sf_dir, "part"))
    paths = f"{base}/scored", f"{base}/quarantine"
    start_scoring(requests, scorer, *paths, f"{base}/checkpoint", ["MEDV"], trigger=ONCE).awaitTermination()
    return paths


_COMPLETE = "CRIM IS NOT NULL AND CHAS IS NOT NULL AND AGE IS NOT NULL AND LSTAT IS NOT NULL"


@query("str1_stream_scoring", f"WITH {SCORE_CTES} SELECT {sql_r('y')} AS MEDV, {sql_r('w * z + b')} AS predicted_price, 'ridge' AS model_name FROM z, coef WHERE {_COMPLETE}")
def stream_scoring(spark, sf_dir):
    scored, _ = _scored_stream(spark, sf_dir)
    return rounded(spark.read.parquet(scored).select("MEDV", "predicted_price", "model_name"))


@query(
    "str2_stream_quarantine",
    f"WITH {H_CTE}, v AS (SELECT MEDV, concat_ws('; ', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}: missing' END" for c in ("CRIM", "CHAS", "AGE", "LSTAT"))
    + f") AS violations FROM h) SELECT {sql_r('MEDV')} AS MEDV, violations FROM v WHERE violations <> ''",
)
def stream_quarantine(spark, sf_dir):
    _, quarantine = _scored_stream(spark, sf_dir)
    return rounded(spark.read.parquet(quarantine).select("MEDV", F.array_join("violations", "; ").alias("violations")))


@query("str2_batch_quarantine", f"WITH {H_CTE} SELECT count(*) AS \"rows\" FROM h WHERE NOT ({_COMPLETE})")
def batch_quarantine(spark, sf_dir):
    return invalid_rows(validate(housing(spark, sf_dir))).agg(F.count(F.lit(1)).alias("rows"))


_SLIDES = (
    "s AS (SELECT floor(epoch(ts) / 60)::BIGINT * 60 AS slot, event_type FROM events), "
    "w AS (SELECT slot - 60 * k AS start, event_type FROM s, range(0, 5) AS g(k))"
)
_START = "to_timestamp(start)::TIMESTAMP"


@query(
    "str3_throughput_5m",
    f"WITH {_SLIDES} SELECT strftime({_START}, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS requests, {sql_r('count(*)::double / 300')} AS per_second FROM w GROUP BY start, event_type",
)
def throughput_5m(spark, sf_dir):
    return rounded(_text_start(throughput(table(spark, sf_dir, "events"))).select("window_start", "event_type", "requests", "per_second"))


def _text_start(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "str4_error_rate_5m",
    f"WITH {_SLIDES} SELECT strftime({_START}, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (event_type = 'error') AS errors, count(*) AS requests, "
    f"{sql_r('(count(*) FILTER (event_type = $$error$$))::double / count(*)')} AS error_rate FROM w GROUP BY start",
)
def error_rate_5m(spark, sf_dir):
    return rounded(_text_start(error_rate(table(spark, sf_dir, "events"))).select("window_start", "errors", "requests", "error_rate"))


@query(
    "str5_latency_5m",
    f"SELECT strftime(to_timestamp(start)::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS window_start, {sql_r('quantile_cont(value, 0.5)')} AS p50, {sql_r('quantile_cont(value, 0.95)')} AS p95, "
    f"{sql_r('quantile_cont(value, 0.99)')} AS p99 FROM (SELECT floor(epoch(ts) / 300)::BIGINT * 300 AS start, value FROM events) GROUP BY start",
)
def latency_5m(spark, sf_dir):
    return rounded(_text_start(latency_quantiles(table(spark, sf_dir, "events"))))


@query(
    "str5_latency_by_type",
    f"SELECT event_type, {sql_r('quantile_cont(value, 0.5)')} AS p50, {sql_r('quantile_cont(value, 0.95)')} AS p95, {sql_r('quantile_cont(value, 0.99)')} AS p99 FROM events GROUP BY event_type",
)
def latency_by_type(spark, sf_dir):
    """Few large groups: each is taken apart by brackets instead of held by one task."""
    return rounded(grouped_quantiles(table(spark, sf_dir, "events"), ["event_type"], "value", LATENCY_QUANTILES, limit=1000))


def _run_once(df: DataFrame, mode: str) -> DataFrame:
    """Run a windowed stream over everything present; the last state of its result."""
    spark = df.sparkSession
    base = scratch_path(spark, "metrics")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
    writer.trigger(**ONCE).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query(
    "str3_stream_throughput",
    f"WITH {_SLIDES} SELECT strftime({_START}, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS requests, {sql_r('count(*)::double / 300')} AS per_second FROM w GROUP BY start, event_type",
)
def stream_throughput(spark, sf_dir):
    """The streaming form with the complete result, which no watermark cuts."""
    out = _run_once(throughput(stream_of(spark, sf_dir, "events")), "complete")
    return rounded(_text_start(out).select("window_start", "event_type", "requests", "per_second"))


@query(
    "str4_stream_error_rate",
    f"WITH {_SLIDES} SELECT strftime({_START}, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (event_type = 'error') AS errors, count(*) AS requests, "
    f"{sql_r('(count(*) FILTER (event_type = $$error$$))::double / count(*)')} AS error_rate FROM w GROUP BY start",
)
def stream_error_rate(spark, sf_dir):
    out = _run_once(error_rate(stream_of(spark, sf_dir, "events")), "complete")
    return rounded(_text_start(out).select("window_start", "errors", "requests", "error_rate"))


@query(
    "str5_stream_latency",
    "SELECT strftime(to_timestamp(start)::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests, " + sql_r("max(value)") + " AS slowest "
    "FROM (SELECT floor(epoch(ts) / 300)::BIGINT * 300 AS start, value FROM events) GROUP BY start",
)
def stream_latency(spark, sf_dir):
    """Windows of the streaming form; p100 is exact in the sketch, the count comes from the batch side."""
    events = stream_of(spark, sf_dir, "events")
    out = _text_start(_run_once(latency_quantiles(events, probs={"slowest": 1.0}), "complete"))
    counts = _text_start(throughput(table(spark, sf_dir, "events"), by=(), slide=300)).select("window_start", "requests")
    return out.join(counts, "window_start").select("window_start", "requests", r("slowest").alias("slowest"))
