"""Scoring of a stream of requests, invalid rows to a quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import HOUSING_RULES, HOUSING_SCHEMA, Rule
from ..plans.scoring import Scorer, parted


def read_requests(
    spark: SparkSession, folder: str, fmt: str = "parquet", schema: T.StructType = HOUSING_SCHEMA, files_per_trigger: int | None = None, **options
) -> DataFrame:
    """Requests arriving as files; ``files_per_trigger`` bounds a micro-batch, a backlog is then worked off in parts."""
    if files_per_trigger:
        options["maxFilesPerTrigger"] = files_per_trigger
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def score_stream(requests: DataFrame, scorer: Scorer, passthrough: Sequence[str] = (), rules: Sequence[Rule] = HOUSING_RULES) -> DataFrame:
    """The scored valid rows of a stream: a stateless plan with fitted constants."""
    return scorer.score(parted(requests, rules)[0], passthrough)


def start_scoring(
    requests: DataFrame, scorer: Scorer, scored_path: str, quarantine_path: str, checkpoint: str,
    passthrough: Sequence[str] = (), rules: Sequence[Rule] = HOUSING_RULES, trigger: dict | None = None,
) -> StreamingQuery:
    """Score valid rows to one table and write invalid ones, with their reasons, to another.

    Every micro-batch owns a folder ``batch_id=n`` that a replay overwrites, so a batch retried
    after a failure is not written twice. Both parts are projections of the batch, each written in
    one pass without probing; a part without rows is an empty table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        valid, invalid = parted(batch, rules)
        scored = scorer.score(valid, passthrough, allow_empty=True)
        scored.write.mode("overwrite").parquet(f"{scored_path}/batch_id={batch_id}")
        invalid.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "15 seconds"})).start()
