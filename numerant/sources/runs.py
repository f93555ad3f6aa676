"""The runs table: one appended row per trained model or search trial."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .documents import native

SCHEMA = (
    "run_id string, parent_run_id string, run_name string, model_name string, model_class string, "
    "model_module string, params map<string,string>, metrics map<string,double>, n_features int, "
    "n_train bigint, n_test bigint, model_path string, trained_at timestamp"
)


class RunLog:
    """Rows of runs below ``folder``; a missing table reads as empty."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.path = f"{folder.rstrip('/')}/runs"

    def append(
        self, run_name: str, model_name: str, params: Mapping, metrics: Mapping[str, float | None], *,
        model_class: str | None = None, model_module: str | None = None, parent_run_id: str | None = None,
        n_features: int | None = None, n_train: int | None = None, n_test: int | None = None,
        model_path: str | None = None, run_id: str | None = None,
    ) -> str:
        run_id = run_id or uuid.uuid4().hex
        texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in native(params).items()}
        values = {k: float(v) for k, v in native(metrics).items() if v is not None}
        row = (
            run_id, parent_run_id, run_name, model_name, model_class, model_module, texts, values,
            n_features, n_train, n_test, model_path, dt.datetime.now(dt.timezone.utc),
        )
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return run_id

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
                return self.spark.createDataFrame([], SCHEMA)
            raise
