"""Small configuration and report files, read and written by the driver."""

from __future__ import annotations

import json
import math
import os
from collections.abc import Mapping
from typing import Any

import yaml
from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    """A path and its file system: for paths without a scheme the default one, as for tables and models."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession | None, path: str) -> str:
    """A small text file on any file system Spark knows; without a session, on the local disk."""
    if spark is None:
        with open(path.removeprefix("file://"), encoding="utf-8") as f:
            return f.read()
    target, fs = _file(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(f"no file {path}")
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession | None, path: str, text: str) -> None:
    """Write a small text file; folders on the way are made."""
    if spark is None:
        path = path.removeprefix("file://")
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return
    target, fs = _file(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def native(value: Any) -> Any:
    """Plain Python values all the way down."""
    if isinstance(value, Mapping):
        return {str(k): native(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [native(v) for v in value]
    if hasattr(value, "item") and not isinstance(value, (str, bytes)):
        return value.item()
    return value


def load_config(path: str, spark: SparkSession | None = None) -> dict:
    """A YAML file as a dict; a missing file is an error. One that lies beside the driver comes first."""
    try:
        return yaml.safe_load(read_text(None if os.path.exists(path) else spark, path)) or {}
    except FileNotFoundError:
        raise
    except yaml.YAMLError as e:
        raise ValueError(f"{path} is not valid YAML: {e}") from e


def save_yaml(path: str, value: Mapping, spark: SparkSession | None = None) -> None:
    """Key order is kept."""
    write_text(spark, path, yaml.safe_dump(native(value), default_flow_style=False, sort_keys=False, indent=2, allow_unicode=True))


def save_metrics(path: str, metrics: Mapping[str, float], spark: SparkSession | None = None) -> None:
    clean = {k: (None if isinstance(v, float) and not math.isfinite(v) else v) for k, v in native(metrics).items()}
    write_text(spark, path, json.dumps(clean, indent=2))


def load_metrics(path: str, spark: SparkSession | None = None) -> dict[str, float]:
    return json.loads(read_text(spark, path))
