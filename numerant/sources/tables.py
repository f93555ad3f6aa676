"""Table scans and sinks: CSV and Parquet, split pairs, processed pairs."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import missing_to_null, quoted
from ..session import exists, remove_path, spread
from .records import opens, read_records

log = logging.getLogger(__name__)

ROW_ID = "_row_id"

# Cell texts of a CSV that mean "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
NUMBER = r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*+$"
INTEGER = r"^\s*+[+-]?+\d{1,18}+\s*+$"


def _format_of(path: str) -> str:
    return "csv" if path.rstrip("/").lower().endswith((".csv", ".csv.gz", ".txt")) else "parquet"


def _cell(name: str) -> Column:
    text = quoted(name)
    return F.when(~F.trim(text).isin(*NA_TOKENS), text)


def _kind(name: str) -> Column:
    """What a cell is: 0 missing, 1 an integer, 2 another number, 3 a text. A cell with a point is not tried as an integer."""
    text = quoted(name)
    number = F.when(~F.contains(text, F.lit(".")) & text.rlike(INTEGER), 1).when(text.rlike(NUMBER), 2).otherwise(3)
    return F.when(text.isNull() | F.trim(text).isin(*NA_TOKENS), 0).otherwise(number)


def _typed_csv(raw: DataFrame, schema: T.StructType | None, bad_cells: str = "raise") -> DataFrame:
    """Text cells to typed columns: NA texts to NULL, numbers to bigint or double.

    With a schema, cells that are neither missing nor of their type are counted (one pass): an error that names
    columns and numbers, or with ``bad_cells='null'`` a warning, and the cells become NULL.
    """
    if bad_cells not in ("raise", "null"):
        raise ValueError(f"unknown bad_cells '{bad_cells}'")
    if schema is not None:
        wanted = {f.name: f.dataType for f in schema}
        cells = {c: _cell(c).try_cast(wanted.get(c, T.StringType())) for c in raw.columns}
        counts = raw.agg(*[F.count_if(_cell(c).isNotNull() & v.isNull()).alias(f"b{i}") for i, (c, v) in enumerate(cells.items())]).first()
        bad = {c: counts[f"b{i}"] for i, c in enumerate(cells) if counts[f"b{i}"]}
        if bad and bad_cells == "raise":
            raise ValueError(f"cells that are not of their column's type: {bad}")
        if bad:
            log.warning("cells that are not of their column's type, read as missing: %s", bad)
        return raw.select(*[v.alias(c) for c, v in cells.items()])
    names = raw.columns
    kinds = raw.select(*[_kind(c).alias(f"k{i}") for i, c in enumerate(names)])
    seen = kinds.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in kinds.columns for f in (F.min, F.max)]).first()
    spans = [(seen[f"min_{k}"], seen[f"max_{k}"] or 0) for k in kinds.columns]
    types = ["bigint" if span == (1, 1) else "double" if span[1] < 3 else "string" for span in spans]
    return raw.select(*[_cell(c).cast(t).alias(c) for c, t in zip(names, types)])


def _breaks_in_cells(spark: SparkSession, path: str) -> bool:
    """Whether a line ends inside quotes: some cell then holds a line break."""
    return not spark.read.text(path, lineSep="\n").where(opens(F.col("value"))).isEmpty()


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool | None = None, bad_cells: str = "raise"
) -> DataFrame:
    """A CSV file or folder with a header, or Parquet. Missing values come out as NULL.

    ``multiline``: cells hold line breaks; the lines are then put together to records first (see ``records``), by as many tasks as
    read the file otherwise. If not given, the lines are looked through for it.
    """
    try:
        if _format_of(path) == "csv":
            whole = _breaks_in_cells(spark, path) if multiline is None else multiline
            raw = read_records(spark, path) if whole else spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"')
            return _typed_csv(raw, schema, bad_cells)
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return missing_to_null(reader.parquet(path))
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise FileNotFoundError(f"no data at {path}") from e
        raise


def load_raw_data(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The raw table; a missing file and a table without rows are errors."""
    df = read_table(spark, path, schema)
    if df.isEmpty():
        raise ValueError(f"the table at {path} holds no rows")
    log.info("read %s: columns %s", path, df.columns)
    return df


def with_row_id(df: DataFrame, column: str = ROW_ID) -> DataFrame:
    """Number the rows in scan order, for tables without a key.

    Write the result before using the number: it is stable in the written table, not across
    recomputations of a shuffled frame.
    """
    return df.withColumn(column, F.monotonically_increasing_id())


def target_last(df: DataFrame, target: str) -> DataFrame:
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    return df.select(*[quoted(c) for c in df.columns if c != target], quoted(target))


def feature_columns(df: DataFrame, target: str, passthrough: Sequence[str] = ()) -> list[str]:
    """All columns but the target and the handed-through ones; the target must exist."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    return [c for c in df.columns if c != target and c not in set(passthrough)]


def save_split_data(
    labelled: DataFrame, folder: str, target: str, column: str = "split", fmt: str = "parquet", suffix: str = ""
) -> None:
    """Write a labelled frame, the target as last column.

    Parquet: one table partitioned by the label, written in one pass. CSV: one folder per label
    with headers, ``train.csv`` and ``test.csv``. What an earlier run left in the other format is removed.
    """
    spark, base = labelled.sparkSession, folder.rstrip("/")
    ordered = target_last(labelled.drop(column), target).columns
    files = {"parquet": [f"{base}/split{suffix}"], "csv": [f"{base}/{part}{suffix}.csv" for part in ("train", "test")]}
    if fmt not in files:
        raise ValueError(f"unknown format '{fmt}'")
    if fmt == "parquet":
        out = labelled.select(*[quoted(c) for c in ordered], column)
        out.write.mode("overwrite").partitionBy(column).parquet(files[fmt][0])
    else:
        for part, path in zip(("train", "test"), files[fmt]):
            rows = labelled.where(F.col(column) == part).select(*[quoted(c) for c in ordered])
            rows.write.mode("overwrite").csv(path, header=True)
    for path in files["csv" if fmt == "parquet" else "parquet"]:
        remove_path(spark, path)


def load_split_data(
    spark: SparkSession, folder: str, target: str, suffix: str = "", schema: T.StructType | None = None,
    parts: Sequence[str] = ("train", "test"),
) -> tuple[DataFrame, ...]:
    """The parts written by ``save_split_data`` (either format); all of them must exist, in one format."""
    base = folder.rstrip("/")
    if exists(spark, f"{base}/split{suffix}") and any(exists(spark, f"{base}/{p}{suffix}.csv") for p in parts):
        raise ValueError(f"{folder} holds a split both as Parquet and as CSV; which one is current cannot be told")
    try:
        table = spread(read_table(spark, f"{base}/split{suffix}"))
        found = tuple(table.where(F.col("split") == p).drop("split") for p in parts)
    except FileNotFoundError:
        found = tuple(spread(read_table(spark, f"{base}/{p}{suffix}.csv", schema)) for p in parts)
    for df in found:
        if target not in df.columns:
            raise ValueError(f"target column '{target}' not found in {folder}")
    return found


PROCESSED = "_processed"


def save_processed_data(labelled: DataFrame, folder: str, target: str, column: str = "split", fmt: str = "parquet") -> None:
    save_split_data(labelled, folder, target, column, fmt, PROCESSED)


def load_processed_data(spark: SparkSession, folder: str, target: str, parts: Sequence[str] = ("train", "test")) -> tuple[DataFrame, ...]:
    return load_split_data(spark, folder, target, PROCESSED, parts=parts)
