"""Broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import quoted

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _bytes(field: T.StructField):
    """Bytes of a cell as it is held in memory, a little more rather than less."""
    column = quoted(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 24
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 64
    return F.lit(16)


def broadcast_if_small(df: DataFrame, limit: int | None = None, size: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it holds at most ``limit`` rows of ``size`` bytes in all, else as it is.

    Counting stops at the limit. Meant for narrow tables of keys and bounds that are cheap to
    compute or already written; without the hint Spark shuffles and splits skewed partitions.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    size = BROADCAST_BYTES if size is None else size
    cells = [_bytes(f).cast("long") for f in df.schema.fields]
    seen = df.limit(limit + 1).select(sum(cells[1:], cells[0]).alias("b")).agg(F.count("*").alias("n"), F.sum("b").alias("b")).first()
    return F.broadcast(df) if seen["n"] <= limit and (seen["b"] or 0) <= size else df
