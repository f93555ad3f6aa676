"""Sums over the rows where both columns of a pair are present, for all pairs in one scan.

With values X (0 where missing) and presence M (1 or 0), the six sums of all pairs are six matrix products: M'M, X'M, (X^2)'M, M'X,
M'(X^2) and X'X. Each task adds up the products of its batches and hands on one row of sums per column; these are
merged per column and group of tasks, then per column. Plan and generated code do not grow with the columns. A task
holds matrices of at most ``cells`` pairs: wider tables take a scan per block of columns.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions that run on executors travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS = ("n", "sx", "sxx", "sy", "syy", "sxy")
CELLS = 2 << 20  # pairs in the matrices of a task: six times 16 MB
VALUES = 1 << 20  # values multiplied at once
GROUPS = 64  # of tasks, merged before all meet
SCHEMA = "i int, part int, sums array<double>"


def _batch(keys: Sequence[tuple[int, int]], sums: Sequence[np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array(sums, pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(columns, names=["i", "part", "sums"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for i, part, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            held[i, part] = held.get((i, part), 0.0) + row.values.to_numpy()
    yield _batch(list(held), list(held.values()))


def pair_sums(df: DataFrame, left: Sequence[Column], right: Sequence[Column], cells: int | None = None) -> DataFrame:
    """(i, j, n, sx, sxx, sy, syy, sxy) for each pair of ``left[i]`` and ``right[j]``: finite doubles or NULL.

    Pairs without a row where both are present have n 0; a frame without rows gives none.
    """
    p, block = len(right), max(1, (CELLS if cells is None else cells) // max(len(right), 1))

    def of(start: int) -> DataFrame:
        q = min(block, len(left) - start)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            rows = max(1, VALUES // (p + q))
            for whole in batches:
                for at in range(0, whole.num_rows, rows):
                    batch = whole.slice(at, rows)
                    x, y = (batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for k in (0, 1))
                    mx, my = (~np.isnan(v) for v in (x, y))
                    x, y, mx, my = np.where(mx, x, 0.0), np.where(my, y, 0.0), mx.astype(float), my.astype(float)
                    some = np.hstack([mx.T @ my, x.T @ my, (x * x).T @ my, mx.T @ y, mx.T @ (y * y), x.T @ y])
                    total = some if total is None else np.add(total, some, out=total)
            if total is not None:
                part = TaskContext.get().partitionId() % GROUPS
                for i in range(0, q, 64):  # a few rows a batch
                    yield _batch([(start + k, part) for k in range(i, min(i + 64, q))], list(total[i : i + 64]))

        arrays = df.select(F.array(*left[start : start + q]).alias("x"), F.array(*right).alias("y"))
        return arrays.mapInArrow(add, SCHEMA)

    parts = of(0)
    for start in range(block, len(left), block):
        parts = parts.union(of(start))
    merged = parts.repartition("i", "part").mapInArrow(_merge, SCHEMA).select("i", F.lit(0).alias("part"), "sums").repartition("i").mapInArrow(_merge, SCHEMA)
    each = merged.select("i", "sums", F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("j"))
    return each.select("i", "j", *(F.get("sums", F.col("j") + k * p).alias(s) for k, s in enumerate(SUMS)))
