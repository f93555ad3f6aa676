"""Cross-validation of linear models in one scan: Gram matrices per fold, fold models by subtraction.

With z = (1, features, label), all that least squares needs of a set of rows is the sum of z z'. One pass adds these up for each fold
(per task, then per fold and matrix row, so no task holds more than rows of one matrix). The rows outside a fold have the sum of the
other folds' matrices, so the models of all folds and of any number of penalties come from that one pass: ridge by its closed form, elastic net by
coordinate descent on the matrix. Squared errors of a fold follow from its own matrix; absolute ones take one more pass for all models together.

Values are taken from a pivot row, so that large means cost no digits. What reaches the driver is folds times columns squared.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import EPSILON

# Functions that run on executors travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Penalty:
    """min sum e^2 / 2 + l1 |w|_1 + l2 |w|^2 / 2, both times the number of rows if ``per_row``."""

    l1: float = 0.0
    l2: float = 0.0
    per_row: bool = False
    intercept: bool = True
    max_iter: int = 10_000


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    intercept: float


@dataclass(frozen=True)
class Grams:
    """Sums of z z' per fold, with features and label taken from ``pivot``."""

    folds: Mapping[int, np.ndarray]
    pivot: np.ndarray

    def without(self, fold: int) -> np.ndarray:
        return sum((g for f, g in self.folds.items() if f != fold), np.zeros((len(self.pivot) + 1,) * 2))


def _rows(batch: pa.RecordBatch, pivot: np.ndarray) -> np.ndarray:
    x = batch.column(0)
    flat = x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    z = np.column_stack([flat, batch.column(1).to_numpy(zero_copy_only=False)]) - pivot
    return np.column_stack([np.ones(batch.num_rows), z])


def fold_grams(folded: DataFrame, features: str, label: str, fold: str) -> Grams:
    """The matrices of all folds of assembled rows; rows without a label count for none."""
    slim = folded.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold")).where("y is not null")
    first = slim.first()
    if first is None:
        raise ValueError("no rows to train on")
    pivot = np.array([*first["x"], first["y"]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z, of = _rows(batch, pivot), batch.column(2).to_numpy()
            for f in np.unique(of).tolist():
                some = z[of == f]
                sums[f] = sums.get(f, 0.0) + some.T @ some
        for f, g in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(g), pa.int32()), pa.array(range(len(g)), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))], names=["fold", "i", "row"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for f, i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                sums[f, i] = sums.get((f, i), 0.0) + row.values.to_numpy()
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([sums[k] for k in keys], pa.list_(pa.float64()))], names=["fold", "i", "row"])

    schema = "fold int, i int, row array<double>"
    found: dict[int, np.ndarray] = {}
    for r in slim.mapInArrow(add, schema).repartition("fold", "i").mapInArrow(merge, schema).collect():
        found.setdefault(r["fold"], np.zeros((len(pivot) + 1,) * 2))[r["i"]] = r["row"]
    return Grams(found, pivot)


def solve(g: np.ndarray, pivot: np.ndarray, penalty: Penalty) -> Linear:
    """The model of the rows whose sum of z z' is ``g``."""
    n, p = g[0, 0], len(pivot) - 1
    if not n:
        raise ValueError("no rows to train on")
    if penalty.intercept:
        mean = g[0, 1:] / n
        c = g[1:, 1:] - n * np.outer(mean, mean)
    else:  # about zero instead of the pivot
        turn = np.eye(p + 2)
        turn[1:, 0] = pivot
        mean, c = -pivot, (turn @ g @ turn.T)[1:, 1:]
    a, b = c[:p, :p], c[:p, p]
    times = n if penalty.per_row else 1.0
    l1, l2 = penalty.l1 * times, penalty.l2 * times
    if not l1:
        w = np.linalg.lstsq(a + l2 * np.eye(p), b, rcond=None)[0]
    else:
        w = np.zeros(p)
        q = a @ w
        for _ in range(penalty.max_iter):
            most = 0.0
            for j in range(p):
                if a[j, j] + l2 <= 0:
                    continue
                rest = b[j] - q[j] + a[j, j] * w[j]
                new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (a[j, j] + l2)
                if new != w[j]:
                    q += a[:, j] * (new - w[j])
                    most = max(most, abs(new - w[j]) * np.sqrt(a[j, j]))
                    w[j] = new
            if most <= 1e-12 * np.sqrt(max(c[p, p], 1e-300)):
                break
    at = pivot + mean
    return Linear(w, float(at[p] - at[:p] @ w) if penalty.intercept else 0.0)


def _squares(g: np.ndarray, pivot: np.ndarray, model: Linear) -> tuple[float, float]:
    """Sum of squared errors and of squared deviations of the label."""
    p = len(pivot) - 1
    v = np.r_[pivot[p] - pivot[:p] @ model.weights - model.intercept, -model.weights, 1.0]
    return max(float(v @ g @ v), 0.0), max(float(g[-1, -1] - g[0, -1] ** 2 / g[0, 0]), 0.0)


def _absolute(folded: DataFrame, features: str, label: str, fold: str, models: Sequence[Mapping[int, Linear]]) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(penalty, fold): number of rows, sums of absolute and of relative errors on the rows of the fold, in one pass for all models."""
    slim = folded.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold")).where("y is not null")
    width = len(next(iter(models[0].values())).weights)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z, of, out = _rows(batch, np.zeros(width + 1))[:, 1:], batch.column(2).to_numpy(), []
            for f in np.unique(of).tolist():
                some = z[of == f]
                for m, each in enumerate(models):
                    e = np.abs(some[:, -1] - some[:, :-1] @ each[f].weights - each[f].intercept)
                    out.append((m, f, float(len(e)), float(e.sum()), float((e / np.maximum(np.abs(some[:, -1]), EPSILON)).sum())))
            types = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["model", "fold", "n", "e", "r"])

    sums = slim.mapInArrow(add, "model int, fold int, n double, e double, r double").groupBy("model", "fold").agg(F.sum("n").alias("n"), F.sum("e").alias("e"), F.sum("r").alias("r"))
    return {(r["model"], r["fold"]): (r["n"], r["e"], r["r"]) for r in sums.collect()}


def fold_scores(folded: DataFrame, grams: Grams, penalties: Sequence[Penalty], metric: str, features: str, label: str, fold: str) -> list[dict[int, float]]:
    """For each penalty the score (rmse, r2, mae or mape) of each fold's model on the rows of the fold."""
    models = [{f: solve(grams.without(f), grams.pivot, x) for f in grams.folds} for x in penalties]
    if metric in ("mae", "mape"):
        sums = _absolute(folded, features, label, fold, models)
        at = 1 if metric == "mae" else 2
        return [{f: sums[m, f][at] / sums[m, f][0] * (100 if metric == "mape" else 1) for f in each} for m, each in enumerate(models)]
    out = []
    for each in models:
        scores = {}
        for f, model in each.items():
            squares, spread = _squares(grams.folds[f], grams.pivot, model)
            if metric == "rmse":
                scores[f] = float(np.sqrt(squares / grams.folds[f][0, 0]))
            else:
                scores[f] = 1 - squares / spread if spread > 0 else float(squares == 0)
        out.append(scores)
    return out
