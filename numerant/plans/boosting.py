"""Histogram boosting of regression trees with penalties, for one or many models in the same passes.

Rows are packed once into blocks of binned features (``packed``), kept for all passes. A pass adds up, for the tree nodes that
need it, residuals and rows per (model, node, feature, bin) in each task, and then over the tasks per (model, node, feature), in the driver while the sums of all tasks are
``DRIVER_BYTES`` at most; what reaches the driver depends on nodes, features and bins, not on rows. Of two siblings only the smaller one is added up, the other is the parent less it.

With G the sum of (prediction - label) and n the rows of a node, soft(G) = sign(G) max(|G| - alpha, 0), a leaf's weight is
-soft(G) / (n + lambda), and a split gains soft(G_l)^2 / (n_l + lambda) + soft(G_r)^2 / (n_r + lambda) - soft(G)^2 / (n + lambda).

Trees grow ``by_level`` (all leaves that gain, to a depth), ``by_leaf`` (the leaf that gains most, to a number of leaves) or ``symmetric``
(one condition for a whole level). By leaf, a pass splits every leaf that may still be chosen, and the choice is replayed on what is known, so a
tree takes about as many passes as it has levels. The models of all folds of a cross-validation grow side by side in the same passes.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import EPSILON
from ..session import cached, scratch_path

# Functions that run on executors travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REFRESH = 10  # trees after which predictions are written into the blocks
BLOCK_ROWS = 10_000
TASK_CELLS = 200_000  # features of rows that a task of a pass adds up at least
DRIVER_BYTES = 16 << 20  # of sums by task that go to the driver without being added up over the tasks first


@dataclass(frozen=True)
class Boosting:
    """Parameters of a model."""

    growth: str = "by_level"
    rounds: int = 100
    step: float = 0.3
    depth: int = 6
    leaves: int = 31
    alpha: float = 0.0
    lambda_: float = 1.0
    least_rows: int = 1
    subsample: float = 1.0
    columns: float = 1.0
    bins: int = 256
    seed: int = 42


@dataclass
class Tree:
    """Nodes as lists; feature is -1 at a leaf. Rows with bin <= cut go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for values, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            values += [empty, empty]
        return self.left[node], self.right[node]

    def nodes_of(self, x: np.ndarray, cuts: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row of bins (of values, if ``cuts`` are the values at the nodes)."""
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        cut = np.array(self.cut) if cuts is None else cuts
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            here = at[rows]
            at[rows] = np.where(x[rows, feature[here]] <= cut[here], left[here], right[here])
        return at


def bin_edges(assembled: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """The upper edges of all bins but the last, per feature: all values if there are at most ``bins``, else quantiles."""
    cells = assembled.select(F.posexplode(vector_to_array(features)).alias("f", "x"))
    some = [i / bins for i in range(1, bins)]
    found = cells.groupBy("f").agg(F.percentile_approx("x", some, 20 * bins).alias("q"), F.approx_count_distinct("x", 0.01).alias("d")).collect()
    few = [r["f"] for r in found if r["d"] <= 1.05 * bins]
    exact = {r["f"]: r["v"] for r in cells.where(F.col("f").isin(few)).groupBy("f").agg(F.collect_set("x").alias("v")).collect()} if few else {}
    out: list[np.ndarray] = [np.zeros(0)] * len(found)
    for r in found:
        values = np.unique(exact.get(r["f"], []))
        out[r["f"]] = values[:-1] if 0 < len(values) <= bins else np.unique(r["q"])
    return out


def packed(assembled: DataFrame, features: str, label: str, fold: str | None, edges: Sequence[np.ndarray]) -> DataFrame:
    """block, n, x (bins), y, fold, guess (predictions of the models so far, none yet): up to ``BLOCK_ROWS`` rows in each; written."""
    slim = assembled.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                binned = np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)]).astype(np.uint16)
                y, of = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
                arrays = [pa.array([len(y)], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in (binned, y.astype(np.float64), of.astype(np.int32))), pa.array([b""], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["n", "x", "y", "fold", "guess"])

    return _kept(slim.where("y is not null").mapInArrow(pack, _BLOCK))


_BLOCK = "n long, x binary, y binary, fold binary, guess binary"


def _kept(blocks: DataFrame) -> DataFrame:
    path = scratch_path(blocks.sparkSession, "boosting")
    blocks.write.parquet(path)
    return blocks.sparkSession.read.schema(_BLOCK).parquet(path)


class _Growing:
    """A model while it grows: its trees, the one in work, and sums of that one's nodes."""

    def __init__(self, spec: Boosting, without: int | None, start: float, width: int) -> None:
        self.spec, self.without, self.start, self.width = spec, without, start, width
        self.trees: list[Tree] = []
        self.gains = np.zeros(width)

    def begin(self) -> None:
        rng = np.random.default_rng([self.spec.seed, len(self.trees)])
        n = max(1, round(self.spec.columns * self.width))
        self.columns = np.sort(rng.permutation(self.width)[:n])
        self.tree, self.sums, self.best, self.depth = Tree(), {}, {}, {0: 0}
        self.wanted, self.rest, self.done = [0], {}, False  # nodes to add up; sibling -> (parent, node)

    def _soft(self, g: np.ndarray) -> np.ndarray:
        return np.sign(g) * np.maximum(np.abs(g) - self.spec.alpha, 0.0)

    def _score(self, g: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.divide(self._soft(g) ** 2, n + self.spec.lambda_, out=np.zeros_like(g), where=n + self.spec.lambda_ > 0)

    def weigh(self, node: int) -> float:
        g, n = self.sums[node][:, 0].sum(axis=-1)
        return float(-self._soft(np.float64(g)) / (n + self.spec.lambda_)) if n + self.spec.lambda_ > 0 else 0.0

    def gain(self, node: int) -> np.ndarray:
        """Gain of each (feature, cut); minus infinity where it is none."""
        g, n = self.sums[node]
        left_g, left_n = g.cumsum(axis=1), n.cumsum(axis=1)
        all_g, all_n = left_g[:, -1:], left_n[:, -1:]
        out = self._score(left_g, left_n) + self._score(all_g - left_g, all_n - left_n) - self._score(all_g, all_n)
        least = max(self.spec.least_rows, 1)
        out[(left_n < least) | (all_n - left_n < least)] = -np.inf
        closed = np.ones(self.width, bool)
        closed[self.columns] = False
        out[closed] = -np.inf
        out[out <= 1e-12 * (1 + self._score(all_g, all_n))] = -np.inf
        return out

    def take(self, found: Mapping[int, np.ndarray]) -> None:
        """Sums of the wanted nodes (a node without rows is not in ``found``), and with them those of their siblings."""
        for node in self.wanted:
            self.sums[node] = found.get(node, np.zeros_like(next(iter([*self.sums.values(), *found.values()]))))
        for node, (parent, other) in self.rest.items():
            self.sums[node] = self.sums[parent] - self.sums[other]
        for node in [*self.wanted, *self.rest]:
            gain = self.gain(node)
            at = int(np.argmax(gain))  # of equal gains the first feature and cut
            self.best[node] = (float(gain.flat[at]), *divmod(at, gain.shape[1]))
        self.wanted, self.rest = [], {}
        {"by_level": self._level, "by_leaf": self._leaf, "symmetric": self._symmetric}[self.spec.growth]()
        self.done = not self.wanted

    def _grow(self, node: int, feature: int, cut: int) -> None:
        left, right = self.tree.split(node, feature, cut)
        self.depth[left] = self.depth[right] = self.depth[node] + 1
        n = self.sums[node][1][feature]
        small, large = (left, right) if 2 * n[: cut + 1].sum() <= n.sum() else (right, left)
        self.wanted.append(small)
        self.rest[large] = (node, small)

    def _open(self) -> list[int]:
        return [v for v in self.best if self.tree.feature[v] < 0 and self.depth[v] < self.spec.depth]

    def _level(self) -> None:
        for node in self._open():
            gain, feature, cut = self.best[node]
            if gain > 0:
                self._grow(node, feature, cut)

    def _symmetric(self) -> None:
        nodes = self._open()
        if nodes:
            # Nodes that a condition does not divide lose nothing by it.
            total = sum(np.where(np.isfinite(g), g, 0.0) for g in map(self.gain, nodes))
            at = int(np.argmax(total))
            if total.flat[at] > 0:
                for node in nodes:
                    self._grow(node, *divmod(at, total.shape[1]))

    def _chosen(self) -> tuple[set[int], list[int]]:
        """The leaves that are split, by largest gain first, as far as sums are known; and those to look below of."""
        heap, chosen, unknown, leaves = [(-self.best[0][0], 0)], set(), [], 1
        while heap and leaves < self.spec.leaves:
            gain, node = heapq.heappop(heap)
            if not -gain > 0 or self.depth[node] >= self.spec.depth:
                continue
            chosen.add(node)
            leaves += 1
            if self.tree.feature[node] < 0:
                unknown.append(node)
            else:
                for child in (self.tree.left[node], self.tree.right[node]):
                    heapq.heappush(heap, (-self.best[child][0], child))
        return chosen, unknown

    def _leaf(self) -> None:
        for node in self._chosen()[1]:
            self._grow(node, *self.best[node][1:])

    def finish(self) -> None:
        """Close the tree: cut what is not chosen, give leaves their weights."""
        keep = self._chosen()[0] if self.spec.growth == "by_leaf" else {i for i, f in enumerate(self.tree.feature) if f >= 0}
        old, new = self.tree, Tree()
        stack = [(0, 0)]
        while stack:
            a, b = stack.pop()
            if a in keep:
                # With a symmetric condition a node may be divided at no gain of its own.
                self.gains[old.feature[a]] += max(float(self.gain(a)[old.feature[a], old.cut[a]]), 0.0)
                left, right = new.split(b, old.feature[a], old.cut[a])
                stack += [(old.left[a], left), (old.right[a], right)]
            else:
                new.value[b] = self.spec.step * self.weigh(a)
        self.trees.append(new)


def _sampled(spec: Boosting, round_: int, block: pa.Buffer, n: int) -> np.ndarray:
    if spec.subsample >= 1:
        return np.ones(n, bool)
    import zlib

    return np.random.default_rng([spec.seed, round_, zlib.crc32(block)]).random(n) < spec.subsample


def grown(blocks: DataFrame, specs: Sequence[tuple[Boosting, int | None]], width: int, bins: int) -> list[_Growing]:
    """Models on the rows of ``blocks`` (all, or all outside of a fold), grown side by side."""

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, of in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                y, of = np.frombuffer(y), np.frombuffer(of, np.int32)
                folds, at = np.unique(of, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(folds), pa.array(np.bincount(at)), pa.array(np.bincount(at, y))], names=["fold", "n", "s"])

    per = blocks.mapInArrow(stats, "fold int, n long, s double").groupBy("fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    models = []
    for spec, without in specs:
        n = sum(r["n"] for r in per if r["fold"] != without)
        if not n:
            raise ValueError("no rows to train on")
        models.append(_Growing(spec, without, sum(r["s"] for r in per if r["fold"] != without) / n, width))
    tasks = max(1, min(blocks.rdd.getNumPartitions(), sum(r["n"] for r in per) * width * len(models) // TASK_CELLS))
    written = 0
    for round_ in range(max(m.spec.rounds for m in models)):
        busy = [i for i, m in enumerate(models) if round_ < m.spec.rounds]
        for i in busy:
            models[i].begin()
        while open_ := [i for i in busy if not models[i].done]:
            size = 16 * width * bins * sum(len(models[i].wanted) for i in open_)  # of one task's sums at most
            found = _pass(blocks.coalesce(tasks), [(i, models[i]) for i in open_], written, round_, bins, len(models), tasks == 1 or tasks * size <= DRIVER_BYTES)
            for i in open_:
                models[i].take(found.get(i, {}))
        for i in busy:
            models[i].finish()
        if round_ + 1 - written >= REFRESH and round_ + 1 < max(m.spec.rounds for m in models):
            before, blocks = blocks, _refreshed(blocks, models, written).persist()
            before.unpersist()
            written = round_ + 1
    blocks.unpersist()
    return models


def _guesses(raw: bytes, n: int, models: int) -> np.ndarray:
    return np.frombuffer(raw).reshape(models, n) if raw else np.zeros((models, n))


def _refreshed(blocks: DataFrame, models: Sequence[_Growing], written: int) -> DataFrame:
    """``blocks`` with the trees since ``written`` in their predictions."""
    trees = [m.trees[written:] for m in models]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, x, guess in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist()):
                x = np.frombuffer(x, np.uint16).reshape(n, -1)
                out.append((_guesses(guess, n, len(trees)) + [sum((np.array(t.value)[t.nodes_of(x)] for t in each), np.zeros(n)) for each in trees]).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary())], names=batch.schema.names)

    return _kept(blocks.mapInArrow(add, _BLOCK))


def _pass(blocks: DataFrame, open_: Sequence[tuple[int, _Growing]], written: int, round_: int, bins: int, models: int, few: bool) -> dict[int, dict[int, np.ndarray]]:
    """Sums of residuals and rows per (feature, bin) for the wanted nodes of each model; ``few``: the sums of all tasks go to the driver as they are."""
    work = [(i, m.spec, m.without, m.start, m.trees[written:], m.tree, list(m.wanted)) for i, m in open_]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, raw, y, of, guess in zip(*(c.to_pylist() for c in batch.columns)):
                x, y, of = np.frombuffer(raw, np.uint16).reshape(n, -1), np.frombuffer(y), np.frombuffer(of, np.int32)
                before = _guesses(guess, n, models)
                for i, spec, without, start, trees, tree, wanted in work:
                    slot = np.full(len(tree.feature), -1)
                    slot[wanted] = np.arange(len(wanted))
                    at = slot[tree.nodes_of(x)]
                    use = np.flatnonzero((at >= 0) & (of != (-2 if without is None else without)) & _sampled(spec, round_, raw, n))
                    some = x[use]
                    g = start + before[i][use] + sum((np.array(t.value)[t.nodes_of(some)] for t in trees), np.zeros(len(use))) - y[use]
                    total = sums.setdefault(i, np.zeros((len(wanted), x.shape[1], 2, bins)))
                    for f in range(x.shape[1]):
                        cell = at[use] * bins + some[:, f]
                        total[:, f, 0] += np.bincount(cell, g, len(wanted) * bins).reshape(-1, bins)
                        total[:, f, 1] += np.bincount(cell, minlength=len(wanted) * bins).reshape(-1, bins)
        rows = [(i, wanted[s], f, total[s, f].ravel()) for i, *_, wanted in work if (total := sums.get(i)) is not None for s in range(len(wanted)) for f in range(total.shape[1])]
        for start in range(0, len(rows), 2_000):
            yield _sum_rows(rows[start : start + 2_000])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for i, node, f, v in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3)):
                key = (i, node, f)
                sums[key] = sums.get(key, 0.0) + v.values.to_numpy()
        yield _sum_rows([(*k, v) for k, v in sums.items()])

    schema = "model int, node int, feature int, sums array<double>"
    sums = blocks.mapInArrow(add, schema)
    merged = (sums if few else sums.repartition("model", "node", "feature").mapInArrow(merge, schema)).toArrow()
    out: dict[int, dict[int, np.ndarray]] = {}
    widths = {i: m.width for i, m in open_}
    for i, node, f, v in zip(*(merged.column(c).to_pylist() for c in range(3)), merged.column(3)):
        out.setdefault(i, {}).setdefault(node, np.zeros((2, widths[i], bins)))[:, f] += v.values.to_numpy().reshape(2, bins)
    return out


def _sum_rows(rows: list[tuple]) -> pa.RecordBatch:
    ints = [pa.array([r[c] for r in rows], pa.int32()) for c in range(3)]
    return pa.RecordBatch.from_arrays([*ints, pa.array([r[3] for r in rows], pa.list_(pa.float64()))], names=["model", "node", "feature", "sums"])


class HistogramBoostingModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees with values as cuts; predicts in batches, and saves as one parameter."""

    state = Param(Params._dummy(), "state", "start, importances and trees", typeConverter=TypeConverters.toString)
    columns = Param(Params._dummy(), "columns", "features and prediction column", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, state: str | None = None, columns: list[str] | None = None) -> None:
        super().__init__()
        if state is not None:
            self._set(state=state, columns=columns)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 (the name that MLlib's models have)
        return Vectors.dense(json.loads(self.getOrDefault(self.state))["importances"])

    @property
    def trees(self) -> list[dict[str, list]]:
        return json.loads(self.getOrDefault(self.state))["trees"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = json.loads(self.getOrDefault(self.state))
        features, prediction = self.getOrDefault(self.columns)
        trees = [(Tree(t["feature"], [], t["left"], t["right"], t["value"]), np.array(t["cut"], np.float64)) for t in held["trees"]]

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            rows = np.stack(x.to_numpy())
            return pd.Series(held["start"] + sum((np.array(t.value)[t.nodes_of(rows, cuts)] for t, cuts in trees), np.zeros(len(rows))))

        return dataset.withColumn(prediction, predict(vector_to_array(features)))


def as_model(grown_: _Growing, edges: Sequence[np.ndarray], features: str, prediction: str) -> HistogramBoostingModel:
    trees = []
    for t in grown_.trees:
        cuts = [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]
        trees.append({"feature": t.feature, "cut": cuts, "left": t.left, "right": t.right, "value": t.value})
    share = grown_.gains / grown_.gains.sum() if grown_.gains.sum() > 0 else grown_.gains
    return HistogramBoostingModel(state=json.dumps({"start": grown_.start, "importances": share.tolist(), "trees": trees}), columns=[features, prediction])


class HistogramBoosting:
    """Fits one model, or those of all folds side by side."""

    def __init__(self, spec: Boosting, features: str, label: str, prediction: str) -> None:
        self.spec, self.features, self.label, self.prediction = spec, features, label, prediction

    def fit(self, assembled: DataFrame) -> HistogramBoostingModel:
        edges = bin_edges(assembled, self.features, self.spec.bins)
        with cached(packed(assembled, self.features, self.label, None, edges)) as blocks:
            found = grown(blocks, [(self.spec, None)], len(edges), self.spec.bins)[0]
        return as_model(found, edges, self.features, self.prediction)

    def fold_scores(self, folded: DataFrame, fold: str, folds: int, metric: str) -> dict[int, float]:
        """The score of each fold's model on the rows of the fold. Bins are those of all rows: labels have no part in them."""
        edges = bin_edges(folded, self.features, self.spec.bins)
        with cached(packed(folded, self.features, self.label, fold, edges)) as blocks:
            models = grown(blocks, [(replace(self.spec), f) for f in range(folds)], len(edges), self.spec.bins)
            return _scores(blocks, models, metric)


def _scores(blocks: DataFrame, models: Sequence[_Growing], metric: str) -> dict[int, float]:
    parts = {m.without: (m.start, m.trees) for m in models}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, x, y, of in zip(*(c.to_pylist() for c in batch.columns[:4])):
                x, y, of = np.frombuffer(x, np.uint16).reshape(n, -1), np.frombuffer(y), np.frombuffer(of, np.int32)
                for f in np.unique(of).tolist():
                    start, trees = parts[f]
                    some, z = x[of == f], y[of == f]
                    e = z - start - sum((np.array(t.value)[t.nodes_of(some)] for t in trees), np.zeros(len(z)))
                    d = z - start
                    rows.append((float(f), float(len(e)), (e * e).sum(), np.abs(e).sum(), (np.abs(e) / np.maximum(np.abs(z), EPSILON)).sum(), d.sum(), (d * d).sum()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.float64()) for c in range(7)], names=["f", "n", "ee", "ae", "re", "d", "dd"])

    sums = blocks.mapInArrow(add, "f double, n double, ee double, ae double, re double, d double, dd double").groupBy("f").agg(*(F.sum(c).alias(c) for c in ("n", "ee", "ae", "re", "d", "dd"))).collect()
    out = {}
    for r in sums:
        spread = r["dd"] - r["d"] ** 2 / r["n"]
        r2 = 1 - r["ee"] / spread if spread > 0 else float(r["ee"] == 0)
        out[int(r["f"])] = {"rmse": (r["ee"] / r["n"]) ** 0.5, "mae": r["ae"] / r["n"], "mape": 100 * r["re"] / r["n"], "r2": r2}[metric]
    return out


def parameters(params: dict[str, Any], growth: str, depth_key: str, **defaults: Any) -> tuple[Boosting, dict[str, Any]]:
    """The parameters of a configured slot, and those that have no equivalent."""
    rest = dict(params)
    take = lambda names, default: next((rest.pop(n) for n in names if n in rest), default)
    base = Boosting(growth=growth, **defaults)
    limit = take([depth_key] if depth_key != "num_leaves" else [], None)
    other = take(["max_depth"], None)
    depth = int(limit if limit is not None else base.depth)
    if other is not None and int(other) > 0:
        depth = min(depth, int(other)) if limit is not None else int(other)
    spec = replace(
        base, depth=depth, leaves=int(take(["num_leaves", "max_leaves"], base.leaves)), rounds=int(take(["n_estimators", "iterations", "num_boost_round"], base.rounds)),
        step=float(take(["learning_rate", "eta"], base.step)), alpha=float(take(["reg_alpha", "lambda_l1"], base.alpha)),
        lambda_=float(take(["reg_lambda", "lambda_l2", "l2_leaf_reg"], base.lambda_)), least_rows=int(take(["min_child_samples", "min_child_weight", "min_data_in_leaf"], base.least_rows)),
        subsample=float(take(["subsample", "bagging_fraction"], base.subsample)), columns=float(take(["colsample_bytree", "feature_fraction", "rsm"], base.columns)),
        bins=int(take(["max_bins", "max_bin", "border_count"], base.bins)), seed=int(take(["random_state", "random_seed", "seed"], base.seed)),
    )
    return spec, rest
