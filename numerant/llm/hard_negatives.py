"""Hard negatives by slots that the positives' scores cut.

``quantised``: rows with a label, a vector and only finite components take part; each component becomes floor(256 x), so
a score is a whole number. Anchors are met in blocks of at most ``BLOCK_BYTES`` of vectors, a proven bound for what is
sent to the tasks; for each block one pass over the rows computes products of matrices, and no row is shuffled.

``positives``: the first rows of the anchor's label. Each task keeps the best per anchor, and a
window per anchor merges the tasks' lists.

``selected``: an anchor's positive scores, as upper limits, cut the scores into disjoint slots. A candidate with
another label falls into the slot of the smallest limit that is not below it. Combiners in each task keep the top k of
each slot, and the merge of the tasks keeps k of each slot again. The k best below a limit are those of its slot and of the slots under
it, so one descending list of an anchor's slots answers all its overlapping windows: the first k from a
positive's slot on. A candidate under ``share`` of its slot's own limit is in no window (windows of higher
limits begin higher) and is left out from the start. What is shuffled is k rows per anchor, slot and task.

Scores are exact: products run in doubles while every partial sum fits 53 bits, in 64-bit integers while it fits those, and in
Python's integers beyond; a score outside 64 bits is returned as the nearest long.

Defined results: rows without an id are candidates, after those with the same score; rows with the same id are separate rows,
an anchor each if the id is an anchor's, and a row is never its own positive; shorter vectors are filled up with
zeros; a positive with a negative score has an empty window; an empty table or one without anchors gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, forget, numbered, path_of, table, written

K = 5
SHARE = (80, 100)  # a window begins at 80 hundredths of its positive's score
BLOCK_BYTES = 16 << 20
TILE = 1 << 21  # scores held at a time
SCALE = 256
NO_ID = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min


def quantised(rows: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """row, key, label, q (whole numbers as doubles); only the rows that take part."""
    each = numbered(rows.select(F.col(key).cast("long").alias("key"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    q = F.transform("v", lambda x: F.lit(float(SCALE)) * x - F.pmod(F.lit(float(SCALE)) * x, F.lit(1.0)))
    return each.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite).select(F.col(ROW).alias("row"), "key", "label", q.alias("q"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat[ends[0] : ends[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        out[i, : b - a] = flat[a:b]
    return out


class Scores:
    """Exact inner products of a block of anchors with rows."""

    def __init__(self, anchors: np.ndarray) -> None:
        self.anchors, self.top = anchors, float(np.abs(anchors).max(initial=0))
        self.whole = self.top < 2.0**62 and anchors.astype(np.int64)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        bound = self.top * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
        if bound < 2.0**53:
            return (self.anchors @ rows.T).astype(np.int64)
        if bound < 2.0**62:
            return self.whole @ rows.astype(np.int64).T
        exact = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
        return np.clip(exact(self.anchors) @ exact(rows).T, LEAST, NO_ID).astype(np.int64)


class Best:
    """The k best candidates of each cell (an anchor, or one of its slots): highest score, then smallest id, then first row."""

    def __init__(self, cells: int, k: int) -> None:
        self.k, self.least = k, np.full(cells, LEAST)
        self.held = np.zeros((0, 4), np.int64)  # cell, score, id, row

    def add(self, cells: np.ndarray, scores: np.ndarray, open_: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``scores`` and ``open_``: a row per entry of ``cells``, a column per candidate."""
        if scores.shape[1] > self.k:
            part = np.where(open_, scores, LEAST)
            own = np.partition(part, part.shape[1] - self.k, axis=1)[:, -self.k]
            open_ = open_ & (scores >= np.maximum(own, self.least[cells])[:, None])
        i, j = np.nonzero(open_)
        if not len(i):
            return
        new = np.column_stack([cells[i], scores[i, j], ids[j], rows[j]])
        touched = np.zeros(len(self.least), bool)
        touched[new[:, 0]] = True
        again = touched[self.held[:, 0]]
        found = np.concatenate([self.held[again], new])
        found = found[np.lexsort((found[:, 3], found[:, 2], ~found[:, 1], found[:, 0]))]
        first = np.flatnonzero(np.r_[True, found[1:, 0] != found[:-1, 0]])
        place = np.arange(len(found)) - np.repeat(first, np.diff(np.r_[first, len(found)]))
        found = found[place < self.k]
        last = place[place < self.k] == self.k - 1
        self.least[found[last, 0]] = found[last, 1]
        self.held = np.concatenate([self.held[~again], found])


def blocks(spark: SparkSession, anchors: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, DataFrame]]:
    """Width of the vectors and the anchors of a block, a block at a time. ``anchors``: written."""
    shape = anchors.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("q")), F.lit(0)).alias("width")).first()
    width = max(1, shape["width"])
    count = -(-shape["n"] * 8 * (width + 8) // block_bytes)
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, count))))
    for b in range(count):
        yield width, dealt.where(F.col("block") == b).drop("block")


def passed(rows: DataFrame, width: int, block: pa.Table, k: int, cells: int, fill: Callable, columns: list[str]) -> DataFrame:
    """anchor_row, slot, score, key, row: what each task keeps of one pass of ``rows`` over a block of anchors."""
    width = max(width, 1)
    mine = {c: block.column(c).to_numpy() for c in columns}
    sent = rows.sparkSession.sparkContext.broadcast((_matrix(block.column("q").combine_chunks(), width), mine))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, anchor = sent.value
        scores, best = Scores(vectors), Best(len(vectors) * cells, k)
        step = max(1, TILE // len(vectors))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                q = part.column("q")
                width_here = max(width, int(pa.compute.max(pa.compute.list_value_length(q)).as_py() or 0))
                got = scores(_matrix(q, width_here)[:, :width])
                ids = part.column("key").fill_null(int(NO_ID)).to_numpy()
                fill(best, got, anchor, part.column("label").to_numpy(), ids, part.column("row").to_numpy())
        held = best.held
        for at in range(0, len(held), 50_000):
            some = held[at : at + 50_000]
            arrays = [anchor["row"][some[:, 0] // cells], some[:, 0] % cells, some[:, 1], some[:, 2], some[:, 3]]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["anchor_row", "slot", "score", "key", "row"])

    return rows.select("row", "key", "label", "q").mapInArrow(keep, "anchor_row long, slot long, score long, key long, row long")


def top(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best of each group, with ``place`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "key", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def positives(rows: DataFrame, width: int, block: pa.Table, k: int = K) -> DataFrame:
    """anchor_row, score, key, place: the first rows of an anchor's label."""

    def fill(best: Best, got: np.ndarray, anchor: dict, label: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        open_ = (anchor["label"][:, None] == label[None, :]) & (anchor["row"][:, None] != row[None, :])
        best.add(np.arange(len(got)), got, open_, ids, row)

    return top(passed(rows, width, block, k, 1, fill, ["row", "label"]), k, "anchor_row").select("anchor_row", "score", "key", "place")


def slots(rows: DataFrame, width: int, block: pa.Table, k: int = K, share: tuple[int, int] = SHARE, most: int = K) -> DataFrame:
    """anchor_row, slot, score, key, row: the k best of each slot. ``block`` has the descending limits of each anchor."""
    low, high = share

    def fill(best: Best, got: np.ndarray, anchor: dict, label: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        other = anchor["label"][:, None] != label[None, :]
        limits = anchor["limits"]
        for s in range(most):
            has = limits["n"] > s
            if not has.any():
                break
            limit = limits["at"][has, s]
            under = np.where(limits["n"][has] > s + 1, limits["at"][has, min(s + 1, most - 1)], LEAST)
            floor = np.array([-(-low * int(x) // high) for x in limit], object)
            floor = np.clip(floor, LEAST, NO_ID).astype(np.int64)
            here = got[has]
            open_ = other[has] & (here <= limit[:, None]) & (here >= floor[:, None])
            open_ &= (here > under[:, None]) | (limits["n"][has] == s + 1)[:, None]
            best.add(np.flatnonzero(has) * most + s, here, open_, ids, row)

    padded = np.zeros((block.num_rows, most), np.int64)
    each = block.column("limits").to_pylist()
    for i, x in enumerate(each):
        padded[i, : len(x)] = x
    limits = {"n": np.array([len(x) for x in each]), "at": padded}

    def with_limits(best: Best, got: np.ndarray, anchor: dict, *rest: np.ndarray) -> None:
        fill(best, got, anchor | {"limits": limits}, *rest)

    return top(passed(rows, width, block, k, most, with_limits, ["row", "label"]), k, "anchor_row", "slot")


def selected(rows: DataFrame, anchors: DataFrame, k_positives: int = K, k: int = K, share: tuple[int, int] = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor, positive, place, rank, negative, positive_score, negative_score; ``rows`` and ``anchors`` (some of them) are written."""
    spark = rows.sparkSession
    parts = []
    for width, block in blocks(spark, anchors, block_bytes):
        local = block.toArrow()
        if not local.num_rows:
            continue
        near = written(positives(rows, width, local, k_positives), "negatives-positives")
        # Distinct scores of the positives, highest first: the limits, and each positive's slot.
        limits = near.groupBy("anchor_row").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
        limited = block.join(limits.withColumnRenamed("anchor_row", "row"), "row").toArrow()  # k limits at most of each anchor of the block
        if not limited.num_rows:
            continue
        best = written(slots(rows, width, limited, k, share, k_positives), "negatives-slots")
        # One descending list for each anchor: from a positive's slot on it begins with that positive's k best.
        entry = F.struct((-F.col("slot")).alias("slot"), "score", (-F.col("row")).alias("row"), "key")
        order = lambda a, b: F.when(
            a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1)
        ).when(a["key"] != b["key"], F.when(a["key"] < b["key"], -1).otherwise(1)).otherwise(F.when(a["row"] > b["row"], -1).otherwise(1))
        lists = best.groupBy("anchor_row").agg(F.array_sort(F.collect_list(entry), order).alias("found"))
        asked = near.join(limits, "anchor_row").withColumn("slot", F.array_position("limits", F.col("score")) - 1)
        answer = asked.join(lists, "anchor_row").withColumn("first", F.slice(F.filter("found", lambda x: -x["slot"] >= F.col("slot")), 1, k))
        low, high = share
        wide = lambda c: c.cast("decimal(20,0)")
        inside = F.filter("first", lambda x: wide(x["score"]) * high >= wide(F.col("score")) * low)
        each = answer.select("anchor_row", F.col("key").alias("positive"), "place", F.col("score").alias("positive_score"), F.posexplode(inside).alias("at", "n"))
        each = each.join(block.select(F.col("row").alias("anchor_row"), F.col("key").alias("anchor")), "anchor_row")
        no_id = lambda c: F.nullif(c, F.lit(int(NO_ID)))
        each = each.select(
            "anchor", no_id(F.col("positive")).alias("positive"), "place", (F.col("at") + 1).cast("int").alias("rank"),
            no_id(F.col("n.key")).alias("negative"), "positive_score", F.col("n.score").alias("negative_score"),
        )
        parts.append(written(each, "negatives-found"))
        forget(near, best)
    empty = spark.createDataFrame([], "anchor long, positive long, place int, rank int, negative long, positive_score long, negative_score long")
    return spark.read.schema(empty.schema).parquet(*(path_of(p) for p in parts)) if parts else empty


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = written(quantised(table(spark, sf_dir, "embeddings"), label), "negatives-rows")
    found = selected(rows, written(rows.where(F.col("key") % 100 == 0), "negatives-anchors"))
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"), "positive_score", "negative_score",
    )


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
