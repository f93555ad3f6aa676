"""Pairs worth verifying, and the components of verified links; shared by the joins on sets of shingles.

Two sets with sizes n and m are similar enough if they share ``needed`` elements, so at most n + m - 2 * needed elements
are in one of them only. ``parity`` writes a set as the parities of the numbers of its elements per bucket of a hash:
two such rows of bits differ in no more places than the sets differ in elements, so a pair that differs in
more places is certainly not similar. That test, the sizes and the positions of the common element never lose a similar pair.

Sets are ordered by how often their elements occur, rare ones first: ``counts`` takes the counts of all sets in ``SLOTS`` slots of a hash
(any fixed order is right; a good one makes short lists). Similar sets of n and m elements share one of their first elements, their
prefixes (n - ceil(n * similarity) + 1 of n). ``led`` gives each bucket a leader: the node whose elements occur most, as those of a copied original do.

``crossed`` lists the pairs left for verification among the nodes that share a bucket: only nodes of different components, and only
pairs that pass those tests; ``resolved`` verifies first the likeliest pair of any two components, then those that are still apart. The largest component of a bucket is never compared with itself. Buckets of more than ``BLOCK`` nodes are cut
into blocks (and thinned before, see ``thinned``), each block of the other nodes meets each block of the bucket in a cell of its own, and cells are streamed in sorted order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .common import forget, written

SLOTS = 1 << 21
BITS = 1024
BLOCK = 1024
EDGES = 1_000_000  # edges that one task contracts
FIRST = 20_000  # pairs beyond which one pair of any two components goes first
SMALL = 32  # nodes of a bucket whose pairs are listed before their bits are fetched


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def parity(elements: np.ndarray, bits: int = BITS) -> bytes:
    """Parities of a set of 64-bit hashes."""
    place = (mixed(elements) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(bool)).tobytes()


def needed(total: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """Common elements of two sets with ``total`` elements in all, for common : all distinct of ``least``."""
    return -(-least[0] * total // (least[0] + least[1]))


def counts(texts: DataFrame, sets: Callable[[Iterator[pa.RecordBatch]], Iterator[list[np.ndarray]]], slots: int = SLOTS) -> np.ndarray:
    """How many sets of ``texts`` have an element of each slot, on a scale of 256 steps an octave; ``slots`` numbers at any size of the corpus."""
    part = 1 << 12  # slots whose counts of all tasks meet in one task

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = np.zeros(slots, np.int64), [], 0
        for some in sets(batches):
            held += some
            size += sum(map(len, some))
            if size > slots:
                seen += np.bincount((np.concatenate(held) % np.uint64(slots)).astype(np.int64), minlength=slots)
                held, size = [], 0
        if held:
            seen += np.bincount((np.concatenate(held) % np.uint64(slots)).astype(np.int64), minlength=slots)
        for p in range(-(-slots // part)):
            at = np.flatnonzero(seen[p * part : (p + 1) * part])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([at], pa.list_(pa.int32())), pa.array([seen[p * part + at]], pa.list_(pa.int32()))], names=["part", "at", "n"]
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, at, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                sums.setdefault(p, np.zeros(part, np.int64))[at.values.to_numpy()] += n.values.to_numpy()
        for p, n in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([n], pa.list_(pa.int64()))], names=["part", "n"])

    each = texts.mapInArrow(count, "part int, at array<int>, n array<int>").repartition("part").mapInArrow(merge, "part int, n array<long>")
    total = np.zeros(-(-slots // part) * part, np.int64)
    for r in each.toArrow().to_batches():  # slots numbers in all, whatever the input
        for p, n in zip(r.column(0).to_pylist(), r.column(1)):
            total[p * part : (p + 1) * part] = n.values.to_numpy()
    return np.round(256 * np.log2(1 + total[:slots])).astype(np.uint16)


def prefix_of(found: np.ndarray, rank: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """The first elements of a set in the order of all sets."""
    n = len(found)
    order = np.lexsort((found, rank[(found % np.uint64(len(rank))).astype(np.int64)]))
    return found[order[: n + (-least[0] * n // least[1]) + 1]]


def weight_of(elements: np.ndarray, rank: np.ndarray) -> int:
    """How often elements occur, summed over the scale of ``counts``."""
    return int(rank[(elements % np.uint64(len(rank))).astype(np.int64)].sum(dtype=np.int64))


def led(rows: DataFrame) -> DataFrame:
    """bucket, node, size, pos, weight, leader, l_size, l_pos: ``rows`` of buckets with two rows or more, and the row of the largest weight.

    Rows are streamed by bucket in one exchange, the leader first; nothing of a bucket is held but its leader.
    """
    names = ["bucket", "node", "size", "pos", "weight"]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, kept back until it is known to have a second one in its bucket
        leader = None  # bucket, node, size, pos of the leader of the bucket of that row
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {c: batch.column(c).to_numpy() for c in names}
            if held is not None:
                x = {c: np.concatenate([held[c], x[c]]) for c in names}
            new = np.r_[held is None or x["bucket"][0] != leader[0], x["bucket"][1:] != x["bucket"][:-1]]
            at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            first = {c: np.where(at < 0, 0 if leader is None else leader[i], x[c][at]) for i, c in enumerate(names[:4])}
            keep = np.r_[~new[1:], False] | ~new
            last = len(new) - 1
            leader = tuple(int(first[c][last]) for c in names[:4])
            held = {c: x[c][last:] for c in names}
            out = np.flatnonzero(keep[:last])
            yield pa.RecordBatch.from_arrays([pa.array(v[out]) for v in [*x.values(), *(first[c] for c in names[1:4])]], names=[*names, "leader", "l_size", "l_pos"])
        if held is not None and int(held["node"][0]) != leader[1]:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in [*held.values(), *(np.array([k]) for k in leader[1:])]], names=[*names, "leader", "l_size", "l_pos"])

    each = rows.select(*names).repartition("bucket").sortWithinPartitions("bucket", F.desc("weight"), "node")
    return each.mapInArrow(lead, ", ".join(f"{c} long" for c in [*names, "leader", "l_size", "l_pos"]))


def led_again(open_: DataFrame, linked: DataFrame, rest: int) -> DataFrame | None:
    """``led`` for what is unlike its leader in buckets that keep more than ``rest`` such nodes; written, None if there are none.

    ``open_``: of ``led``; ``linked``: a (the leader), b. Both written. Only rows of buckets that are large enough are looked at.
    """
    count = lambda df, least: df.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > least).select("bucket")
    large = written(count(open_, rest + 1), "led-large")
    left = many = None
    if not large.isEmpty():
        unlike = open_.where("node != leader").join(broadcast_if_small(large), "bucket", "left_semi")
        done = linked.select(F.col("a").alias("leader"), F.col("b").alias("node"))
        unlike = unlike.join(broadcast_if_small(done), ["leader", "node"], "left_anti")
        many = written(count(unlike, rest), "led-many")
        if not many.isEmpty():
            left = written(led(unlike.join(broadcast_if_small(many), "bucket", "left_semi")), "led-again")
        forget(many)
    forget(large)
    return left


def _bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def alike(pairs: DataFrame, nodes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b; written) whose sizes and parities allow the similarity, with gap: the less, the likelier. ``nodes``: node, size, bits; written."""
    others = [c for c in pairs.columns if c not in ("a", "b")]
    names = ["a", "b", *others, "gap"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("a_size").to_numpy(), batch.column("b_size").to_numpy()
            need = needed(n + m, least)
            gap = differing(_bits(batch.column("a_bits")), _bits(batch.column("b_bits"))) - (n + m - 2 * need)
            kept = batch.select(names[:-1]).append_column("gap", pa.array(gap))
            yield kept.filter(pa.array((need <= np.minimum(n, m)) & (gap <= 0)))

    side = lambda x: nodes.select(F.col("node").alias(x), F.col("size").alias(f"{x}_size"), F.col("bits").alias(f"{x}_bits"))
    half = written(side("a").join(broadcast_if_small(pairs), "a"), "alike-half")
    both = side("b").join(broadcast_if_small(half), "b")
    out = written(both.mapInArrow(check, ", ".join(f"{c} long" for c in names)), "alike")
    forget(half)
    return out


def _cells(least: tuple[int, int], with_bits: bool):
    """Streams rows sorted by cell (cell, side, node, root, size, pos, bits) and yields the pairs of each cell that may be similar."""

    def open_pairs(x: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n, m = x["size"][i], x["size"][j]
        need = needed(n + m, least)
        ok = (x["root"][i] != x["root"][j]) & ((x["side"][i] < 0) | (x["side"][i] != x["side"][j])) & (need <= np.minimum(n, m))
        return ok & (np.minimum(n - x["pos"][i], m - x["pos"][j]) >= need)

    def pairs_of(x: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cell = x["cell"]
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sizes = np.diff(np.r_[starts, len(cell)])
        small = sizes <= SMALL
        for d in range(1, int(sizes[small].max(initial=1))):
            i = np.flatnonzero(np.repeat(small, sizes)[:-d] & (cell[:-d] == cell[d:]))
            ok = open_pairs(x, i, i + d)
            yield i[ok], i[ok] + d
        for s, n in zip(starts[~small].tolist(), sizes[~small].tolist()):
            for at in range(s, s + n, 64):  # 64 rows against those after them
                i, j = np.arange(at, min(at + 64, s + n)), np.arange(at, s + n)
                i, j = (k.ravel() for k in np.broadcast_arrays(i[:, None], j[None, :]))
                i, j = i[i < j], j[i < j]
                ok = open_pairs(x, i, j)
                yield i[ok], j[ok]

    def emit(x: dict) -> Iterator[pa.RecordBatch]:
        for i, j in pairs_of(x):
            if with_bits and len(i):
                n, m = x["size"][i], x["size"][j]
                gap = differing(x["bits"][i], x["bits"][j]) - (n + m - 2 * needed(n + m, least))
                i, j, gap = i[gap <= 0], j[gap <= 0], gap[gap <= 0]
            if len(i):
                turn = x["node"][i] > x["node"][j]
                i, j = np.where(turn, j, i), np.where(turn, i, j)
                arrays = [x["node"][i], x["node"][j], x["root"][i], x["root"][j], *([gap] if with_bits else [])]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in arrays], names=["a", "b", "a_root", "b_root", "gap"][: len(arrays)])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        names = ["cell", "side", "node", "root", "size", "pos"]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {c: batch.column(c).to_numpy() for c in names}
            if with_bits:
                x["bits"] = _bits(batch.column("bits"))
            if held:
                x = {c: np.concatenate([held[c], x[c]]) for c in x}
            cut = int(np.searchsorted(x["cell"], x["cell"][-1]))  # the last cell may go on
            if cut:
                yield from emit({c: v[:cut] for c, v in x.items()})
            held = {c: v[cut:] for c, v in x.items()}
        if held:
            yield from emit(held)

    return stream


def thinned(rows: DataFrame, least: tuple[int, int], prefixes: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` of ``crossed`` with the buckets of more than ``BLOCK`` nodes of several components replaced; written.

    Similar nodes of such a bucket share an element of their prefixes in any order; in the order of these nodes' rare elements first,
    what most of them have in common is in few prefixes. ``prefixes`` gives bucket, node, size, pos and weight for the elements of the prefixes of the nodes it gets.
    """
    full = rows.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("root") != F.max("root")).alias("open")).where((F.col("n") > BLOCK) & F.col("open"))
    full = written(full.select("bucket"), "thinned-full")
    if full.isEmpty():
        forget(full)
        return rows
    met = written(rows.join(broadcast_if_small(full), "bucket").select("node", "root").distinct(), "thinned-nodes")
    found = written(led(prefixes(met.select("node"))), "thinned-buckets")
    again = found.join(broadcast_if_small(met), "node").select("bucket", "node", "root", "size", "pos")
    out = written(rows.join(broadcast_if_small(full), "bucket", "left_anti").select("bucket", "node", "root", "size", "pos").union(again), "thinned")
    forget(full, met, found, rows)
    return out


def crossed(rows: DataFrame, nodes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """a, b (a < b), a_root, b_root, gap: pairs of different components with a common bucket that may be similar; written.

    ``rows``: bucket, node, root, size, pos (elements of the node before the common one, 0 if the order is not known);
    ``nodes``: node, size, bits. Both written.
    """
    parts = rows.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    buckets = parts.groupBy("bucket").agg(F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("long")
    buckets = written(buckets.where("roots > 1").select(
        "bucket", F.col("main.root").alias("main"), F.col("n").alias("n"), blocks(F.col("main.n")).alias("mains"), blocks(F.col("n") - F.col("main.n")).alias("others"),
    ), "crossing")
    met = rows.join(broadcast_if_small(buckets), "bucket")
    small = met.where(F.col("n") <= SMALL).select(F.col("bucket").alias("cell"), F.lit(-1).cast("long").alias("side"), "node", "root", "size", "pos")
    large = met.where(F.col("n") > SMALL)
    is_main = F.col("root") == F.col("main")
    mine = F.pmod(F.xxhash64("node"), F.when(is_main, F.col("mains")).otherwise(F.col("others")))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    at = lambda kind, i, j, side: F.struct(F.xxhash64("bucket", F.lit(kind), i, j).alias("cell"), side.cast("long").alias("side"))
    me = F.col("mine")
    cells = (
        F.when(F.col("n") <= BLOCK, F.array(F.struct(F.col("bucket").alias("cell"), F.lit(-1).cast("long").alias("side"))))
        .when(is_main, F.transform(upto(F.col("others")), lambda j: at(1, me, j, F.lit(0))))
        .otherwise(F.concat(
            F.transform(upto(F.col("mains")), lambda i: at(1, i, me, F.lit(1))),
            F.transform(upto(F.col("others")), lambda j: at(2, F.least(me, j), F.greatest(me, j), F.when(me == j, -1).otherwise((me > j).cast("int")))),
        ))
    )
    large = large.withColumn("mine", mine).withColumn("at", F.explode(cells)).select("at.cell", "at.side", "node", "root", "size", "pos")
    large = large.join(nodes.select("node", "bits"), "node").select("cell", "side", "node", "root", "size", "pos", "bits")
    pair = "a long, b long, a_root long, b_root long"
    listed = lambda df, bits: df.repartition("cell").sortWithinPartitions("cell").mapInArrow(_cells(least, bits), pair + (", gap long" if bits else "")).distinct()
    some = written(listed(small, False), "crossed-small")
    found = alike(some, nodes, least)
    if not buckets.where(F.col("n") > SMALL).isEmpty():
        found, few = written(found.union(listed(large, True)).distinct(), "crossed"), found
        forget(few)
    forget(buckets, some)
    return found


def resolved(pairs: DataFrame, roots: DataFrame, verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node, root of the components that ``roots`` and the verified ones of ``pairs`` (of ``crossed``) make; written.

    ``verified`` gives the linked ones (a, b; written) of the pairs it gets. Many pairs may link the same two components: one of them is
    tried first, and pairs whose components it joins are done.
    """
    count = pairs.count()
    parts = [roots.select(F.col("node").alias("a"), F.col("root").alias("b"))]
    gone = []
    if count > FIRST:
        best = F.min(F.struct("gap", "a", "b")).alias("p")
        first = written(pairs.groupBy("a_root", "b_root").agg(best).select("p.a", "p.b"), "resolved-first")
        ok = verified(first)
        parts.append(ok)
        now = components(parts[0].union(ok))
        step = lambda x: broadcast_if_small(now.select(F.col("node").alias(f"{x}_root"), F.col("root").alias(f"{x}_now")))
        left = pairs.join(step("a"), "a_root", "left").join(step("b"), "b_root", "left").where("coalesce(a_now, a_root) <> coalesce(b_now, b_root)")
        pairs = written(left.select("a", "b"), "resolved-left")
        gone += [first, ok, now, pairs]
    if count:
        gone.append(verified(pairs.select("a", "b")))
        parts.append(gone[-1])
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    out = components(out)
    forget(*gone)
    return out


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of the edges with the smallest node that they connect it to."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(p, p)
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(a), top(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    found = [(x, top(x)) for x in list(parent)]
    found = np.array([f for f in found if f[0] != f[1]], np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["v", "u"])


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): root is the smallest node of its component; written.

    Each task contracts up to ``EDGES`` edges to stars; those of several tasks are joined by alternating large and small stars, in a number of
    rounds that grows with the logarithm of the nodes.
    """

    def larger(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v != u").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())

    all_ = written(edges.select("a", "b"), "edges")
    tasks = -(-all_.count() // EDGES)
    now = written(all_.coalesce(max(1, tasks)).mapInArrow(_forest, "v long, u long"), "stars")
    forget(all_)
    before = None
    while tasks > 1 and (sign := mark(now)) != before:
        before = sign
        both = now.union(now.select("u", "v")).toDF("v", "u")  # u: a neighbour of v
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("a"), F.col("m").alias("b"))
        middle = written(larger(large), "stars")
        least = middle.groupBy("v").agg(F.min("u").alias("m"))
        small = middle.join(least, "v").select(F.col("u").alias("a"), F.col("m").alias("b")).union(least.select("v", "m"))
        after = written(larger(small), "stars")
        forget(now, middle)
        now = after
    nodes = now.select(F.col("v").alias("node"), F.col("u").alias("root"))
    out = written(nodes.union(now.select("u", "u").distinct()), "components")
    forget(now)
    return out
