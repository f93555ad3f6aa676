"""Near-duplicates by Order MinHash, verified by banded alignment.

Shingles are five words, lower case. The i-th repeat of a shingle in a text is an element of its own
(shingle, i). ``sketches``: each of ``BANDS`` hash functions picks the ``PICKED`` elements with the smallest
hashes, and the shingles of these in text order are the sketch. Texts with the same shingles in another
order differ in it, which an unordered MinHash does not see.

``aligned``: two texts are near-duplicates if an alignment of their shingle sequences matches m shingles
with m / (n1 + n2 - m) of at least ``LEAST``. Such an alignment leaves at most (n1 + n2) / 9 shingles
unmatched at 0.8, and so never leaves a band of that width. The dynamic programme keeps one bit per column of the band, which slides
along with the row: a pair of n words costs n operations on words of the band and memory for the places of n shingles. The chance that
a pair at 0.8 shares no sketch is under 1e-6.

``classes``: texts with the same words are one node from the start. In a bucket (nodes with a common
sketch) each node is compared with the leader, the node whose sketches occur most, as those of a copied original
do; the nodes unlike it get another leader, ``ROUNDS`` at most, while they are more than ``REST``; that only saves work. So a bucket of n
near copies costs n comparisons. Verified links make components by alternating large and small stars.
Then all nodes of a bucket that are not in one component yet meet (linking.crossed): a pair is verified, once whatever the number of its buckets,
if sizes and parities of labelled shingles allow it. Buckets of more than linking.BLOCK nodes meet by rare elements of their nodes (linking.thinned).
No verified link between nodes of a bucket that would join two components is left out, and tables are deleted as soon as the next is written.

Defined results: a text with fewer than five words has one shingle of all its words; texts without a
word, null ones too, have the same (no) words and are one class; a class is named by its smallest key,
a null key comes last and is null as a name; of a class the row with the smallest key, then the first
row, is kept; repeated rows are one class; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .common import ROW, SPACE, forget, numbered, packed, table, text_of, written
from .linking import alike, components, counts, crossed, led, led_again, mixed, parity, prefix_of, resolved, thinned, weight_of

WORDS = 5
BANDS = 20
PICKED = 3
LEAST = (8, 10)
ROUNDS = 3
REST = 64  # nodes unlike their leader that a bucket may keep before it gets another leader
OFTEN = 1024  # places of a shingle in a text that are kept as a list


def shingles(words: np.ndarray, width: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``width`` words, or of all words if there are fewer; none without words."""
    words = words.view(np.uint64)
    n = max(1, len(words) - width + 1) if len(words) else 0
    h = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for j in range(min(width, len(words))):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n])
    return h


def labelled(h: np.ndarray) -> np.ndarray:
    """Hashes of (shingle, how often it occurred before)."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    if new.all():
        return h
    at = np.arange(len(s))
    seen = np.empty(len(s), np.uint64)
    seen[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return h + seen * np.uint64(0xD1342543DE82EF95)


def order_minhash(words: np.ndarray, bands: int = BANDS, picked: int = PICKED) -> np.ndarray:
    """One sketch for each hash function."""
    h = shingles(words)
    if not len(h):
        return np.zeros(0, np.int64)
    seeds = mixed(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    g = mixed(labelled(h)[None, :] ^ seeds[:, None])
    at = np.argpartition(g, picked - 1, axis=1)[:, :picked] if len(h) > picked else np.tile(np.arange(len(h)), (bands, 1))
    ordered = h[np.sort(at, axis=1)]
    out = seeds.copy()
    for j in range(ordered.shape[1]):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + ordered[:, j])
    return out.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, least: tuple[int, int] = LEAST) -> bool:
    """Whether an alignment of the shingle sequences reaches the similarity."""
    n, total = min(len(a), len(b)), len(a) + len(b)
    need = -(-least[0] * total // (least[0] + least[1]))  # matches that are enough
    if n < need:
        return False
    band = total - 2 * need
    differ = np.flatnonzero(a[:n] != b[:n])
    start = int(differ[0]) if len(differ) else n
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    end = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - end], b[: len(b) - end]
    need -= start + end
    if need <= 0:
        return True
    if min(len(a), len(b)) < need or np.isin(a, b).sum() < need:
        return False
    order = np.argsort(a, kind="stable")
    first, last = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    often: dict[int, int] = {}
    for x in first[last - first > OFTEN].tolist():  # few shingles can be frequent: all places as bits
        if x not in often:
            bits = np.zeros(len(a), bool)
            bits[order[x : int(np.searchsorted(a[order], a[order[x]], "right"))]] = True
            often[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    width = 2 * band + 1
    whole = (1 << width) - 1
    row, low, done = whole, 0, 0  # columns low to low + width; a zero: the best alignment grows by one there
    for j, (x, y) in enumerate(zip(first.tolist(), last.tolist())):
        if j > band:
            done += 1 - (row & 1)
            row, low = row >> 1 | 1 << width - 1, low + 1
        if x == y:
            continue
        if x in often:
            match = often[x] >> low & whole
        else:
            places = order[x:y]
            if y - x > 8:
                places = places[np.searchsorted(places, low) : np.searchsorted(places, low + width)]
            match = 0
            for p in places.tolist():
                if low <= p < low + width:
                    match |= 1 << p - low
        if match:
            grown = row & match
            row = ((row + grown) | (row - grown)) & whole
    return done + width - row.bit_count() >= need


def word_hashes(text):
    """The hash of each lower-case word, in text order."""
    return F.transform(F.array_remove(F.split(F.lower(text), SPACE + "+"), ""), lambda w: F.xxhash64(w))


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]


def sketched(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row, key, digest of the words, size and parities of the labelled shingles, sketches; for every row."""
    slim = numbered(docs.select(key, text)).select(
        F.col(ROW).alias("row"), F.col(key).cast("long").alias("key"), word_hashes(text_of(text)).alias("words")
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            each = _arrays(batch.column(2))
            sets = [labelled(shingles(w)) for w in each]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in each], pa.binary()),
                    pa.array([len(x) for x in sets], pa.int64()), pa.array([parity(x) for x in sets], pa.binary()),
                    pa.array([order_minhash(w) for w in each], pa.list_(pa.int64())),
                ],
                names=["row", "key", "digest", "size", "bits", "sketches"],
            )

    return slim.mapInArrow(sketch, "row long, key long, digest binary, size long, bits binary, sketches array<long>")


def word_table(docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """node, words of the nodes (rows of ``docs``)."""
    some = numbered(docs.select(text)).join(broadcast_if_small(nodes.select(F.col("node").alias(ROW))), ROW, "left_semi")
    return some.select(F.col(ROW).alias("node"), word_hashes(text_of(text)).alias("words"))


def compared(pairs: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """a, b: those of ``pairs`` that an alignment makes near-duplicates; written."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [aligned(shingles(np.array(x.values)), shingles(np.array(y.values))) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    involved = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "near-involved")
    words = written(word_table(docs, involved, text), "near-words")
    side = lambda x: words.select(F.col("node").alias(x), F.col("words").alias(f"{x}_words"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_words", "b_words")
    out = written(both.mapInArrow(compare, "a long, b long"), "near-compared")
    forget(involved, words)
    return out


def _prefixes(docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """bucket, node, size, pos, weight: the prefixes of labelled shingles, in the order of how rare they are among these nodes."""
    words = word_table(docs, nodes, text)
    sets = lambda batch: [labelled(shingles(w)) for w in _arrays(batch.column("words"))]
    rank = words.sparkSession.sparkContext.broadcast(counts(words, lambda batches: map(sets, batches)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = sets(batch)
            first = [prefix_of(x, rank.value, LEAST) for x in each]
            n = [len(x) for x in first]
            spread = lambda values: pa.array(np.repeat(np.array(values, np.int64), n))
            arrays = [
                pa.array(np.concatenate([*first, np.zeros(0, np.uint64)]).view(np.int64)), spread(batch.column("node").to_pylist()), spread([len(x) for x in each]),
                pa.array(np.concatenate([*map(np.arange, n), np.zeros(0, np.int64)])), spread([weight_of(x, rank.value) for x in first]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "node", "size", "pos", "weight"])

    return words.mapInArrow(index, "bucket long, node long, size long, pos long, weight long")


def _buckets(nodes: DataFrame) -> DataFrame:
    """bucket, node, size, pos (0), weight: a row for each sketch of a node."""
    of = lambda column: [mixed(x.view(np.uint64) + np.arange(len(x), dtype=np.uint64)) for x in _arrays(column)]  # noqa: E731 (a band has buckets of its own)
    slim = nodes.select("node", "size", "sketches")
    rank = nodes.sparkSession.sparkContext.broadcast(counts(slim, lambda batches: (of(b.column("sketches")) for b in batches)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = of(batch.column("sketches"))
            n = [len(x) for x in each]
            spread = lambda values: pa.array(np.repeat(np.array(values, np.int64), n))
            buckets = np.concatenate([*each, np.zeros(0, np.uint64)])
            arrays = [
                pa.array(buckets.view(np.int64)), spread(batch.column("node").to_pylist()), spread(batch.column("size").to_pylist()),
                pa.array(np.zeros(len(buckets), np.int64)), spread([weight_of(x, rank.value) for x in each]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "node", "size", "pos", "weight"])

    return slim.mapInArrow(index, "bucket long, node long, size long, pos long, weight long")


def links(nodes: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """node, root of the components of all verified links; written. ``nodes``: node (a row of ``docs``), size, bits, sketches; written."""
    open_ = all_ = written(led(_buckets(nodes)), "near-open")
    found, gone = nodes.sparkSession.createDataFrame([], "a long, b long"), []
    for i in range(ROUNDS):
        pairs = written(open_.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "near-pairs")
        likely = alike(pairs, nodes, LEAST)
        ok = compared(likely.select("a", "b"), docs, text)
        gone += [ok, open_]
        found = found.union(ok)
        forget(pairs, likely)
        if i + 1 == ROUNDS or (open_ := led_again(open_, ok, REST)) is None:
            break
    roots = components(found)
    rows = all_.select("bucket", "node", "size", "pos").join(broadcast_if_small(roots), "node", "left")
    rows = written(rows.select("bucket", "node", F.coalesce("root", "node").alias("root"), "size", "pos"), "near-rows")
    forget(*gone)
    rows = thinned(rows, LEAST, lambda some: _prefixes(docs, some, text))
    pairs = crossed(rows, nodes, LEAST)
    ends = resolved(pairs, roots, lambda some: compared(some, docs, text))
    forget(rows, pairs, roots)
    return ends


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs``: row, key, class_id, class_size, kept."""
    rows = written(sketched(docs, key, text), "near-sketches")
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row"))
    nodes = rows.groupBy("digest").agg(first.alias("best"), F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("size", "bits", "sketches")))
    nodes = written(nodes.withColumn("node", F.col("best.row")), "near-nodes")
    roots = links(nodes.select("node", "size", "bits", "sketches"), docs.select(text), text)
    ends = written(nodes.select("node", "best", "n").join(broadcast_if_small(roots), "node"), "near-ends")
    whole = written(ends.groupBy("root").agg(F.min("best").alias("kept"), F.sum("n").alias("class_size")), "near-whole")
    ends = written(ends.join(broadcast_if_small(whole), "root").select("node", "kept", "class_size"), "near-named")
    named = nodes.select("node", "digest", "best", "n").join(broadcast_if_small(ends), "node", "left")
    kept = F.coalesce("kept", "best")
    named = named.select("digest", kept["key"].alias("class_id"), kept["row"].alias("kept_row"), F.coalesce("class_size", "n").alias("class_size"))
    named = written(named, "near-classes")
    forget(nodes, roots, whole, ends)
    return rows.select("row", "key", "digest").join(named, "digest").select("row", "key", "class_id", "class_size", (F.col("row") == F.col("kept_row")).alias("kept"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "class_id", "class_size", "kept")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without near-duplicates: one of each class."""
    keep = classes(docs).where("kept").select(F.col("row").alias(ROW))
    return packed(docs).join(keep, ROW, "left_semi").select("doc.*")
