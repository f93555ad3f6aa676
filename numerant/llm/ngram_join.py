"""Similarity join of shingle sets (Jaccard) by grouped prefixes.

A document's set: its distinct runs of ``WIDTH`` words, A-Z lower-cased, as 64-bit hashes. Two sets link if common : all
is at least ``LEAST``. Sets are ordered by how often their elements occur, rare ones first: ``counts`` takes the counts of
all documents in ``SLOTS`` slots of a hash (any fixed order is right; a good one makes short lists). Similar sets
of n and m elements share one of their first n - ceil(n * LEAST) + 1, their prefixes.

Equal sets are one node; nodes with the same prefix and size are one group, named by its smallest node, so a prefix is indexed once, whatever the
number of its copies. Groups meet by the elements of their prefixes (buckets). In each bucket a group leads, the one whose prefix occurs most;
pairs of a leader and another group are filtered by their sizes and the positions of the common element, expanded to the nodes of the groups,
filtered by parities (see ``linking``), and verified on the whole sets. So a bucket of n near copies costs
n comparisons. The nodes unlike their leaders get further leaders, ``ROUNDS`` at most, while many are left; that only
saves work. Then ``crossed`` meets all nodes of a bucket that are not in one component yet, expanded from their groups, and
the pairs that pass are verified: no link between different sets is lost, and no pair is verified that cannot change a component.

Defined results: with fewer than ``WIDTH`` words the whole sequence is one shingle; null, empty and blank texts have no
shingle and are linked with nothing; a component is named by its smallest key, a null key comes last and is null as
a name; rows with the same key are separate documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .common import ROW, forget, numbered, slices, table, text_of, written
from .linking import SLOTS, alike, components, counts, crossed, led, led_again, mixed, needed, parity, prefix_of, resolved, weight_of

WIDTH = 4
LEAST = (85, 100)
ROUNDS = 3
REST = 64  # nodes unlike their leader that a bucket may keep before it gets another leader
PIECE = 4 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE = mixed(_LOWER.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def _hashed(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the words of ``raw``, bytes in which a text begins at each of ``begins``."""
    inside = ~_BLANK[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = begins[begins < len(raw)]
    start[begins] |= inside[begins]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, np.uint64), at
    place = np.arange(len(raw)) - np.repeat(np.r_[0, at], np.diff(np.r_[0, at, len(raw)]))
    length = np.add.reduceat(inside, at, dtype=np.int64)
    factor = mixed(np.arange(1, int(length.max()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    value = np.where(inside, _BYTE[raw], 0)
    value *= factor[np.minimum(place, len(factor) - 1)]
    return mixed(np.add.reduceat(value, at) + length.astype(np.uint64)), at


def words(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of the words of each text; lower-case is that of A-Z."""
    column = texts.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if ends[-1] == ends[0]:
        return [np.zeros(0, np.uint64)] * len(column)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    hashes, places, at = [], [], 0
    while at < len(raw):  # pieces end before a blank, so that a long text takes no more memory than a piece
        end = min(at + PIECE, len(raw))
        while end < len(raw) and not _BLANK[raw[end]]:
            blank = np.flatnonzero(_BLANK[raw[end : end + PIECE]])
            end = end + int(blank[0]) if len(blank) else min(end + PIECE, len(raw))
        h, p = _hashed(raw[at:end], ends[(ends >= at) & (ends < end)] - at)
        hashes.append(h), places.append(p + at)
        at = end
    h, p = np.concatenate(hashes), np.concatenate(places)
    cut = np.searchsorted(p, ends)
    return [h[a:b] for a, b in zip(cut[:-1], cut[1:])]


def shingle_set(word: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a text, sorted by hash."""
    if not len(word):
        return word
    n = max(1, len(word) - width + 1)
    h = np.full(n, min(len(word), width), np.uint64)
    for j in range(min(width, len(word))):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + word[j : j + n])
    return np.unique(h)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            yield batch, [shingle_set(w, width) for w in words(batch.column("text"))]


def indexed(texts: DataFrame, rank: np.ndarray, width: int = WIDTH, least: tuple[int, int] = LEAST) -> DataFrame:
    """row, key, size, digest of the set, digest of prefix and size, weight (how often its elements occur), prefix, bits; for every row."""
    sent = texts.sparkSession.sparkContext.broadcast(rank)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        digest = lambda *x: blake2b(b"".join(y.tobytes() for y in x), digest_size=16).digest()
        for batch, sets in _sets(batches, width):
            first = [prefix_of(s, sent.value, least).view(np.int64) if len(s) else s.view(np.int64) for s in sets]
            size = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("key"), pa.array(size), pa.array([digest(s) for s in sets]),
                    pa.array([digest(f, n) for f, n in zip(first, size)]), pa.array([weight_of(f.view(np.uint64), sent.value) for f in first], pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array([parity(s) for s in sets]),
                ],
                names=["row", "key", "size", "digest", "group", "weight", "prefix", "bits"],
            )

    return texts.mapInArrow(index, "row long, key long, size long, digest binary, group binary, weight long, prefix array<long>, bits binary")


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, least: tuple[int, int] = LEAST) -> DataFrame:
    """a, b: the linked ones of ``pairs`` of nodes (rows of ``texts``); written."""
    involved = written(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct(), "join-involved")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _sets(batches, width):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["node", "elements"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                total = len(a) + len(b)
                both = np.sort(np.concatenate([a, b]))
                ok.append(bool((both[1:] == both[:-1]).sum() >= needed(total, least)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    some = texts.join(broadcast_if_small(involved), "row", "left_semi").mapInArrow(sets, "node long, elements array<long>")
    some = written(some, "join-sets")
    side = lambda x: some.select(F.col("node").alias(x), F.col("elements").alias(f"{x}_elements"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_elements", "b_elements")
    out = written(both.mapInArrow(verify, "a long, b long"), "join-verified")
    forget(involved, some)
    return out


def linked(nodes: DataFrame, texts: DataFrame, width: int = WIDTH, least: tuple[int, int] = LEAST) -> DataFrame:
    """node, root of every node with a link; written. ``nodes``: node, size, group, weight, prefix, bits; written."""
    of = [F.first(c).alias(c) for c in ("size", "weight", "prefix")]
    groups = written(nodes.groupBy("group").agg(F.min("node").alias("node"), F.count("*").alias("n"), *of), "join-groups")
    several = groups.where("n > 1").select("group", F.col("node").alias("first"))
    # The other nodes of the groups that have several.
    members = nodes.select("node", "size", "group").join(broadcast_if_small(several), "group").where("node != first")
    members = written(members.select("first", F.col("node").alias("member"), "size"), "join-members")
    more = broadcast_if_small(members.select("first", "member"))
    elements = groups.select("node", "size", "weight", F.posexplode("prefix").alias("pos", "bucket"))
    open_ = all_ = written(led(elements.withColumn("pos", F.col("pos").cast("long"))), "join-buckets")
    forget(groups)
    tests = (  # on a pair of groups: sizes, and the elements left from the common one on
        "(l_size + size) * {0} <= {1} * least(size - pos, l_size - l_pos) and (l_size + size) * {0} <= {1} * least(size, l_size)"
    ).format(least[0], least[0] + least[1])
    found, gone = nodes.sparkSession.createDataFrame([], "a long, b long"), []
    for i in range(ROUNDS):
        pairs = open_.where("node != leader").where(tests).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        pairs = written(pairs, "join-pairs")
        other = pairs.join(more, F.col("b") == F.col("first")).select("a", F.col("member").alias("b"))
        if not i:  # the leader of a group is its first node
            other = other.union(members.select(F.col("first").alias("a"), F.col("member").alias("b")))
        every = written(pairs.union(other), "join-expanded")
        likely = alike(every, nodes, least)
        ok = verified(likely.select("a", "b"), texts, width, least)
        gone += [ok, open_]
        found = found.union(ok)
        forget(pairs, every, likely)
        if i + 1 == ROUNDS or (open_ := led_again(open_, ok, REST)) is None:
            break
    roots = components(found)
    rows = all_.select("bucket", "node", "size", "pos")
    inside = F.xxhash64(F.col("first"), F.lit("group"))  # a group of several nodes is a bucket of its own
    own = members.select(inside.alias("bucket"), F.col("member").alias("node"), "size")
    own = own.union(members.select(inside, "first", "size")).distinct().withColumn("pos", F.lit(0).cast("long"))
    rows = rows.union(rows.join(more, F.col("node") == F.col("first")).select("bucket", F.col("member").alias("node"), "size", "pos")).union(own)
    rows = rows.join(broadcast_if_small(roots), "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"), "size", "pos")
    rows = written(rows, "join-rows")
    forget(*gone)
    pairs = crossed(rows, nodes, least)
    ends = resolved(pairs, roots, lambda some: verified(some, texts, width, least))
    forget(rows, pairs, roots, members)
    return ends


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, least: tuple[int, int] = LEAST, slots: int = SLOTS) -> DataFrame:
    """Every row of ``docs``: row, key, size of its set, component (a key), component_size."""
    texts = numbered(docs.select(key, text)).select(F.col(ROW).alias("row"), F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    rank = counts(texts.select("text"), lambda batches: (s for _, s in _sets(batches, width)), slots)
    rows = written(indexed(texts, rank, width, least), "join-indexed")
    best = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row")).alias("best")
    first = [F.first(c).alias(c) for c in ("size", "group", "weight", "prefix", "bits")]
    nodes = rows.where("size > 0").groupBy("digest").agg(best, F.count("*").alias("n"), *first)
    nodes = written(nodes.withColumn("node", F.col("best.row")), "join-nodes")
    slim = rows.select("row", "key", "size", "digest")
    roots = linked(nodes.select("node", "size", "group", "weight", "prefix", "bits"), texts, width, least)
    ends = written(nodes.select("node", "digest", "best", "n").join(broadcast_if_small(roots), "node"), "join-ends")
    whole = ends.groupBy("root").agg(F.min("best")["key"].alias("component"), F.sum("n").alias("component_size"))
    whole = written(whole, "join-components")
    ends = ends.join(broadcast_if_small(whole), "root").select("node", "component", "component_size")
    ends = written(ends, "join-named")
    named = nodes.select("node", "digest", "best", "n").join(broadcast_if_small(ends), "node", "left")
    named = written(named.select("digest", F.when(F.col("component_size").isNull(), F.col("best.key")).otherwise(F.col("component")).alias("component"), F.coalesce("component_size", "n").alias("component_size")), "join-all")
    forget(nodes, roots, whole, ends)
    some = slim.where("size > 0").join(named, "digest").select("row", "key", "size", "component", "component_size")
    none = slim.where("size = 0").select("row", "key", "size", F.col("key").alias("component"), F.lit(1).cast("long").alias("component_size"))
    return some.union(none)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = joined(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


OP11_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(list_slice(w, i, i + 3)) AS h FROM d, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS t(i)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT h FROM s GROUP BY h HAVING count(*) > 1
), r AS (
  SELECT doc_id, h FROM s WHERE h IN (SELECT h FROM o)
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM r a JOIN r b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reach(x, y) AS (
  SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x
), m AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = d.doc_id
"""
