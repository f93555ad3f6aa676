"""Scoring texts by context-tree weighting over bytes.

A byte is eight binary decisions; the decisions taken before it make the node (1 to 255) in which the next
one falls. For every node and every context of the last 0 to ``DEPTH`` bytes the zeros and ones of the
training texts are counted. A context predicts by the Krichevsky-Trofimov estimate of its counts; its
weighted probability is half its own block probability and half the product of those of its longer contexts, so all
depths are mixed with the weights that the data give them. The model is then held fixed: a byte's
probability is the product of eight mixtures along its context.

The code is one of token sequences: lower-case words with one space between them and a line feed at
the end, preceded by line feeds. ``bits_per_byte`` is the code length over these bytes.

What is gathered are strings of DEPTH + 1 bytes ("grams", context first) and words, counted per chunk of
rows and dealt into parts: grams by their two nearest context bytes, words by a checksum. A part of a chunk is one
row, keys and counts packed. Parts are merged over spans of chunks, then over spans, so no task holds
what all chunks sent. The context trees below two bytes lie inside a part; the two levels above them are at most
65,536 nodes and are computed on the driver. Each chunk then gets back the probabilities of its own
grams and the counts of its own words: no table of all of them is ever broadcast or held by one task.

Defined results: a null text is the empty text, which is the end token alone; a null key is in the fold of
the empty key; without any training text each decision has probability one half, and base_score that
of N = V = 0; repeated rows score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, fold, numbered, table, written

DEPTH = 5
CHUNK_BITS = 13  # rows of a chunk, as a power of two
SPAN = 512  # chunks in a span, on average
SLICE = 2 << 20
WORD_PARTS = 512  # more for more distinct words: a part is held in memory
FIRST_WORD_PART = 1 << 16  # parts below are those of grams

_SEEN = "chunk long, part int, keys binary, n binary"
_MERGED = "part int, keys binary, n binary, total long, positive long"
_FACTS = "part int, keys binary, facts binary"
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"


def tokens(text: str | None) -> list[bytes]:
    """Words: A-Z in lower case, split at ASCII white space (all that bytes know of case and space)."""
    return (text or "").encode().lower().split()


def grams(texts: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of each byte of all texts, nearest context byte first, and the bytes of each text."""
    coded = [b" ".join(words) + b"\n" for words in texts]
    pad = b"\n" * depth
    flat = np.frombuffer(b"".join(pad + c for c in coded) or pad, np.uint8)
    n = len(flat) - depth
    g = np.zeros(n, np.int64)
    for d in range(1, depth + 1):
        g = g << 8 | flat[depth - d : depth - d + n]
    g = g << 8 | flat[depth:]
    sizes = np.array([len(c) for c in coded], np.int64)
    skipped = np.cumsum(sizes + depth)[:-1]  # where the next text's pad begins
    valid = np.ones(n, bool)
    for j in range(depth):
        valid[skipped - depth + j] = False
    return g[valid], sizes


def _sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
    return k[first], np.add.reduceat(n, first) if len(k) else n


def _by_size(rows: Iterator, limit: int = SLICE) -> Iterator[list]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or "")
        if size > limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def packed(keys: np.ndarray, bits: int) -> bytes:
    """Keys of so many bits, in as few whole words as hold them."""
    return keys.astype("<u4" if bits <= 32 else "<u8").tobytes()


def unpacked(keys: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(keys, "<u4" if bits <= 32 else "<u8").astype(np.int64)


def seen(docs: DataFrame, depth: int = DEPTH, word_parts: int = WORD_PARTS) -> DataFrame:
    """chunk, part, keys, n: what each chunk's texts hold, n times in training texts.

    ``docs``: row, held_out, text.
    """
    low = 8 * (depth - 1)  # bits of a gram below its two nearest bytes

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (t.as_py() for t in batch.column(2)), strict=True)

        def emitted(chunk, keys, counts, words):
            g, n = _sums(keys, counts)
            near = g >> low
            first = np.flatnonzero(np.diff(near, prepend=-1))
            made = []
            for i, j in zip(first, [*first[1:], len(g)]):
                made.append((int(near[i]), packed(g[i:j] & (1 << low) - 1, low), n[i:j].astype("<u4").tobytes()))
            dealt: dict[int, list[bytes]] = {}
            for w in words:
                dealt.setdefault(FIRST_WORD_PART + crc32(w) % word_parts, []).append(w)
            for at, mine in dealt.items():
                made.append((at, b"\n".join(mine), np.array([words[w] for w in mine], "<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(made), chunk)), pa.array([m[0] for m in made], pa.int32()), *(pa.array([m[i] for m in made], pa.binary()) for i in (1, 2))],
                names=["chunk", "part", "keys", "n"],
            )

        chunk, keys, counts, words = None, [], [], Counter()
        for part in _by_size(rows()):
            for at in dict.fromkeys(r[0] >> CHUNK_BITS for r in part):
                if chunk is not None and at != chunk:
                    yield from emitted(chunk, keys, counts, words)
                    keys, counts, words = [], [], Counter()
                chunk = at
                mine = [r for r in part if r[0] >> CHUNK_BITS == at]
                for held_out in (False, True):
                    texts = [tokens(r[2]) for r in mine if r[1] == held_out]
                    if not texts:
                        continue
                    g, n = np.unique(grams(texts, depth)[0], return_counts=True)
                    keys.append(g)
                    counts.append(n * (not held_out))
                    for t in texts:
                        if held_out:
                            words.update(dict.fromkeys(t, 0))
                        else:
                            words.update(t)
                if len(keys) > 16:
                    k, n = _sums(keys, counts)
                    keys, counts = [k], [n]
        if chunk is not None:
            yield from emitted(chunk, keys, counts, words)

    return docs.mapInArrow(gather, _SEEN)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function of positive numbers, by Stirling's series from 8 on."""
    x = np.array(x, float)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        if not low.any():
            break
        shift[low] -= np.log(x[low])
        x[low] += 1
    r = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x


def block_log(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of a zeros and b ones, as a logarithm."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


class Level:
    """Nodes of one depth: counts, own and weighted probability, and the weight of the own one."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.zeros, self.ones = zeros, ones
        own = block_log(zeros, ones)
        self.weighted = own if below is None else np.logaddexp(own, below) - np.log(2)
        self.weight = np.ones(len(own)) if below is None else np.exp(own - np.log(2) - self.weighted)
        self.one = (ones + 0.5) / (zeros + ones + 1)

    def mixed(self, so_far: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a one from all depths so far, and the share left to deeper ones."""
        return so_far + left * self.weight * self.one, left * (1 - self.weight)


def tree(g: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[list[tuple[np.ndarray, np.ndarray, Level]], np.ndarray]:
    """Levels from ``depth`` up to ``top``, each with its keys and the place of each finer key in them."""
    k = np.arange(8)
    symbol = (g & 255)[:, None]
    node = 1 << k | symbol >> (8 - k)
    bit = (symbol >> (7 - k) & 1).ravel()
    fine = ((g >> 8 << 8)[:, None] | node).ravel()
    counts = np.repeat(n.astype(float), 8)
    zeros, ones, below = counts * (1 - bit), counts * bit, None
    levels = []
    for d in range(depth, top - 1, -1):
        keys, place = np.unique(fine, return_inverse=True)
        add = lambda x: np.bincount(place, x, len(keys))  # noqa: B023, E731
        level = Level(add(zeros), add(ones), None if below is None else add(below))
        levels.append((keys, place, level))
        zeros, ones, below = level.zeros, level.ones, level.weighted
        fine = keys >> 16 << 8 | keys & 255  # without the farthest byte of the context
    return levels, bit


def merged(found: DataFrame, depth: int) -> DataFrame:
    """part, keys, n over all chunks; total and positive: the sum of n, and how many are above 0."""
    low = 8 * (depth - 1)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        counts = [np.frombuffer(x, "<u4" if i else "<u8") for x, i in zip(rows.column("n").to_pylist(), rows.column("first").to_pylist())]
        if part < FIRST_WORD_PART:
            k, n = _sums([unpacked(x, low) for x in rows.column("keys").to_pylist()], [c.astype(np.int64) for c in counts])
            keys = packed(k, low)
        else:
            sums = Counter()
            for x, c in zip(rows.column("keys").to_pylist(), counts):
                for w, i in zip(x.split(b"\n"), c.tolist()):
                    sums[w] += i
            keys, n = b"\n".join(sums), np.array(list(sums.values()), np.int64)
        values = [part], [keys], [n.astype("<u8").tobytes()], [int(n.sum())], [int((n > 0).sum())]
        types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array(v, t) for v, t in zip(values, types)], names=["part", "keys", "n", "total", "positive"])

    # Counts of one chunk fit 32 bits, sums get 64; "first" tells merge which it reads.
    spans = found.withColumn("first", F.lit(True)).select("part", "span", "keys", "n", "first")
    once = spans.groupBy("part", "span").applyInArrow(merge, _MERGED)
    return once.withColumn("first", F.lit(False)).groupBy("part").applyInArrow(merge, _MERGED)


def facts(counted: DataFrame, depth: int) -> DataFrame:
    """part, keys, facts: log10 probabilities of the grams of a part (32-bit), or counts of its words (64-bit)."""
    low = 8 * (depth - 1)

    def levels_of(row: dict) -> tuple:
        g = np.int64(row["part"]) << low | unpacked(row["keys"], low)
        return tree(g, np.frombuffer(row["n"], "<u8"), depth, 2)

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, _, level = levels_of(row)[0][-1]
                made = [keys >> 16, keys & 255, level.zeros.astype(np.int64), level.ones.astype(np.int64), level.weighted]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["first", "node", "zeros", "ones", "weighted"])

    grams_ = counted.where(F.col("part") < FIRST_WORD_PART).select("part", "keys", "n")
    tops = grams_.mapInArrow(roots, "first long, node long, zeros long, ones long, weighted double")
    # Exact sums of rounded logarithms, so that reruns agree to the last bit.
    tops = tops.groupBy("first", "node").agg(F.sum("zeros").alias("a"), F.sum("ones").alias("b"), F.sum(F.col("weighted").cast("decimal(30,9)")).cast("double").alias("w"))
    first, node, a, b, w = (np.array(x) for x in zip(*tops.orderBy("first", "node").collect() or [(0, 1, 0, 0, 0.0)]))
    upper = Level(a.astype(float), b.astype(float), w.astype(float))
    total = lambda x: np.bincount(node, x, 256)
    root = Level(total(upper.zeros), total(upper.ones), total(upper.weighted))
    p, r = root.mixed(np.zeros(256), np.ones(256))
    # First bytes that no gram has are not asked for.
    so_far, left = np.full((256, 256), 0.5), np.zeros((256, 256))
    so_far[first, node], left[first, node] = upper.mixed(p[node], r[node])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] < FIRST_WORD_PART:
                    levels, bit = levels_of(row)
                    keys, _, level = levels[-1]
                    p, r = level.mixed(so_far[keys >> 16, keys & 255], left[keys >> 16, keys & 255])
                    for i in range(len(levels) - 1, 0, -1):
                        above = levels[i][1]  # place of the finer keys in this level
                        p, r = levels[i - 1][2].mixed(p[above], r[above])
                    one = p[levels[0][1]]
                    found = np.log10(np.where(bit == 1, one, 1 - one)).reshape(-1, 8).sum(axis=1).astype("<f4").tobytes()
                else:
                    found = row["n"]
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([row["keys"]], pa.binary()), pa.array([found], pa.binary())], names=["part", "keys", "facts"])

    return counted.select("part", "keys", "n").mapInArrow(leaves, _FACTS)


def picked(found: DataFrame, known: DataFrame, depth: int) -> DataFrame:
    """chunk, part, keys, facts: for each chunk the facts of its own keys."""
    low = 8 * (depth - 1)

    def pick(key: tuple, rows: pa.Table, facts_: pa.Table) -> pa.Table:
        part, whole = key[0].as_py(), facts_.to_pylist()[0]
        mine = rows.column("keys").to_pylist()
        if part < FIRST_WORD_PART:
            keys, values = unpacked(whole["keys"], low), np.frombuffer(whole["facts"], "<f4")
            out = [values[np.searchsorted(keys, unpacked(x, low))].tobytes() for x in mine]
        else:
            count = dict(zip(whole["keys"].split(b"\n"), np.frombuffer(whole["facts"], "<u8").tolist()))
            out = [np.array([count[w] for w in x.split(b"\n")], "<u8").tobytes() for x in mine]
        return pa.table([rows.column("chunk"), rows.column("part"), rows.column("keys"), pa.array(out, pa.binary())], names=["chunk", "part", "keys", "facts"])

    rows = found.select("chunk", "part", "keys", "span")
    spans = rows.select(F.col("part").alias("_part"), F.col("span").alias("_span")).distinct()
    copies = known.join(spans, F.col("part") == F.col("_part")).drop("_part")
    return rows.groupBy("part", "span").cogroup(copies.groupBy("part", "_span")).applyInArrow(pick, "chunk long, part int, keys binary, facts binary")


def scored(docs: DataFrame, known: DataFrame, n: int, v: int, ends: int, depth: int = DEPTH) -> DataFrame:
    """Scores of ``docs`` (chunk, doc_id, held_out, text) with what each chunk has to know (picked)."""
    base, low = n + 0.5 * (v + 1), 8 * (depth - 1)

    def score(key: tuple, part: pa.Table, facts_: pa.Table) -> pa.Table:
        g, p, count = [], [], {}
        for row in sorted(facts_.select(["part", "keys", "facts"]).to_pylist(), key=lambda r: r["part"]):
            if row["part"] < FIRST_WORD_PART:
                g.append(np.int64(row["part"]) << low | unpacked(row["keys"], low))
                p.append(np.frombuffer(row["facts"], "<f4"))
            else:
                count.update(zip(row["keys"].split(b"\n"), np.frombuffer(row["facts"], "<u8").tolist()))
        g, p = np.concatenate(g), np.concatenate(p).astype(float)  # in order: by part, and inside a part
        out = []
        rows = zip(part.column("doc_id").to_pylist(), part.column("held_out").to_pylist(), (t.as_py() for t in part.column("text")), strict=True)
        for piece in _by_size(rows):
            texts = [tokens(r[2]) for r in piece]
            each, sizes = grams(texts, depth)
            some, place = np.unique(each, return_inverse=True)  # far fewer than bytes, and sorted: cheap to look up
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            model = np.add.reduceat(p[np.searchsorted(g, some)][place], starts)
            c = np.array([x for t in texts for x in (*map(count.__getitem__, t), ends)], float)
            lengths = np.array([len(t) + 1 for t in texts])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            plain = np.add.reduceat(np.log10((c + 0.5) / base), starts)
            known_ = np.add.reduceat((c > 0).astype(np.int64), starts)
            out += list(zip((r[0] for r in piece), (r[1] for r in piece), lengths.tolist(), known_.tolist(), plain.tolist(), model.tolist(), sizes.tolist()))
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes"]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return docs.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(score, _SCORED)


def context_tree_scores(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """Every text of ``docs`` scored by the model of the texts for which ``held_out`` (of the key) is false."""
    rows = numbered(docs.select(key, text)).select(
        F.col(ROW).alias("row"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"), F.col(key).cast("long").alias("doc_id")
    )
    found = written(seen(rows.select("row", "held_out", "text"), depth), "ctw-seen")
    spans = -(-found.select("chunk").distinct().count() // SPAN) or 1
    found = found.withColumn("span", F.pmod(F.xxhash64("chunk"), F.lit(spans)))
    counted = written(merged(found, depth), "ctw-counts")
    sums = counted.where(F.col("part") >= FIRST_WORD_PART).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("positive"), F.lit(0)).alias("v")).first()
    ends = rows.where("not held_out").count()
    n, v = sums["n"] + ends, sums["v"] + (ends > 0)
    known = picked(found, written(facts(counted, depth), "ctw-facts"), depth)
    placed = rows.select(F.shiftright("row", CHUNK_BITS).alias("chunk"), "doc_id", "held_out", "text")
    return scored(placed, known, n, v, ends, depth).withColumn("train_tokens", F.lit(n).cast("long"))


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = context_tree_scores(docs, fold(F.col("doc_id")) == 1)
    bits = -F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", bits.alias("bits_per_byte"))
