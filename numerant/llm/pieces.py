"""SentencePiece encoding with distinct sampled segmentations, and decoding.

A text is written as the vocabulary's model writes it: a mark for each blank and one in front, nothing else
changed. Its lattice has an edge for each piece at each place; a character that is no piece is one edge of byte
pieces. Piece scores of a merge vocabulary are ranks, so a piece's probability falls as one over its
rank (Zipf), raised to ``alpha``. No piece goes on after a blank or a line feed, so the lattice of a text is
the chain of the lattices of its words, and each distinct word of a batch is built once.

Sampling is Gumbel top-k without replacement: a partial segmentation has as its priority the largest
Gumbel-perturbed log-probability among its completions, drawn top-down. On the way down one edge of
each node inherits the priority (chosen by its probability); the best of the others is a Gumbel number of their joint
probability, cut off at the priority. The priority is exact, so best-first (A*) search follows
one path to its end; the next distinct segmentation starts at the best branch left aside so far, and
what is then left at that node is a branch again. A batch's texts go through each of the k rounds
together as arrays. All draws are hashes of (row key, round, word, step): no state, the same samples
in whatever task the row is.

``inclusion`` is the chance that a sample of this size holds the segmentation, given the best branch left
aside (kappa): 1 - exp(-exp(log_probability - kappa)). Sums over samples weighted by probability over
inclusion estimate sums over all segmentations.

Defined results: a null or empty text has one segmentation, without pieces, of probability and inclusion 1; a
text with fewer segmentations than asked for gives all it has, the last ones with inclusion 1; equal rows
(key and text) get equal samples; a null key is a key; an empty table gives an empty result; other
columns are kept, and columns named like those added here are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, settled, slices, table, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
ADDED = ("sample", "ids", "log_probability", "inclusion", "round_trip")


class Table:
    """Values by 64-bit keys: each key has one of two places, and a lookup looks at both."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = np.append(keys, np.uint64(0)), np.append(values, -2)
        for bits in range(12, 26):
            self.bits = bits
            self.one, self.two = np.full((2, 1 << bits), len(keys), np.int32)
            spread_ = mixed(keys)
            rest = self._put(self.one, self._first(spread_), np.arange(len(keys)))
            if not len(self._put(self.two, self._second(spread_[rest]), rest)):
                return
        raise ValueError("keys are not distinct")

    def _first(self, spread_: np.ndarray) -> np.ndarray:
        return spread_ >> np.uint64(64 - self.bits)

    def _second(self, spread_: np.ndarray) -> np.ndarray:
        return spread_ & np.uint64((1 << self.bits) - 1)

    @staticmethod
    def _put(table: np.ndarray, places: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The numbers that found no free place."""
        table[places] = numbers
        return numbers[table[places] != numbers]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are there, by their place in ``keys``, and their values."""
        spread_ = mixed(keys)
        at = self.one[self._first(spread_)]
        missed = np.flatnonzero(self.keys[at] != keys)
        at[missed] = self.two[self._second(spread_[missed])]
        here = np.flatnonzero(self.keys[at] == keys)
        return here, self.values[at[here]]


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with log-probabilities, and the ids of the byte pieces."""

    pieces: tuple[str, ...]
    logs: np.ndarray
    bytes_at: int  # id of byte 0; the others follow
    ordinary: np.ndarray  # whether a piece may match text

    @cached_property
    def prefixes(self) -> list[Table]:
        """For each length all beginnings of pieces by their hashes, with the piece's id or -1."""
        by_length: list[dict[int, int]] = []
        for i, p in enumerate(self.pieces):
            if not self.ordinary[i]:
                continue
            h = 0
            for n, ch in enumerate(p):
                h = (h * 0x9E3779B97F4A7C15 + ord(ch) + 1) & (2**64 - 1)
                if n == len(by_length):
                    by_length.append({})
                by_length[n][h] = i if n + 1 == len(p) else by_length[n].get(h, -1)
        return [Table(np.array(list(d), np.uint64), np.array(list(d.values()), np.int64)) for d in by_length]

    @cached_property
    def raw(self) -> list[bytes]:
        """What each piece adds to a decoded text."""
        out = [p.replace(MARK, " ").encode() if o else b"" for p, o in zip(self.pieces, self.ordinary)]
        out[self.bytes_at : self.bytes_at + 256] = [bytes([b]) for b in range(256)]
        return out

    @cached_property
    def table(self) -> pa.Array:
        return pa.array(self.raw, pa.binary())

    def decode_all(self, ids: np.ndarray, sizes: list[int]) -> list[bytes]:
        """The UTF-8 of several texts, whose ids follow each other."""
        found = self.table.take(pa.array(ids))
        if not len(found):
            return [b""] * len(sizes)
        data, ends = found.buffers()[2].to_pybytes(), np.frombuffer(found.buffers()[1], np.int32)
        cuts = ends[np.cumsum([0, *sizes])]
        return [data[i + 1 : j] for i, j in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids))[1:].decode()


def vocabulary(path: str = MODEL, alpha: float = 1.0, head: float = 10.0) -> Vocabulary:
    """The pieces of a SentencePiece model file, read on the driver."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    ordinary = np.array([not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)])
    rank = np.array([-model.get_score(i) if o else 0.0 for i, o in enumerate(ordinary)])
    rank[~ordinary] = rank.max() + 1
    logs = -np.log(rank + head)
    logs = alpha * (logs - np.log(np.exp(logs[ordinary]).sum()))
    first = next(i for i in range(n) if model.is_byte(i))
    return Vocabulary(tuple(model.id_to_piece(i) for i in range(n)), logs, first, ordinary)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def uniform(h: np.ndarray) -> np.ndarray:
    """A number between 0 and 1, exclusive, from each hash."""
    return ((mixed(h) >> np.uint64(12)).astype(float) + 0.5) * 2.0**-52


def gumbel(h: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform(h)))


def cut_off(value, most):
    """A Gumbel number on condition that it is below ``most``."""
    return most - np.logaddexp(0.0, most - value)


def words_of(text: str) -> list[str]:
    """The text's words with their marks: no piece spans two of them."""
    if not text:
        return []
    if "  " in text or MARK in text:
        return re.findall("\n|▁+[^▁\n]*|[^▁\n]+", MARK + text.replace(" ", MARK))
    return [w for w in (MARK + text.replace("\n", " \n ").replace(" ", " ▁").replace(" ▁\n ▁", " \n ")).split(" ") if w]


class Lattice:
    """Edges of all words: a node for each place in a word and one behind it."""

    def __init__(self, words: list[str], vocab: Vocabulary):
        sizes = np.array([len(w) for w in words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        self.end = self.start + sizes
        n = int((sizes + 1).sum())
        codes = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        ends = np.repeat(self.end, sizes + 1)  # of the word of each node
        at = np.flatnonzero(np.arange(n) < ends)
        h = np.zeros(len(at), np.uint64)
        tos, ids = [], []
        covered = np.zeros(n, bool)
        count = np.zeros(n + 1, np.int32)
        for length, known in enumerate(vocab.prefixes, 1):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[at + (length - 1)] + np.uint64(1)
            here, found = known.find(h)
            at, h = at[here], h[here]
            hit = found >= 0
            tos.append((length, at[hit]))
            ids.append(found[hit])
            count[tos[-1][1]] += 1  # a node has one edge of each length at most
            if length == 1:
                covered[tos[-1][1]] = True
            go = at + length < ends[at]
            at, h = at[go], h[go]
        missing = np.flatnonzero(~covered & (np.arange(n) < ends))
        count[missing] += 1
        single = codes[missing] < 0x80  # one byte, or, as a negative number, a character of several
        tos.append((1, missing))
        ids.append(np.where(single, codes[missing].astype(np.int64) + vocab.bytes_at, -codes[missing].astype(np.int64)))
        self.first = np.cumsum(count) - count  # edges of node i: first[i] to first[i + 1]
        edges = int(count.sum())
        self.to, self.id, self.node = (np.empty(edges, np.int32) for _ in range(3))
        logs = np.empty(edges)
        fill = self.first.copy()
        for (length, at), found in zip(tos, ids):
            e = fill[at]
            fill[at] += 1
            self.to[e], self.id[e], self.node[e] = at + length, found, at
            logs[e] = vocab.logs[np.maximum(found, 0)]
        e = fill[missing] - 1
        size = 1 + (codes[missing] > 0x7F).astype(int) + (codes[missing] > 0x7FF) + (codes[missing] > 0xFFFF)
        logs[e] = size * vocab.logs[vocab.bytes_at]
        beta = np.zeros(n)  # log of the sum over all ways to the word's end
        left = ends - np.arange(n)
        longest = int(left.max(initial=0))
        nodes = np.argsort(left.astype(np.uint16) if longest < 1 << 16 else left, kind="stable")
        bounds = np.cumsum(np.bincount(left, minlength=longest + 1)) if n else np.zeros(1, np.int64)
        for i, j in zip(bounds[:-1], bounds[1:]):
            these = nodes[i:j]
            counts = count[these]
            e, offsets = spread(self.first[these], counts)
            x = logs[e] + beta[self.to[e]]
            top = np.maximum.reduceat(x, offsets)
            beta[these] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, counts)), offsets))
        # Of taking the edge, at its node: they sum to one. Rounded, so that a batch's layout leaves no trace.
        self.log = np.round(logs + beta[self.to] - beta[self.node], 12)
        run = np.cumsum(np.exp(self.log))
        self.upto = run - np.concatenate([[0.0], run])[self.first[self.node]]  # this edge or an earlier one of its node
        self.upto[self.first[1:][count[:-1] > 0] - 1] = 2.0
        self.single = count[self.node] == 1


def spread(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All edges of some nodes, one node after the other, and where each node's begin."""
    offsets = np.cumsum(counts) - counts
    return np.repeat(first - offsets, counts) + np.arange(int(counts.sum())), offsets


@dataclass
class Branch:
    """What is left at a node of a path: its edges but those taken, with the best priority among them."""

    priority: float
    path: int
    kept: int  # edges of the path before the node
    word: int
    taken: list[int]
    before: float  # log-probability before the node
    salt: int


def _branch_off(b: Branch, lattice: Lattice) -> tuple[int, Branch | None]:
    """The edge that has the branch's priority, and the branch of what is left then."""
    node = int(lattice.node[b.taken[0]])
    edges = [e for e in range(int(lattice.first[node]), int(lattice.first[node + 1])) if e not in b.taken]
    share = [math.exp(lattice.log[e]) for e in edges]
    draws = uniform(mixed(np.array([b.salt, b.salt ^ 1], np.uint64)) + np.uint64(len(b.taken))).tolist()
    most, at = draws[0] * sum(share), 0
    while at + 1 < len(edges) and most > share[at]:
        most -= share[at]
        at += 1
    if len(edges) == 1:
        return edges[at], None
    rest = math.log(max(sum(share) - share[at], 1e-300)) + b.before
    value = float(cut_off(rest - math.log(-math.log(draws[1])), b.priority))
    return edges[at], Branch(value, b.path, b.kept, b.word, [*b.taken, edges[at]], b.before, b.salt)


def sample(texts: list[list[int]], keys: np.ndarray, lattice: Lattice, k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text (words by number) up to ``k`` distinct segmentations: edges, log-probability, inclusion."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    unit = np.concatenate([np.array(t, np.int64) for t in texts]) if n else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(n), sizes)
    start, stop = lattice.start[unit], lattice.end[unit]
    place_in_text = (np.arange(len(unit)) - begin[doc]).astype(np.uint64)
    odd = [np.array([x], np.uint64) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    seeds = mixed(keys.view(np.uint64) + odd[0])
    aside: list[list[Branch]] = [[] for _ in range(n)]
    paths: list[list[np.ndarray]] = [[] for _ in range(n)]
    logs: list[list[float]] = [[] for _ in range(n)]
    # What a round starts from, for each text: word, node, log-probability so far, edges kept, priority.
    live = np.flatnonzero(sizes > 0)
    first_word = begin[:-1][live]
    node0, log0 = start[first_word], np.zeros(len(live))
    kept = [np.zeros(0, np.int64)] * len(live)
    priority = gumbel(seeds[live] ^ np.uint64(1))
    for r in range(k):
        if not len(live):
            break
        counts = begin[live + 1] - first_word
        w, offsets = spread(first_word, counts)  # words still to be cut
        at, ends = start[w].copy(), stop[w]
        at[offsets] = node0
        so_far = np.zeros(len(w))
        salt = mixed(mixed(seeds[doc[w]] + odd[1] * np.uint64(r + 1)) + odd[2] * place_in_text[w])
        active = np.flatnonzero(at < ends)
        v_word, v_edge, v_before, v_salt = [], [], [], []
        step = 0
        while len(active):
            h = salt[active] + odd[3] * np.uint64(step)
            u = uniform(h)
            edge = lattice.first[at[active]]
            late = np.flatnonzero(u > lattice.upto[edge])
            while len(late):
                edge[late] += 1
                late = late[u[late] > lattice.upto[edge[late]]]
            v_word.append(active)
            v_edge.append(edge)
            v_before.append(so_far[active])
            v_salt.append(h)
            so_far[active] += lattice.log[edge]
            at[active] = lattice.to[edge]
            step += 1
            active = active[at[active] < ends[active]]
        joined = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        word, edge, inside, salts = joined(v_word, np.int64), joined(v_edge, np.int64), joined(v_before, float), joined(v_salt, np.uint64)
        order = np.argsort(word, kind="stable")  # visits in the order of the text
        word, edge, inside, salts = word[order], edge[order], inside[order], salts[order]
        # Log-probability in front of each word: what the text had, and all its words before.
        run = np.cumsum(so_far) - so_far
        of_word = np.repeat(np.arange(len(live)), counts)
        front = run - run[offsets][of_word] + log0[of_word]
        total = log0 + np.add.reduceat(so_far, offsets)
        cuts = np.searchsorted(word, np.concatenate([offsets, [len(w)]]))
        for i, t in enumerate(live.tolist()):
            paths[t].append(np.concatenate([kept[i], edge[cuts[i] : cuts[i + 1]]]))
            logs[t].append(float(total[i]))
        of = of_word[word]
        before = front[word] + inside
        some = np.flatnonzero(~lattice.single[edge])
        if len(some):
            rest = np.log1p(-np.minimum(np.exp(lattice.log[edge[some]]), 1 - 2.0**-53))
            best = cut_off(before[some] + rest + gumbel(salts[some] + odd[0]), priority[of[some]])
            here, firsts = np.unique(of[some], return_index=True)
            width = np.diff(np.concatenate([firsts, [len(some)]]))
            for _ in range(k - r):  # one more than the paths to come: the last is kappa
                top = np.maximum.reduceat(best, firsts)
                hit = np.flatnonzero(best == np.repeat(top, width))
                hit = hit[np.unique(of[some[hit]], return_index=True)[1]]
                for x in hit[best[hit] > -np.inf].tolist():
                    v = some[x]
                    i = of[v]
                    t = live[i]
                    aside[t].append(Branch(float(best[x]), len(paths[t]) - 1, len(kept[i]) + int(v - cuts[i]), int(w[word[v]]), [int(edge[v])], float(before[v]), int(salts[v])))
                best[hit] = -np.inf
        if r + 1 < k:
            going = [t for t in live.tolist() if aside[t]]
            picks = []
            for t in going:
                b = aside[t].pop(max(range(len(aside[t])), key=lambda j: aside[t][j].priority))
                e, left = _branch_off(b, lattice)
                if left:
                    aside[t].append(left)
                picks.append((b, e))
            live = np.array(going, np.int64)
            first_word = np.array([b.word for b, _ in picks], np.int64)
            taken = np.array([e for _, e in picks], np.int64)
            node0 = lattice.to[taken]
            log0 = np.array([b.before for b, _ in picks]) + lattice.log[taken]
            kept = [np.concatenate([paths[t][b.path][: b.kept], [e]]) for t, (b, e) in zip(going, picks)]
            priority = np.array([b.priority for b, _ in picks])
    out = []
    for t in range(n):
        if not sizes[t]:
            out.append([(np.zeros(0, np.int64), 0.0, 1.0)])
            continue
        kappa = max((b.priority for b in aside[t]), default=-np.inf)
        chance = [float(-np.expm1(-np.exp(min(x - kappa, 50.0)))) for x in logs[t]]
        out.append(list(zip(paths[t], logs[t], chance)))
    return out


def edge_ids(edges: np.ndarray, lattice: Lattice, vocab: Vocabulary) -> np.ndarray:
    """Piece ids of a path; a character that is no piece becomes its bytes."""
    ids = lattice.id[edges]
    if len(ids) and ids.min() < 0:
        ids = np.array([x for i in ids.tolist() for x in ([i] if i >= 0 else [vocab.bytes_at + b for b in chr(-i).encode("utf-8")])])
    return ids


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = 2, seed: int = 0, vocab: Vocabulary | None = None) -> DataFrame:
    """``docs`` with sample (0 is the likeliest when perturbed), ids, log_probability, inclusion, round_trip.

    A row for each sample; round_trip says that decoding the ids gives the text again.
    """
    vocab = vocab or vocabulary()
    docs = docs.drop(*ADDED)
    fields = docs.schema.fields
    text_, key_ = fresh(docs, "text_read", "key_read")
    schema = T.StructType([*fields, *T._parse_datatype_string("sample int, ids array<int>, log_probability double, inclusion double, round_trip boolean").fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_, 1 << 20):
                texts = part.column(part.schema.get_field_index(text_)).to_pylist()
                known: dict[str, int] = {}
                numbers = [[known.setdefault(w, len(known)) for w in words_of(t)] for t in texts]
                lattice = Lattice(list(known), vocab)
                keys = part.column(part.schema.get_field_index(key_)).to_numpy(zero_copy_only=False)
                rows, values, ids = [], [], []
                for i, found in enumerate(sample(numbers, keys, lattice, samples)):
                    for j, (edges, log, chance) in enumerate(found):
                        rows.append(i)
                        ids.append(edge_ids(edges, lattice, vocab).astype(np.int32))
                        values.append((j, round(log, 6), float(f"{chance:.6g}")))
                sizes = [len(x) for x in ids]
                flat = np.concatenate(ids)
                raw = [t.encode() for t in texts]
                same = [d == raw[i] for i, d in zip(rows, vocab.decode_all(flat, sizes))]
                kept = part.select([f.name for f in fields]).take(pa.array(rows, pa.int64()))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat))
                numbers_ = [pa.array([v[c] for v in values], t) for c, t in enumerate((pa.int32(), pa.float64(), pa.float64()))]
                added = [numbers_[0], lists, *numbers_[1:], pa.array(same)]
                yield pa.RecordBatch.from_arrays([*kept.columns, *added], names=[*kept.schema.names, *ADDED])

    mark = F.xxhash64(F.lit(seed), F.col(key).cast("string"))
    return docs.withColumns({text_: text_of(text), key_: mark}).mapInArrow(encode, schema)


def decoded(rows: DataFrame, ids: str = "ids", text: str = "text", vocab: Vocabulary | None = None) -> DataFrame:
    """``rows`` with the text that the ids stand for in column ``text``; null ids give null."""
    vocab = vocab or vocabulary()
    rows = rows.drop(text)
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = pa.array([None if x is None else vocab.decode(x) for x in column], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text])

    return rows.mapInArrow(decode, schema)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs).select(
        "doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_probability", "inclusion", "round_trip"
    )


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' keys and sources with the ids of two distinct segmentations each."""
    settled(spark)
    return encoded(docs.select("doc_id", "lang", "source", "text")).drop("text")
