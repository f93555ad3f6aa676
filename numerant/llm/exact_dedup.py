"""Exact deduplication with a minimal perfect hash over the distinct digests of history.

``build`` turns the distinct digests of historical rows into an index: digests are dealt by their
first bits into parts of bounded size, each part gets a minimal perfect hash (levels of bits; a key
alone on its bit has found its place, the others go to the next level; the slot is the number of set
bits before it), and slot i of the part holds the full digest, the rows seen and the winner's
locator. ``dedup`` sends the distinct digests of new rows to the parts. The hash gives any digest
some slot, so the slot's digest is compared byte by byte: an equal one is a repeat of history, all
others are grouped among themselves.

Texts are equal if they are identical without the characters of ``[\\x20\\x09-\\x0D]``. Of equal texts
the row with the most code points stays, then the smallest key, then the first row.

Defined results: a null text is the empty text, and all of those are one group; a null key comes
after all others; of rows repeated with key and text exactly one is kept; empty history or input
gives an empty index or result; other columns are ignored.

Copies meet only as counts: rows are aggregated by digest before any exchange, and the verdict goes
back to the rows by a join on the digest that Spark splits where one digest is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, fold, numbered, packed, table, text_of, written

PART_KEYS = 200_000  # digests in one part of the index: about 15 MB
MOST_LEVELS = 64
SPACES = "\t\n\v\f\r "

_GROUP = "digest binary, n long, longest long, last boolean, key long, row long"
_INDEX = "part long, levels array<long>, bits binary, digests binary, n array<long>, longest array<long>, last array<boolean>, key array<long>, row array<long>"
_INDEX_SCHEMA = pa.schema(  # spelled out: a part whose keys are all null would otherwise have a column of no type
    [("part", pa.int64()), ("levels", pa.list_(pa.int64())), ("bits", pa.binary()), ("digests", pa.binary()), ("n", pa.list_(pa.int64())), ("longest", pa.list_(pa.int64()))]
    + [("last", pa.list_(pa.bool_())), ("key", pa.list_(pa.int64())), ("row", pa.list_(pa.int64()))]
)
_FOUND = "digest binary, member boolean, slot long, group_size long, keep_id long, keep_row long"


def digest(text: Column) -> Column:
    """SHA-256 of the text without white space."""
    return F.unhex(F.sha2(F.translate(text, SPACES, ""), 256))


def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """A bit for each digest (rows of four 64-bit words) at a level of ``size`` bits."""
    h = np.full(len(words), 0x9E3779B97F4A7C15 * (level + 1) % 2**64, np.uint64)
    for j in range(4):
        h = (h ^ words[:, j]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return (h % np.uint64(size)).astype(np.int64)


def _words(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, dtype="<u8").reshape(-1, 4)


def perfect_hash(digests: bytes, gamma: float = 2.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, bits of all levels, and the slot of each 32-byte digest; digests are distinct."""
    words = _words(digests)
    left, sizes, levels, place = np.arange(len(words)), [], [], np.zeros(len(words), np.int64)
    start = 0
    while len(left):
        if len(sizes) == MOST_LEVELS:
            raise ValueError("digests of a part are not distinct")
        size = max(64, int(gamma * len(left)))
        at = _positions(words[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        place[left[mine]] = start + at[mine]
        sizes.append(size)
        levels.append(alone)
        start += size
        left = left[~mine]
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    rank = np.cumsum(bits) - bits
    return sizes, bits, rank[place] if len(words) else place


def slots(digests: bytes, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot the hash gives each digest, member or not; -1 where no level has a bit for it."""
    words = _words(digests)
    found, rank, start = np.full(len(words), -1, np.int64), np.cumsum(bits) - bits, 0
    left = np.arange(len(words))
    for level, size in enumerate(sizes):
        at = start + _positions(words[left], level, size)
        hit = bits[at]
        found[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    return found


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def _build_part(key: tuple, part: pa.Table) -> pa.Table:
    raw = _joined(part.column("digest"))
    sizes, bits, slot = perfect_hash(raw)
    order = np.argsort(slot)
    part = part.take(pa.array(order))
    row = {"part": [key[0].as_py()], "levels": [sizes], "bits": [np.packbits(bits).tobytes()], "digests": [_joined(part.column("digest"))]}
    row |= {c: [part.column(c).to_pylist()] for c in ("n", "longest", "last", "key", "row")}
    return pa.table(row, schema=_INDEX_SCHEMA)


def _look_up(key: tuple, new: pa.Table, index: pa.Table) -> pa.Table:
    """One row for each digest of the index part and of the new rows; histories merged with new rows."""
    old = {c: index.column(c).to_pylist()[0] if index.num_rows else [] for c in ("n", "longest", "last", "key", "row")}
    held = index.column("digests").to_pylist()[0] if index.num_rows else b""
    sizes = index.column("levels").to_pylist()[0] if index.num_rows else []
    packed = np.frombuffer(index.column("bits").to_pylist()[0] if index.num_rows else b"", np.uint8)
    bits = np.unpackbits(packed, count=sum(sizes)).astype(bool)
    raw = _joined(new.column("digest"))
    out: dict[str, list] = {c: [] for c in ("digest", "member", "slot", "group_size", "keep_id", "keep_row")}

    def add(digest_, member, slot, n, best):
        for c, v in zip(out, (digest_, member, slot, n, best[2], best[3]), strict=True):
            out[c].append(v)

    rank = lambda longest, last, k, r: (-longest, last, k if k is not None else 0, r)
    seen = set()
    for i, (slot, d) in enumerate(zip(slots(raw, sizes, bits).tolist(), new.to_pylist(), strict=True)):
        mine = (d["longest"], d["last"], d["key"], d["row"])
        if slot >= 0 and held[32 * slot : 32 * slot + 32] == raw[32 * i : 32 * i + 32]:
            kept = tuple(old[c][slot] for c in ("longest", "last", "key", "row"))
            add(d["digest"], True, slot, old["n"][slot] + d["n"], min(kept, mine, key=lambda x: rank(*x)))
            seen.add(slot)
        else:
            add(d["digest"], False, None, d["n"], mine)
    for slot in range(len(old["n"])):
        if slot not in seen:
            add(held[32 * slot : 32 * slot + 32], True, slot, old["n"][slot], tuple(old[c][slot] for c in ("longest", "last", "key", "row")))
    return pa.table(out, schema=pa.schema([("digest", pa.binary()), ("member", pa.bool_()), ("slot", pa.int64()), ("group_size", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64())]))


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """digest, length, key and number of each row: all that is needed after the text has been read once."""
    return numbered(docs).select(
        F.col(key).cast("long").alias("key"), F.col(ROW).alias("row"),
        digest(text_of(text)).alias("digest"), F.length(text_of(text)).cast("long").alias("length"),
    )


def _groups(rows: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("length")).alias("x"), F.col("key").isNull().alias("last"), "key", "row"))
    grouped = rows.groupBy("digest").agg(F.count("*").alias("n"), best.alias("b"))
    return grouped.select("digest", "n", (-F.col("b.x")).alias("longest"), "b.last", "b.key", "b.row")


def _part(parts: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(parts))


def build(history: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The index of keyed rows, and its number of parts; ``rows`` bounds the number of keys on either side."""
    parts = max(1, -(-rows // PART_KEYS))
    grouped = _groups(history).withColumn("part", _part(parts))
    return written(grouped.groupBy("part").applyInArrow(_build_part, _INDEX), "digest-index"), parts


def dedup(new: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """One row per distinct digest of history and the new keyed rows: its group and who stays."""
    grouped = _groups(new).withColumn("part", _part(parts))
    return grouped.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(_look_up, _FOUND)


def exact_groups(docs: DataFrame, historical: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its group: key, row, digest, member, group_size, keep_id, kept.

    Rows for which ``historical`` (of the key) holds are the history the index is built from.
    """
    base = docs.select(key, text)
    rows = written(keyed(base, key, text).withColumn("historical", F.coalesce(historical, F.lit(False))), "digests")
    # A part holds digests of both sides in one task, so the larger side sets their number.
    n = rows.groupBy("historical").count().agg(F.max("count").alias("n")).first()["n"] or 0
    index, parts = build(rows.where("historical"), n)
    found = dedup(rows.where("not historical"), index, parts)
    return rows.join(found, "digest").withColumn("kept", F.col("row") == F.col("keep_row"))


def in_history(key: Column) -> Column:
    """The half of the keys that stands for what was crawled before."""
    return fold(key, 2) == 0


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = exact_groups(docs, in_history(F.col("key")))
    return rows.select(
        F.col("key").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d
"""


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeats: of each group the row that stays."""
    keep = exact_groups(docs, in_history(F.col("key"))).where("kept").select(F.col("row").alias(ROW))
    return packed(docs).join(keep, ROW, "left_semi").select("doc.*")
