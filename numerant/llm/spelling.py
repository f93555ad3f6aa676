"""Spelling variants grouped by permuterm rotations.

``counted``: words are maximal runs of letters (A-Z, a-z and U+00C0 to U+00FF), with only A-Z lower-cased.
``slips`` says which run of which document loses a code point: the crc32 of ``<key>:<run>`` decides, so the
same run of a document always loses the same one. Counts are combined in each task before they are shuffled.

``neighbours``: a word x c y, closed by a terminator, is rotated to y $ x c for each code point c. Without
its last code point the rotation is y $ x, the prefix that it shares with x d y (c replaced) and with the whole
rotation of x y (c inserted). Rotations are dealt by range and sorted, so such a range of one prefix is one run of
rows; a scan of the run emits the neighbours in it. A run has at most one whole rotation and one
row per letter of the alphabet (at most 90), however large the vocabulary is. A word that repeats a letter (aab) reaches
x y (ab) by deleting either of the two; only the first counts, so no pair is emitted twice.

``rooted``: following a form leads to a word at least ``ratio`` times as frequent, so paths are short and have no
cycles; their ends are found by doubling the steps of a join.

Defined results: null and empty texts have no words; a null key reads as an empty one; rows with the same key
are separate documents; a run of any length is one word (beyond ``LONG`` code points a rotation is named by a polynomial hash
of 127 bits, so a word of n code points costs n short rows); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, numbered, slices, table, written

EVERY = 199  # one distinct run of a document in so many loses a code point
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5  # a form is at least so many times as frequent
LONG = 64
HELD = 500_000  # distinct words that a task counts before it hands them on
MODULUS = (1 << 127) - 1
BASE = 0x5DEECE66D1B54A32D192ED03A2A7 | 1


def slips(run: str, h: int, every: int = EVERY) -> str:
    """``run`` without the code point that the hash picks, or as it is."""
    if h % every:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = EVERY, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """word, n: words of at least ``letters`` code points that occur ``least`` times or more."""
    run = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % letters)  # a shorter run never yields a long enough word

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        out = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )
        for whole in batches:
            for batch in slices(whole, "text"):
                for name, raw in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                    head = zlib.crc32(f"{name}:".encode())
                    for found, n in Counter(run.findall(raw.lower())).items():  # bytes: only A-Z change
                        h = zlib.crc32(found, head)
                        if not h % every:
                            shorter = slips(found.decode(), h, every)
                            if len(shorter) < letters:
                                continue
                            found = shorter.encode()
                        held[found] = held.get(found, 0) + n
                    if len(held) > HELD:
                        yield out()
                        held.clear()
        if held:
            yield out()

    slim = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text")).where("text is not null")
    each = slim.mapInArrow(count, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def rotations(word: str) -> Iterator[tuple[str, int]]:
    """(prefix, kind): kind 0 is the whole rotation at a place, 1 and 2 skip its code point; 2 if the one before is the same."""
    if len(word) <= LONG:
        for i in range(len(word) + 1):
            yield f"{word[i:]}${word[:i]}", 0
        for i, c in enumerate(word):
            yield f"{word[i + 1:]}${word[:i]}", 1 + (i > 0 and word[i - 1] == c)
        return
    # The hash of y $ x from those of the beginnings of the word.
    upto, power = [0], [1]
    for c in word:
        upto.append((upto[-1] * BASE + ord(c)) % MODULUS)
        power.append(power[-1] * BASE % MODULUS)
    n = len(word)

    def named(x: int, y: int) -> str:  # x code points before the place, the word from y on after it
        tail = upto[n] - upto[y] * power[n - y]
        return f"{n - y + x}#{((tail * BASE + ord('$')) * power[x] + upto[x]) % MODULUS:032x}"

    for i in range(n + 1):
        yield named(i, i), 0
    for i, c in enumerate(word):
        yield named(i, i + 1), 1 + (i > 0 and word[i - 1] == c)


def neighbours(words: DataFrame) -> DataFrame:
    """id, n, near_id, near_n: both directions of each pair at one edit, once. ``words``: id, word, n."""

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["prefix", "kind", "id", "n"]
        for batch in batches:
            prefix, kind, ids, ns = [], [], [], []
            for i, word, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n"))):
                for p, k in rotations(word):
                    prefix.append(p), kind.append(k), ids.append(i), ns.append(n)
                    if len(prefix) >= 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(prefix), pa.array(kind, pa.int32()), pa.array(ids, pa.int64()), pa.array(ns, pa.int64())], names=names)
                        prefix, kind, ids, ns = [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(prefix, pa.string()), pa.array(kind, pa.int32()), pa.array(ids, pa.int64()), pa.array(ns, pa.int64())], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out = None, [], []

        def emit() -> None:
            for j, (kind, i, n) in enumerate(group):
                for other, near, near_n in group[j + 1 :]:
                    if kind and other or kind + other == 1:  # both skip a code point, or one whole rotation and a first of equal letters
                        out.extend(((i, n, near, near_n), (near, near_n, i, n)))

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)], names=["id", "n", "near_id", "near_n"])

        for batch in batches:
            for prefix, *row in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if prefix != now:
                    if len(group) > 1:
                        emit()
                    now, group = prefix, []
                group.append(row)
            if out:
                yield batch_of()
                out = []
        if len(group) > 1:
            emit()
        if out:
            yield batch_of()

    turned = words.select("id", "word", "n").mapInArrow(rotate, "prefix string, kind int, id long, n long")
    turned = turned.repartitionByRange("prefix").sortWithinPartitions("prefix", "kind")
    return turned.mapInArrow(scan, "id long, n long, near_id long, near_n long")


def rooted(forms: DataFrame) -> DataFrame:
    """id, root: the end of the path from id over ``forms`` (id, form_id)."""
    now = written(forms.select("id", F.col("form_id").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        now = written(now.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = EVERY, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root for each word."""
    words = written(counted(docs, key, text, every, letters, least), "spelling-words")
    words = numbered(words).withColumnRenamed(ROW, "id")
    near = written(neighbours(words), "spelling-near")
    counts = near.groupBy("id").agg(F.count("*").alias("n_near"))
    named = near.where(F.col("near_n") >= ratio * F.col("n")).join(words.select(F.col("id").alias("near_id"), "word"), "near_id")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "word", "near_id"))
    forms = named.groupBy("id").agg(best.alias("best"))
    forms = written(forms.select("id", F.col("best.near_id").alias("form_id"), F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = rooted(forms).join(words.select(F.col("id").alias("root"), F.col("word").alias("end")), "root").select("id", "end")
    full = words.join(counts, "id", "left").join(forms, "id", "left").join(ends, "id", "left")
    return full.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("end", "word").alias("root"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
