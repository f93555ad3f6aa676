"""Quality by compression: zstandard dictionaries of good and of bad text.

``fit`` trains one dictionary from texts labelled good and one from texts labelled bad. A text is
compressed with both, in equal blocks of at most ``BLOCK`` bytes that each start from the dictionary alone; the
difference of the sizes of all blocks per byte, ``(bad - good + PSEUDO * mean) / (bytes + PSEUDO)``, is positive if the good
dictionary serves it better. In one frame a long text would match itself, and its difference would tend to 0 with its length.
The PSEUDO bytes of an average text keep very short texts near the average. A logistic curve through labelled rows that no dictionary has seen,
weighted back to the labels' true shares, turns the difference into the probability of label 1.

Bounds of the fit (parameters): ``dictionary_rows`` rows per class for the dictionaries and
``calibration_rows`` per class for the curve, those with the smallest hash of the key, of at most
``longest`` code points. Scoring reads every whole text and nothing else: no label, language, source
or key enters a score.

Defined results: a null or empty text has the difference of an average text and so the score of one;
rows of unknown label, or labelled twice with different labels, count as they are labelled; without
any label of a class every text gets the share of label 1 (one half without labels); an empty table gives an empty result;
repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, fold, numbered, packed, table, text_of

PSEUDO = 48
BLOCK = 16_384


@dataclass(frozen=True)
class CompressionClassifier:
    """Two dictionaries and the curve; a few hundred kilobytes whatever the corpus."""

    good: bytes
    bad: bytes
    level: int
    mean: float
    slope: float
    offset: float

    def probability(self, difference: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * difference + F.lit(self.offset))))


def differences(docs: DataFrame, good: bytes, bad: bytes, level: int, mean: float, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``difference``: compressed sizes with the dictionaries, per byte."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sizer(raw: bytes):
            # Trained dictionaries have entropy tables; bytes too few to train are used as plain content.
            kept = zstandard.ZstdCompressionDict(raw)
            kept.precompute_compress(level=level)
            return zstandard.ZstdCompressor(level=level, dict_data=kept, write_content_size=False, write_dict_id=False)

        first, second = sizer(good), sizer(bad)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values = []
            for t in batch.column(at):
                raw = (t.as_py() or "").encode()
                size = -(-len(raw) // max(1, -(-len(raw) // BLOCK)))
                blocks = [raw[i : i + size] for i in range(0, len(raw), size)] if raw else []
                gap = sum(len(second.compress(b)) - len(first.compress(b)) for b in blocks)
                values.append((gap + PSEUDO * mean) / (len(raw) + PSEUDO))
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest] + [pa.array(values, pa.float64())],
                names=[batch.schema.names[i] for i in rest] + ["difference"],
            )

    others = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["difference double"])
    return docs.mapInArrow(measure, schema)


def _dictionary(texts: list[bytes], size: int) -> bytes:
    joined = b"\n".join(texts)
    if len(texts) < 8 or len(joined) < 4 * size:
        return joined[-size:]  # too little text to choose from: all of its last bytes
    return zstandard.train_dictionary(size, texts, k=200, d=8).as_bytes()


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve, by Newton steps; slope at least 0."""
    m, s = np.average(x, weights=w), max(x.std(), 1e-9)
    a = np.stack([(x - m) / s, np.ones_like(x)], axis=1)
    # one good and one bad text in the middle keep the curve finite if the classes do not overlap
    target = (y * (w @ y) + 0.5 * w.mean()) / (w @ y + w.mean()) if w @ y else y
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        g = a.T @ (w * (target - p)) - 1e-3 * b
        h = (a * (w * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(b[0], 0.0) / s
    return float(slope), float(b[1] - slope * m)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    dictionary_bytes: int = 262_144, dictionary_rows: int = 2_000, calibration_rows: int = 1_000,
    longest: int = 20_000, level: int = 3,
) -> CompressionClassifier:
    """The classifier of the labelled rows. ``labels`` has the key and the label, 0 or 1."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1)")
    share = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if len(share) < 2:  # nothing to tell apart: every text gets the share of label 1, one half without labels
        return CompressionClassifier(b"", b"", level, 0.0, 0.0, float(np.log((share.get(1, 0) + 0.5) / (share.get(0, 0) + 0.5))))
    spread = F.xxhash64(F.col("_key"), F.lit("quality"))
    most = dictionary_rows + calibration_rows
    chosen = [known.where(F.col("_label") == c).orderBy(spread, "_key").limit(most) for c in (0, 1)]
    chosen = chosen[0].union(chosen[1])  # at most 2 * most rows of two numbers: safe to broadcast
    texts = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text")).where(F.length("_text") <= longest)
    rows = texts.join(F.broadcast(chosen), "_key")
    few = lambda r: [r.where(F.col("_label") == c).orderBy(spread, "_key", F.xxhash64("_text")).limit(most) for c in (0, 1)]  # noqa: E731 (a key may repeat)
    # By share, so that a class of few labels serves both.
    cut = dictionary_rows / most
    part = F.pmod(F.xxhash64(F.col("_key"), F.lit("part")), F.lit(10_000)) < F.lit(int(10_000 * cut))
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for r in (r for each in few(rows.where(part)) for r in each.collect()):
        samples[r["_label"]].append(r["_text"].encode())
    good, bad = _dictionary(samples[1], dictionary_bytes), _dictionary(samples[0], dictionary_bytes)
    measured = differences(few(rows.where(~part))[0].union(few(rows.where(~part))[1]), good, bad, level, 0.0, "_text").select("_label", "difference").toPandas()
    x, y = measured["difference"].to_numpy(), measured["_label"].to_numpy().astype(float)
    if not len(x) or y.min() == y.max():
        return CompressionClassifier(good, bad, level, 0.0, 0.0, float(np.log(share[1] / share[0])))
    w = np.where(y == 1, share[1] / max(1, (y == 1).sum()), share[0] / max(1, (y == 0).sum()))
    w = w / w.mean()
    mean = float(np.average(x, weights=w))
    slope, offset = _curve(x, y, w)
    return CompressionClassifier(good, bad, level, mean, slope, offset)


def score(docs: DataFrame, model: CompressionClassifier, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``difference`` and ``score``, the probability of label 1."""
    docs = docs.drop("difference", "score")
    found = differences(docs.withColumn(text, text_of(text)), model.good, model.bad, model.level, model.mean, text)
    return found.withColumn("score", model.probability(F.col("difference")))


def _trained(docs: DataFrame, spark: SparkSession, sf_dir: str) -> CompressionClassifier:
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0)
    return fit(docs, labels)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, _trained(docs, spark, sf_dir))
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "difference",
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the classifier rejects."""
    slim = numbered(docs.select("doc_id", "text"))
    scored = score(slim, _trained(docs, spark, sf_dir))
    return packed(docs).join(scored.where("score >= 0.3").select(ROW), ROW, "left_semi").select("doc.*")
