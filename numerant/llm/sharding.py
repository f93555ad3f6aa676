"""Sharding by an external shuffle in two passes.

Pass one scatters whole records into memory-sized buckets by a seeded hash of key and text. Pass two
takes one bucket at a time: its records are put in a fixed order, shuffled by Fisher-Yates with a
generator seeded by the bucket, and written. The buckets one after the other are one shuffled order of
all records; it is cut into shards of equal numbers of records (law ``rows``: counts differ by one at
most). A record's slot is its place in its shard.

The files of the buckets are the output; whoever needs shards as files writes ``shuffled`` partitioned
by shard. A bucket holds about ``bucket_bytes`` of text, so a task's memory does not grow with the input.
Rows that repeat with key and text go to one bucket while they fill a quarter of it at most, and else to all buckets by row number.

Defined results: a null text has size 1, as the empty text, and the checksum of the empty text; a null
key is a key; repeated rows are separate records with slots of their own; with fewer records than
shards some shards stay empty; an empty table gives an empty result; other columns stay with the
records, and columns named like those added here are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import broadcast_if_small
from .common import fresh, settled, table, text_of, written

ADDED = ("bucket", "position")
BUCKET_BYTES = 32 << 20


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A shuffled order of n records: numpy's permutation is a Fisher-Yates shuffle."""
    return np.random.Generator(np.random.PCG64(seed)).permutation(n)


def shuffled(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records in shuffled order, written: ``docs`` with bucket, and position in the bucket."""
    settled(docs.sparkSession)
    docs = docs.drop(*ADDED)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_of(text)) + 64), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, -(-size // bucket_bytes))
    mark_, many = fresh(docs, "mark", "many")
    mark = F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col(text))
    # Rows that repeat with key and text so often that they would fill a bucket are dealt over all of them.
    sized = docs.select(mark.alias(mark_), (F.octet_length(text_of(text)) + 64).alias("size"))
    full = sized.groupBy(mark_).agg(F.count("*").alias("n"), F.sum("size").alias("size")).where((F.col("size") > bucket_bytes // 4) & (F.col("n") > 1))
    full = written(full.select(mark_, F.lit(True).alias(many)), "sharding-full")
    scattered = docs.withColumn(mark_, mark).join(broadcast_if_small(full), mark_, "left")
    place = F.when(F.col(many), F.xxhash64(F.col(mark_), F.monotonically_increasing_id())).otherwise(F.col(mark_))
    scattered = scattered.withColumn("bucket", F.pmod(place, F.lit(buckets)).cast("int"))
    scattered = scattered.repartitionById(buckets, F.col("bucket"))  # a partition for each bucket
    schema = T.StructType([*docs.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("position", T.LongType())])

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        held = pa.Table.from_batches(batches)
        names = held.schema.names
        keys = np.array([str(k) for k in held.column(key).to_pylist()])
        fixed = np.lexsort((keys, held.column(mark_).to_numpy()))  # whatever order the exchange delivered
        order = fixed[fisher_yates(len(fixed), [seed, held.column("bucket")[0].as_py()])]
        for start in range(0, len(order), 2_000):
            part = held.take(pa.array(order[start : start + 2_000]))
            columns = [part.column(c) for c in names if c != mark_]
            place = pa.array(np.arange(start, start + part.num_rows))
            out = pa.table([*columns, place], names=[c for c in names if c != mark_] + ["position"])
            yield from out.combine_chunks().to_batches()

    columns = [*docs.columns, "bucket", mark_]
    return written(scattered.select(*columns).mapInArrow(shuffle, schema), "shuffled")


def sharded(records: DataFrame, shards: int = 16) -> DataFrame:
    """``records`` (of ``shuffled``) with shard and slot, by law ``rows``."""
    counts = records.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start, all_, at = fresh(records, "start", "all", "at")
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start), F.sum("n").over(Window.partitionBy()).alias(all_))
    # A row per bucket of bucket_bytes: about a millionth of the input, and checked by Spark's threshold.
    out = records.drop("shard", "slot").join(starts, "bucket").withColumn(at, F.col(start) + F.col("position"))
    shard = F.expr(f"cast(`{at}` * {shards} div `{all_}` as int)")
    first = F.expr(f"(shard * `{all_}` + {shards - 1}) div {shards}")
    return out.withColumn("shard", shard).withColumn("slot", F.col(at) - first).drop(at, start, all_)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharded(shuffled(docs)).select(
        "doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
