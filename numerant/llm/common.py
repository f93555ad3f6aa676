"""What the operators share: inputs, folds, written tables, row numbers, running sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

SPACE = r"[\x20\x09-\x0D]"  # ASCII white space, as every contract here has it
WORD = r"[^\x20\x09-\x0D]+"
ROW = "_row_number"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settled(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settled(spark: SparkSession) -> SparkSession:
    """The session with what the operators rely on, where it has not been set.

    Whole texts go to Python, so a batch has 2,000 of them instead of 10,000. How files are split, and with
    it the numbers of ``numbered``, must not follow the executors that are there at the moment: their number at the
    first use is kept.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return spark


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key is in the fold of the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def text_of(name: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and no lost executor takes it along."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def path_of(df: DataFrame) -> str:
    """Where ``written`` has put ``df``."""
    return df.scratch


def forget(*tables: DataFrame) -> None:
    """Delete what ``written`` has put on disk for these tables: nothing that is still to be computed reads them."""
    for df in tables:
        remove_path(df.sparkSession, path_of(df))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, which tells apart rows with the same or no key.

    ``docs`` has to be a scan (a table or files): it gives the same rows in the same partitions each
    time it is read (see ``settled``), so the number is the same as well.
    """
    settled(docs.sparkSession)
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def packed(docs: DataFrame) -> DataFrame:
    """Row number and whole row of a scan: no column of the row can clash with what a stage adds."""
    settled(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias(ROW), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores put before those that ``docs`` has as columns."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes in ``column``; one longer text is one part."""
    start = size = 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        n = n or 0
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, out: str, buckets: int = 1024) -> DataFrame:
    """``df`` with the sum of ``value`` over the earlier rows of its group, in two levels.

    Rows of a group are dealt by the first column of ``order``, a text that starts with uniformly
    spread hexadecimal digits, into ``buckets`` ranges. Sums are taken inside the ranges, then the
    sums of whole ranges are run up per group: no task holds a whole group.
    """
    digits = max(1, (buckets - 1).bit_length() // 4)
    ranged = df.withColumn("_range", F.substring(order[0], 1, digits))
    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*by, "_range").agg(F.sum(value).alias("_sum"))
    starts = starts.select(*by, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.join(starts, [*by, "_range"])
        .withColumn(out, F.col("_start") + F.col("_local"))
        .drop("_range", "_start", "_local")
    )


def sums_before(df: DataFrame, order: list[str], values: dict[str, str]) -> DataFrame:
    """``df`` with, for each (out, value) of ``values``, the sum of ``value`` over the rows before in ``order``, which has no ties.

    Rows are dealt by range and written; sums inside a range meet those of the ranges before it, one row
    per range: no task holds all rows.
    """
    ranged = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda value: F.lit(0).cast(df.schema[value].dataType)
    parts = ranged.groupBy("_part").agg(*(F.sum(v).alias(f"_{o}") for o, v in values.items()))
    parts = parts.select("_part", *(F.coalesce(F.sum(f"_{o}").over(before), zero(v)).alias(f"_{o}") for o, v in values.items()))
    local = ranged.withColumns({o: F.coalesce(F.sum(v).over(inside), zero(v)) for o, v in values.items()})
    return local.join(parts, "_part").withColumns({o: F.col(o) + F.col(f"_{o}") for o in values}).drop("_part", *(f"_{o}" for o in values))
