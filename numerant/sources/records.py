"""CSV records with line breaks in cells, read by many tasks.

A text file is split into blocks of lines wherever Spark cuts it. Whether a line begins a record depends on the text before it,
but only by one bit: inside quotes or not. So each block tells in one pass how it ends for either beginning (``_Ends``);
these maps, put together in file order by windows over one small row per block, give every block its beginning. A second pass
then joins the lines of a record inside the block, and the few pieces of records that go on in
the next block meet by number of the record. Texts are never shuffled, but for those pieces.

The quotes are read as the one-task reader reads them: a quote opens a cell only as its first character, a doubled quote inside
stands for itself, and what follows a closing quote belongs to the cell up to the next comma or line end.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import scratch_path

# Functions that run on executors travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A line outside quotes that ends inside them: cells with their commas, then one that is not closed.
_OPENS = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+|[^",][^,]*+)?,)*+"[^"]*+(?:""[^"]*+)*+$'


def opens(line: Column) -> Column:
    """Whether a line that begins a record ends inside a cell."""
    return line.contains('"') & line.rlike(_OPENS)


def _closed(line: str, at: int) -> int:
    """Place after the quote that closes a cell which is open at ``at``; -1 if none does."""
    while (at := line.find('"', at)) >= 0:
        if line[at + 1 : at + 2] != '"':
            return at + 1
        at += 2
    return -1


def ends_inside(line: str, inside: bool) -> bool:
    """Whether ``line`` ends inside quotes, from its beginning inside or outside of them."""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            at = _closed(line, at if inside else at + 1)
            if at < 0:
                return True
        inside = False
        at = line.find(",", at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, lineSep="\n")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, pa.Array]]:
    """The lines of each block in a batch, in order: the block, the place of its first line, the lines."""
    file, block, lines = batch.column(0), batch.column(1), batch.column(2)
    n = batch.num_rows
    if n:
        new = pc.or_(pc.not_equal(block.slice(1), block.slice(0, n - 1)), pc.not_equal(file.slice(1), file.slice(0, n - 1)))
        cuts = [0, *(i + 1 for i in pc.indices_nonzero(new).to_pylist()), n]
        for start, end in zip(cuts[:-1], cuts[1:]):
            yield (file[start].as_py(), block[start].as_py()), start, lines.slice(start, end - start)


def _block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, and whether it ends inside for a beginning outside (0) and inside (1)."""
    now: tuple | None = None
    ends = [False, True]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]], pa.int64()), *(pa.array([e]) for e in ends)], names=["file", "block", "outside", "inside"])

    for batch in batches:
        for block, _, lines in _runs(batch):
            if block != now:
                if now:
                    yield row()
                now, ends = block, [False, True]
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                ends = [ends_inside(line, e) for e in ends]
    if now:
        yield row()


def _beginnings(ends: DataFrame) -> DataFrame:
    """file, block, inside: how each block begins. A block that ends alike for both beginnings sets the state, one that swaps them turns it."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum((F.col("outside") & ~F.col("inside")).cast("long")).over(before), F.lit(0))
    turned = ends.withColumn("turns", swaps)
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("long").alias("state"), F.col("turns")))
    last = F.last(fixed, ignorenulls=True).over(before)
    state = F.coalesce(last["state"], F.lit(0)) + F.col("turns") - F.coalesce(last["turns"], F.lit(0))
    return turned.select("file", "block", (state % 2 == 1).alias("inside"))


WHOLE, HEADER, END, MIDDLE, BEGINNING = range(5)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, piece, record: whole records, the first one of a file, and the pieces of records that blocks share.

    A block holds at most the end of one record and the beginning of another, or the middle of one.
    """
    now: tuple | None = None
    held: list[str] = []
    inside = through = header = False

    def out(rows: list[tuple[int, str]]) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())],
            names=["file", "block", "piece", "record"],
        )

    for batch in batches:
        for block, start, lines in _runs(batch):
            if block != now:
                if held:
                    yield out([(MIDDLE if through else BEGINNING, "\n".join(held))])
                now, held = block, []
                inside = through = batch.column(3)[start].as_py()
                header = block[1] == 0
            rows = []
            for line, has in zip(lines.to_pylist(), pc.match_substring(lines, '"').to_pylist()):
                before = inside
                if has:
                    inside = ends_inside(line, inside)
                if before or inside:
                    held.append(line)
                    if inside:
                        continue
                    line, held = "\n".join(held), []
                rows.append((END if through else HEADER if header and line.strip("\r") else WHOLE, line))
                header = header and not line.strip("\r")
                through = False
            if rows:
                yield out(rows)
    if held:
        yield out([(MIDDLE if through else BEGINNING, "\n".join(held))])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The cells of a CSV file or folder with a header as texts, with the columns the one-task reader gives.

    Records end with a line feed, or a carriage return and a line feed; empty ones are left out. A quote that is never closed takes
    the rest of the file, but for its last line end.
    """
    columns = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True).columns
    lines = _lines(spark, path)
    ends_path = scratch_path(spark, "csv-blocks")
    _beginnings(lines.mapInArrow(_block_ends, "file string, block long, outside boolean, inside boolean")).write.parquet(ends_path)
    begins = spark.read.schema("file string, block long, inside boolean").parquet(ends_path)
    small = broadcast_if_small(begins)
    if small is begins:  # beyond a broadcast the lines are dealt by block, and put in order again
        lines = lines.withColumn("place", F.monotonically_increasing_id())
        met = lines.join(begins, ["file", "block"]).sortWithinPartitions("file", "block", "place").select("file", "block", "line", "inside")
    else:
        met = lines.join(small, ["file", "block"]).select("file", "block", "line", "inside")
    pieces = met.mapInArrow(_assembled, "file string, block long, piece int, record string")
    split_path = scratch_path(spark, "csv-pieces")
    pieces.where(F.col("piece") >= HEADER).write.parquet(split_path)  # a header per file, two pieces per block
    split = spark.read.schema(pieces.schema).parquet(split_path)
    # In file order an end comes before the beginning in its block; each beginning opens a record, and the header is the first.
    order = Window.partitionBy("file").orderBy("block", "piece")
    split = split.withColumn("number", F.sum((F.col("piece") == BEGINNING).cast("long")).over(order)).withColumn("headed", F.max((F.col("piece") == HEADER).cast("int")).over(Window.partitionBy("file")))
    parts = split.where(F.col("piece") > HEADER).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "piece", "record"))).alias("parts"), F.first("headed").alias("headed")
    )
    # Without a whole first record the header is the first one put together.
    parts = parts.where((F.col("headed") == 1) | (F.col("number") > 1))
    joined = parts.select(F.concat_ws("\n", F.transform("parts", lambda p: p["record"])).alias("record"))
    record = F.regexp_replace("record", "\r$", "")
    every = pieces.where(F.col("piece") == WHOLE).select(record.alias("record")).union(joined.select(record)).where("record <> ''")
    parsed = F.from_csv("record", ", ".join(f"c{i} STRING" for i in range(len(columns))), {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    return every.select(parsed.alias("cells")).select(*(F.col(f"cells.c{i}").alias(c) for i, c in enumerate(columns)))
