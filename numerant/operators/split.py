"""Exact-size train/test splits and contiguous folds.

Rows are ordered by numbers (words of a key hash, or order columns), the rows at the wanted
prefix sizes are found as order statistics, and every row is labelled by comparing it with those
constants. There is no sort, window or join over the rows, and a hot key costs nothing extra.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import key_hash_words, quoted
from ..session import scratch_path
from . import sizing
from .order_stats import grouped_order_statistics, order_statistics, ordinal
from .sizing import broadcast_if_small


@dataclass(frozen=True)
class Cut:
    """The last row of a prefix, level by level; ``need`` of its ``copies`` equal rows belong to it."""

    values: tuple[float | int, ...]
    less: int
    copies: int
    need: int

    @property
    def clean(self) -> bool:
        return self.need == self.copies

    def holds(self, order: Sequence[Column]) -> Column:
        """True for rows in the prefix; rows equal to an unclean cut are not decided here."""
        *outer, last = list(zip(order, self.values))
        col, value = last
        inside = col <= F.lit(value) if self.clean else col < F.lit(value)
        for col, value in reversed(outer):
            inside = (col < F.lit(value)) | ((col == F.lit(value)) & inside)
        return inside

    def equals(self, order: Sequence[Column]) -> Column:
        out = F.lit(True)
        for col, value in zip(order, self.values):
            out = out & (col == F.lit(value))
        return out


def prefix_cuts(df: DataFrame, order: Sequence[Column], sizes: Sequence[int]) -> dict[int, Cut]:
    """The cut after the first ``size`` rows in the given order, for every size in 1..n."""
    name = "level0"
    got = order_statistics(df, {name: [s - 1 for s in sizes]}, {name: order[0]})[name]
    cuts, deeper = {}, {}
    for size in sizes:
        stat = got.stats[size - 1]
        need = size - stat.less
        if need == stat.ties or len(order) == 1:
            cuts[size] = Cut((stat.value,), stat.less, stat.ties, need)
        else:
            deeper.setdefault((stat.value, stat.less), []).append(size)
    for (value, less), tied in deeper.items():  # at most one entry per wanted size
        inner = prefix_cuts(df.where(order[0] == F.lit(value)), order[1:], [s - less for s in tied])
        for size in tied:
            cut = inner[size - less]
            cuts[size] = Cut((value, *cut.values), less + cut.less, cut.copies, cut.need)
    return cuts


def label_prefixes(
    df: DataFrame, order: Sequence[Column], parts: Sequence[tuple[object, int]], column: str
) -> DataFrame:
    """Label rows in order: the first ``size`` rows get the first label, and so on.

    Sizes sum to the row count. Equal rows on a cut are interchangeable; they are written out as
    so many copies per label.
    """
    ends, total = [], 0
    for label, size in parts:
        total += size
        ends.append((label, size, total))
    wanted = sorted({end for _, size, end in ends if 0 < end < total})
    cuts = prefix_cuts(df, order, wanted) if wanted else {}
    label_col: Column | None = None
    for label, size, end in ends:
        if size == 0:
            continue
        if end == total:
            label_col = F.lit(label) if label_col is None else label_col.otherwise(F.lit(label))
            break
        test = cuts[end].holds(order)
        label_col = F.when(test, F.lit(label)) if label_col is None else label_col.when(test, F.lit(label))

    torn = {c.values: c for c in cuts.values() if not c.clean}
    rest = df
    for cut in torn.values():
        rest = rest.where(~cut.equals(order))
    out = rest.withColumn(column, label_col)
    for cut in torn.values():
        out = out.unionByName(_written_copies(df, order, cut, ends, column))
    return out


def _written_copies(df: DataFrame, order: Sequence[Column], cut: Cut, ends: Sequence[tuple], column: str) -> DataFrame:
    """The equal rows on a cut, shared out over the labels their positions fall in."""
    same = df.where(cut.equals(order)).distinct().take(2)
    if len(same) != 1:
        raise ValueError("rows that differ share key and row hash; give a key that tells them apart")
    values = [F.lit(same[0][f.name]).cast(f.dataType).alias(f.name) for f in df.schema]
    out, first, last = None, cut.less, cut.less + cut.copies
    for label, size, end in ends:
        count = min(end, last) - max(end - size, first)
        if count > 0:
            part = df.sparkSession.range(count).select(*values, F.lit(label).alias(column))
            out = part if out is None else out.unionByName(part)
    return out


def _test_rows(n: int, test_size: float | int) -> int:
    if isinstance(test_size, bool) or not (0 < test_size < 1 or (isinstance(test_size, int) and test_size >= 1)):
        raise ValueError("test_size must be a share between 0 and 1 or a number of rows")
    n_test = test_size if isinstance(test_size, int) else math.ceil(n * test_size)
    if n - n_test < 1:
        raise ValueError(f"{n} rows cannot be split with test_size={test_size}: no row is left to train on")
    return n_test


def split_data(
    df: DataFrame,
    key: Sequence[str] | str,
    target: str | None = None,
    test_size: float | int = 0.2,
    seed: int = 42,
    stratify: str | None = None,
    column: str = "split",
) -> DataFrame:
    """Add a column 'train' / 'test' with exactly ceil(n * test_size) test rows.

    ``key`` names the columns that identify a row; the test rows are those with the smallest
    md5(seed-key). The same seed and keys give the same split on any cluster and partitioning.
    With ``stratify`` each of its values sends its share of rows to the test part.
    """
    keys = [key] if isinstance(key, str) else list(key)
    absent = [c for c in [*keys, *([target] if target else []), *([stratify] if stratify else [])] if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")
    order = [*key_hash_words(seed, keys), F.xxhash64(*[quoted(c) for c in df.columns])]
    if stratify:
        return _stratified(df, order, stratify, test_size, column)
    n = df.count()
    n_test = _test_rows(n, test_size)
    return label_prefixes(df, order, [("test", n_test), ("train", n - n_test)], column)


def _stratum_quotas(df: DataFrame, stratum: str, test_size: float | int) -> DataFrame:
    """Test rows per stratum: whole shares first, the rest by largest remainder."""
    strata = df.groupBy(F.col(stratum).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    seen = strata.agg(F.sum("_n").alias("n"), F.min("_n").alias("least"), F.count(F.lit(1)).alias("strata"), F.count_if(F.col("_s").isNull()).alias("nulls")).first()
    n, n_test = seen.n or 0, _test_rows(seen.n or 0, test_size)
    if seen.nulls:
        raise ValueError(f"'{stratum}' holds missing values")
    if seen.least < 2:
        raise ValueError(f"every value of '{stratum}' needs at least two rows to be split")
    product = F.col("_n").cast("decimal(19,0)") * F.lit(n_test).cast("decimal(19,0)")
    total = F.lit(n).cast("decimal(19,0)")
    strata = strata.withColumns(
        {"_rest": (product % total).cast("bigint"), "_quota": ((product - product % total) / total).cast("bigint")}
    )
    extra = n_test - strata.agg(F.sum("_quota")).first()[0]
    if extra == 0:
        return strata
    # The same order at any number of strata; only the way to count it off differs.
    if seen.strata <= sizing.BROADCAST_ROWS:
        place = F.row_number().over(Window.orderBy(F.col("_rest").desc(), F.col("_s")))
        return strata.withColumn("_quota", F.col("_quota") + (place <= extra).cast("int"))
    places = numbered_in_order(strata.withColumn("_rest", -F.col("_rest")), ["_rest", "_s"], "_place")
    return places.withColumn("_quota", F.col("_quota") + (F.col("_place") < extra).cast("int")).drop("_place")


def numbered_in_order(df: DataFrame, order_by: Sequence[str], column: str) -> DataFrame:
    """Number the rows 0, 1, ... in the order of columns of any type.

    One range shuffle by the columns and a row hash (so a frequent key is spread out), written once
    with the rows of each file in order; a row's number is its place in its file plus the rows of the files
    before. The number of jobs does not depend on the values.
    """
    spark = df.sparkSession
    keys = [*[quoted(c) for c in order_by], F.xxhash64(*[quoted(c) for c in df.columns])]
    path = scratch_path(spark, "in-order")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))  # a row per partition of the shuffle
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(broadcast_if_small(files), "_file").withColumn(column, F.col("_start") + F.col("_at")).drop("_file", "_at", "_start")


def _stratified(df: DataFrame, order: Sequence[Column], stratum: str, test_size: float | int, column: str) -> DataFrame:
    """Cuts per stratum, word by word: a word that many rows of a stratum share is decided by the next one."""
    spark = df.sparkSession
    words = [f"_w{i}" for i in range(len(order))]
    data = df.withColumns(dict(zip(words, order)))
    cuts = _stratum_quotas(df, stratum, test_size).where("_quota > 0").select("_s", F.col("_quota").alias("_need"))
    open_, torn = cuts, data
    for i, word in enumerate(words):
        ranks = open_.select(F.col("_s").alias(stratum), (F.col("_need") - 1).alias("rank"))
        found = grouped_order_statistics(torn, [stratum], word, ranks).select(
            F.col(stratum).alias("_t"), F.col("value").alias(f"_cut{i}"),
            (F.col("rank") + 1 - F.col("less")).alias("_inner"), F.col("ties").alias("_inner_ties"),
        )
        ties = F.col("_ties") if i else F.lit(None).cast("bigint")
        cuts = cuts.join(found, F.col("_s") == F.col("_t"), "left").select(
            "_s", *[f"_cut{j}" for j in range(i + 1)], F.coalesce("_inner", "_need").alias("_need"), F.coalesce(F.col("_inner_ties"), ties).alias("_ties")
        )
        path = scratch_path(spark, "stratum-cuts")
        cuts.write.parquet(path)
        cuts = spark.read.parquet(path)
        open_ = cuts.where("_need < _ties")
        if open_.isEmpty():
            break
        keys = open_.select(F.col("_s").alias("_o"), *[f"_cut{j}" for j in range(i + 1)])
        same = F.col(stratum) == F.col("_o")
        for j in range(i + 1):
            same = same & (F.col(words[j]) == F.col(f"_cut{j}"))
        torn = data.join(broadcast_if_small(keys), same).select(*data.columns)
    depth = sum(c.startswith("_cut") for c in cuts.columns)
    joined = data.join(broadcast_if_small(cuts), F.col(stratum) == F.col("_s"), "left")
    inside, tied = F.lit(None).cast("boolean"), F.lit(True)
    for j in reversed(range(depth)):
        w, cut = F.col(words[j]), F.col(f"_cut{j}")  # null where an earlier word has decided
        inside = F.when(cut.isNotNull(), F.when(w != cut, w < cut).otherwise(F.coalesce(inside, F.lit(True))))
        tied = tied & (w == cut)
    tied = F.coalesce(tied & (F.col("_need") < F.col("_ties")), F.lit(False))
    label = F.when(inside, "test").otherwise("train")
    names = [quoted(c) for c in df.columns]
    labelled = joined.where(~tied).select(*names, label.alias(column))
    if open_.isEmpty():
        return labelled
    # Rows alike in key and row hash are equal: counted, and written out as so many copies per part.
    copies = joined.where(tied).groupBy(*names, "_need").agg(F.count("*").alias("_n"))
    if copies.groupBy(quoted(stratum)).count().where("count > 1").limit(1).count():
        raise ValueError("rows that differ share key and row hash; give a key that tells them apart")
    parts = F.explode(F.array(
        F.struct(F.lit("test").alias("part"), F.col("_need").alias("m")), F.struct(F.lit("train").alias("part"), (F.col("_n") - F.col("_need")).alias("m"))
    ))
    out = copies.withColumn("_p", parts).where("_p.m > 0").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_p.m"))))
    return labelled.unionByName(out.select(*names, F.col("_p.part").alias(column)))


def train_test(df: DataFrame, column: str = "split") -> tuple[DataFrame, DataFrame]:
    """The two parts of a labelled frame."""
    return tuple(df.where(F.col(column) == part).drop(column) for part in ("train", "test"))


def assign_folds(df: DataFrame, order_by: Sequence[str] | str, folds: int = 5, column: str = "fold") -> DataFrame:
    """Contiguous folds 0..k-1 in the given order; the first n mod k folds hold one row more."""
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    if folds < 2:
        raise ValueError("at least two folds are needed")
    kinds = [f.dataType for f in df.select(*map(quoted, names)).schema]
    # A 64-bit number holds these exactly; texts, decimals and the like are put in order as they are.
    plain = all(not isinstance(k, (T.StringType, T.DecimalType, T.BinaryType)) for k in kinds)
    order = [ordinal(df, c)[0] for c in names] if plain else [quoted(c) for c in names]
    seen = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(order)]).first()
    n = seen.n
    if n < folds:
        raise ValueError(f"{n} rows cannot fill {folds} folds")
    if any(seen[f"c{i}"] < n for i in range(len(order))):
        raise ValueError(f"order columns {names} hold missing values")
    if plain:
        order.append(F.xxhash64(*[quoted(c) for c in df.columns]))
        parts = [(i, n // folds + (i < n % folds)) for i in range(folds)]
        return label_prefixes(df, order, parts, column)
    place, longer = F.col("_place"), n % folds
    first = longer * (n // folds + 1)  # rows of the folds that hold one row more
    fold = F.when(place < first, F.expr(f"_place div {n // folds + 1}")).otherwise(longer + F.expr(f"(_place - {first}) div {n // folds}"))
    return numbered_in_order(df, names, "_place").withColumn(column, fold.cast("int")).drop("_place")


def leaked_keys(train: DataFrame, test: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keys found in both parts; empty for a sound split."""
    keys = [key] if isinstance(key, str) else list(key)
    return train.select(*keys).intersect(test.select(*keys))
