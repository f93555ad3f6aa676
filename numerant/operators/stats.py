"""Statistics fitted or reported per column: one scan for all columns of a kind."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_double, numeric_columns, quoted
from ..session import scratch_path
from . import sizing
from .order_stats import ColumnOrder, order_statistics, quantile_ranks, quantiles
from .pairwise import SUMS, pair_sums


FILTER_BITS = 1 << 28  # 32 MB, whatever the number of rows


def _missing(df: DataFrame, name: str) -> Column:
    col = quoted(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _named(columns: Sequence[str]) -> Column:
    """The name at position ``i``."""
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col("i"))


def _cells(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """One row (i, x) per column of each row: what follows is written, and compiled, once."""
    return df.select(F.posexplode(F.array(*values)).alias("i", "x"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, rows, share) of every column."""
    columns = list(columns or df.columns)
    counted = _cells(df, [_missing(df, c) for c in columns]).groupBy("i").agg(F.count_if("x").alias("nulls"), F.count(F.lit(1)).alias("rows"))
    share = F.try_divide(F.col("nulls").cast("double"), F.col("rows"))
    return counted.select(_named(columns).alias("column"), "nulls", "rows", share.alias("share"))


def missing_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, the most affected first."""
    return null_counts(df, columns).where("nulls > 0").orderBy(F.desc("share"), "column")


def total_missing(df: DataFrame, ignore: Sequence[str] = ()) -> int:
    """Missing values outside ``ignore``."""
    columns = [c for c in df.columns if c not in set(ignore)]
    if not columns:
        return 0
    return null_counts(df, columns).agg(F.sum("nulls")).first()[0] or 0


def columns_by_missing(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(columns with missing values, columns without), each in column order."""
    columns = list(columns or df.columns)
    nulls = {r["column"]: r["nulls"] for r in null_counts(df, columns).collect()}
    return [c for c in columns if nulls[c] > 0], [c for c in columns if nulls[c] == 0]


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float | None]]:
    """count, mean, population and sample deviation, min and max of every column, in one scan."""
    if not columns:
        return {}
    makers = {"mean": F.avg, "std_pop": F.stddev_pop, "std": F.stddev_samp, "min": F.min, "max": F.max}
    cells = _cells(df, [as_double(c) for c in columns])
    counted = cells.groupBy("i").agg(F.count("x").alias("count"), *[f("x").alias(n) for n, f in makers.items()])
    out: dict[str, dict[str, float | None]] = {c: {"count": 0, **dict.fromkeys(makers)} for c in columns}
    for r in counted.collect():
        out[columns[r.i]] = {n: r[n] for n in ("count", *makers)}
    return out


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The most frequent value of every column, the smallest on ties.

    Values are counted by key, so neither many distinct values nor one hot value lands in one task.
    """
    if not columns:
        return {}
    counted = _cells(df, [as_double(c) for c in columns]).where("x IS NOT NULL").groupBy("i", "x").count()
    top = counted.groupBy("i").agg(F.max_by("x", F.struct("count", -F.col("x"))).alias("mode")).collect()
    found = {r["i"]: r["mode"] for r in top}
    return {c: found.get(i) for i, c in enumerate(columns)}


Marks = Mapping[str, Sequence[float | None]]  # Q1, median, Q3 per column
Moments = Mapping[str, Mapping[str, float | None]]


def quartiles(df: DataFrame, columns: Sequence[str], method: str = "exact") -> Marks:
    """Q1, median and Q3 of every column; hand them to the reports below to compute them once."""
    return quantiles(df, [0.25, 0.5, 0.75], columns, method)


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, method: str = "exact", marks: Marks | None = None
) -> dict[str, dict[str, float | None]]:
    """Q1, Q3, IQR and the bounds ``factor`` IQRs outside them."""
    out = {}
    for c, (q1, *_, q3) in (marks or quantiles(df, [0.25, 0.75], columns, method)).items():
        iqr = None if q1 is None else q3 - q1
        out[c] = {
            "q1": q1,
            "q3": q3,
            "iqr": iqr,
            "lower": None if iqr is None else q1 - factor * iqr,
            "upper": None if iqr is None else q3 + factor * iqr,
        }
    return out


def outlier_counts(df: DataFrame, bounds: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """(column, lower, upper, outliers, share of rows in percent)."""
    columns = list(bounds)

    def bound(end: str) -> Column:
        return F.get(F.array(*[F.lit(bounds[c][end]).cast("double") for c in columns]), F.col("i"))

    outside = F.coalesce((F.col("x") < bound("lower")) | (F.col("x") > bound("upper")), F.lit(False))
    counted = _cells(df, [as_double(c) for c in columns]).groupBy("i").agg(F.count_if(outside).alias("outliers"), F.count(F.lit(1)).alias("rows"))
    percent = F.try_divide(F.col("outliers").cast("double"), F.col("rows")) * 100
    return counted.select(
        _named(columns).alias("column"), bound("lower").alias("lower"), bound("upper").alias("upper"), "outliers", percent.alias("percent")
    )


def winsor_bounds(
    df: DataFrame,
    columns: Sequence[str],
    limits: tuple[float, float] = (0.05, 0.05),
    exprs: Mapping[str, Column] | None = None,
) -> dict[str, tuple[float, float] | None]:
    """The order statistics int(l n) from below and int(u n) from above; missing values excluded."""
    exprs = exprs or {c: as_double(c) for c in columns}
    orders = order_statistics(df, {c: _winsor_ranks(limits) for c in columns}, exprs)
    return {c: _winsor_pair(order, limits) for c, order in orders.items()}


def _winsor_ranks(limits: tuple[float, float]):
    return lambda n: sorted({int(limits[0] * n), n - int(limits[1] * n) - 1}) if n else []


def _winsor_pair(order: ColumnOrder, limits: tuple[float, float]) -> tuple[float, float] | None:
    n = order.count
    return (float(order.value(int(limits[0] * n))), float(order.value(n - int(limits[1] * n) - 1))) if n else None


def outlier_limits(
    df: DataFrame, capped: Sequence[str], winsor: Sequence[str], factor: float = 1.5,
    limits: tuple[float, float] = (0.05, 0.05), exprs: Mapping[str, Column] | None = None,
) -> tuple[dict[str, dict[str, float | None]], dict[str, tuple[float, float] | None]]:
    """IQR bounds of some columns and winsor limits of others, found in the same passes."""
    wanted = {("iqr", c): quantile_ranks([0.25, 0.75]) for c in capped} | {("winsor", c): _winsor_ranks(limits) for c in winsor}
    values = {("iqr", c): as_double(c) for c in capped} | {("winsor", c): (exprs or {}).get(c, as_double(c)) for c in winsor}
    orders = order_statistics(df, wanted, values)
    marks = {c: [orders["iqr", c].quantile(p) for p in (0.25, 0.75)] for c in capped}
    bounds = iqr_bounds(df, capped, factor, marks=marks) if capped else {}
    return bounds, {c: _winsor_pair(orders["winsor", c], limits) for c in winsor}


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact",
    marks: Marks | None = None, basic: Moments | None = None,
) -> DataFrame:
    """(column, count, mean, std, min, q1, median, q3, max) as doubles; std is the sample deviation."""
    columns = list(columns or numeric_columns(df))
    basic, marks = basic or moments(df, columns), marks or quartiles(df, columns, method)
    rows = [
        (c, basic[c]["count"], basic[c]["mean"], basic[c]["std"], basic[c]["min"], *marks[c], basic[c]["max"])
        for c in columns
    ]
    schema = "column string, count bigint, mean double, std double, min double, q1 double, median double, q3 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


def quartile_profile(df: DataFrame, columns: Sequence[str] | None = None, marks: Marks | None = None) -> DataFrame:
    """(column, dtype, q1, median, q3, iqr)."""
    columns = list(columns or numeric_columns(df))
    types, marks = dict(df.dtypes), marks or quartiles(df, columns)
    rows = [(c, types[c], *marks[c], None if marks[c][0] is None else marks[c][2] - marks[c][0]) for c in columns]
    return df.sparkSession.createDataFrame(
        rows, "column string, dtype string, q1 double, median double, q3 double, iqr double"
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(rows, duplicates): rows that equal an earlier row. Missing equals missing.

    Rows are counted by fingerprints of 64 bits; whole rows meet only where a fingerprint repeats, so that what is shuffled is 8 bytes
    and a count a row if few do, and rows with the same fingerprint that differ are told apart.
    """
    spark, columns = df.sparkSession, [quoted(c) for c in df.columns]
    if not columns or any(isinstance(f.dataType, T.MapType) for f in df.schema):
        raise ValueError("rows to compare need columns, and none of them a map")
    marked = df.withColumn("_print", F.xxhash64(*columns))
    path = scratch_path(spark, "fingerprints")
    marked.groupBy("_print").agg(F.count("*").alias("_n")).where("_n > 1").select("_print").write.parquet(path)
    repeated = _of_prints(marked, spark.read.schema("_print long").parquet(path))
    copies = repeated.groupBy(*columns).agg(F.count("*").alias("_copies"))
    found = copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates")).first()["duplicates"]
    return df.agg(F.count("*").alias("rows"), F.lit(found).cast("bigint").alias("duplicates"))


def _of_prints(marked: DataFrame, prints: DataFrame) -> DataFrame:
    """The rows with one of the fingerprints, and of many fingerprints also some others: no row moves for it.

    Many fingerprints are sent as a bitmap of their low bits, 16 bits for each and ``FILTER_BITS`` at most. Past that it lets more rows through.
    """
    spark, n = marked.sparkSession, prints.count()
    if n <= sizing.BROADCAST_ROWS:
        return marked.join(F.broadcast(prints), "_print", "left_semi")
    place = f"(_print & {min(FILTER_BITS, 1 << max(12, (16 * n).bit_length())) - 1})"
    block, word = F.expr(f"shiftright({place}, 12)"), F.expr(f"CAST(shiftright({place}, 6) & 63 AS INT)")
    bits = prints.select(block.alias("_block"), word.alias("_word"), F.expr("shiftleft(1L, CAST(_print & 63 AS INT))").alias("_bit")).repartition("_block")
    words = bits.groupBy("_block", "_word").agg(F.bit_or("_bit").alias("_bits")).groupBy("_block")
    found = words.agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_set"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("_set", i), F.lit(0).cast("long")))
    path = scratch_path(spark, "fingerprint-bits")
    found.select("_block", filled.alias("_words")).write.parquet(path)
    blocks = F.broadcast(spark.read.schema("_block long, _words array<long>").parquet(path))
    set_ = F.getbit(F.get("_words", word), F.expr("CAST(_print & 63 AS INT)")) == 1
    return marked.join(blocks, (block == F.col("_block")) & set_).drop("_block", "_words")


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(min_value, max_value) over all the columns together."""
    values = [as_double(c) for c in columns]
    least = F.least(*values) if len(values) > 1 else values[0]
    most = F.greatest(*values) if len(values) > 1 else values[0]
    return df.agg(F.min(least).alias("min_value"), F.max(most).alias("max_value"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30, basic: Moments | None = None) -> DataFrame:
    """(column, bin, lower, upper, count) with equal-width bins over [min, max], empty bins included.

    The last bin is closed. A constant column x gets bins over [x - 0.5, x + 0.5].
    """
    spread = basic or moments(df, columns)
    edges = {}
    for c in columns:
        lo, hi = spread[c]["min"], spread[c]["max"]
        if lo is not None:
            edges[c] = (lo, hi) if hi > lo else (lo - 0.5, hi + 0.5)
    if not edges:
        return df.sparkSession.createDataFrame([], "column string, bin int, lower double, upper double, count bigint")
    names = list(edges)

    def of(end: int) -> Column:
        return F.get(F.array(*[F.lit(edges[c][end]) for c in names]), F.col("i"))

    part = F.floor((F.col("x") - of(0)) / (of(1) - of(0)) * bins)
    part = F.when(part < bins, part).when(part >= bins, bins - 1).cast("int")
    counted = (
        _cells(df, [as_double(c) for c in names])
        .where("x IS NOT NULL")
        .groupBy("i", part.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(_named(names).alias("column"), "bin", "count")
    )
    grid = df.sparkSession.createDataFrame(
        [(c, b, lo + (hi - lo) * b / bins, lo + (hi - lo) * (b + 1) / bins) for c, (lo, hi) in edges.items() for b in range(bins)],
        "column string, bin int, lower double, upper double",
    )
    return grid.join(F.broadcast(counted), ["column", "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def correlations(
    df: DataFrame, columns: Sequence[str] | None = None, against: Sequence[str] | None = None, basic: Moments | None = None
) -> DataFrame:
    """(col_a, col_b, corr): Pearson over the rows where both are present, NULL for a constant column.

    All pairs come from the matrix products of ``pair_sums``, in one scan. Values are shifted
    by the column mean first, which keeps the sums of products accurate; a column whose mean is not finite has no correlation.
    """
    columns = list(columns or numeric_columns(df))
    against = list(against or columns)
    basic = basic or moments(df, list(dict.fromkeys([*columns, *against])))
    means = {c: m["mean"] or 0.0 for c, m in basic.items()}

    def shifted(c: str) -> Column:
        return as_double(c) - F.lit(means[c]) if math.isfinite(means[c]) else F.lit(None).cast("double")

    square = columns == against
    sums = pair_sums(df, [shifted(c) for c in against], [shifted(c) for c in columns])
    if square:  # the pairs on and above the diagonal, mirrored below
        sums = sums.where("i <= j")
    name = lambda names, at: F.get(F.array(*map(F.lit, names)), F.col(at))
    sums = sums.select(name(against, "i").alias("col_a"), name(columns, "j").alias("col_b"), *SUMS)
    vx, vy, cov = (F.expr(f"{p} - try_divide({a} * {b}, n)") for p, a, b in (("sxx", "sx", "sx"), ("syy", "sy", "sy"), ("sxy", "sx", "sy")))
    # the shift of a constant column leaves nothing but rounding
    live = (vx > F.col("sxx") * 1e-14) & (vy > F.col("syy") * 1e-14)
    corr = F.when(live, F.try_divide(cov, F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0)))))
    found = sums.select("col_a", "col_b", F.when(corr > 1, 1.0).when(corr < -1, -1.0).otherwise(corr).alias("corr"))
    if square:
        one, other = F.struct("col_a", "col_b", "corr"), F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
        found = found.select(F.inline(F.when(F.col("col_a") == F.col("col_b"), F.array(one)).otherwise(F.array(one, other))))
    # a frame without rows has no sums
    grid = df.sparkSession.createDataFrame([(a, b) for a in against for b in columns], "col_a string, col_b string")
    return grid.join(F.broadcast(found), ["col_a", "col_b"], "left").select("col_a", "col_b", "corr")


def correlations_with(df: DataFrame, column: str, columns: Sequence[str] | None = None, top: int | None = 5) -> DataFrame:
    """(column, corr) of one column with all (itself included), strongest positive first.

    What differs only by rounding is a tie, in the order of the names.
    """
    found = correlations(df, columns, against=[column]).select(F.col("col_b").alias("column"), "corr")
    found = found.orderBy(F.desc_nulls_last(F.round("corr", 9)), "column")
    return found.limit(top) if top else found


def split_summary(df: DataFrame, target: str, column: str = "split") -> DataFrame:
    """(split, rows, percent, mean, std) of the target per part; std is the sample deviation."""
    y = as_double(target)
    parts = df.groupBy(column).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std")
    )
    share = F.col("rows") / parts.agg(F.sum("rows")).scalar() * 100
    return parts.select(column, "rows", share.alias("percent"), "mean", "std")
