"""Exact order statistics and quantiles without a sort and without a per-column value map.

Every pass is one scan with a map-side combined count per (bracket, bucket); a bracket is the
value range that still holds a wanted rank. A pass narrows each bracket to the single bucket
holding the rank, tightened to the values present, so the rows that matter shrink about
``BINS``-fold per pass and ties resolve at once. When few rows are left their value counts are
fetched. Shuffled and fetched data is bounded by ``BINS`` and ``FETCH_ROWS`` times the number of
brackets, whatever the number of rows, distinct values or ties.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .sizing import broadcast_if_small

BINS = 2048
FETCH_ROWS = 100_000
MAX_PASSES = 80

Ranks = Sequence[int] | Callable[[int], Sequence[int]]


@dataclass(frozen=True)
class OrderStat:
    """The value at a rank, how many rows are smaller and how many equal it."""

    value: float | int
    less: int
    ties: int


@dataclass(frozen=True)
class ColumnOrder:
    count: int
    stats: dict[int, OrderStat]

    def value(self, rank: int) -> float | int:
        return self.stats[rank].value

    def quantile(self, p: float) -> float | None:
        """Linear interpolation at (n - 1) p."""
        if self.count == 0:
            return None
        low, high, part = _position(self.count, p)
        a, b = float(self.value(low)), float(self.value(high))
        return a if part == 0 else a + (b - a) * part


@dataclass(frozen=True)
class _Bracket:
    column: str
    low: float | int
    high: float | int
    base: int  # rows below low
    rows: int  # rows in [low, high]
    ranks: tuple[int, ...]
    log_scale: bool = False


def _position(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    low = min(math.floor(h), n - 1)
    return low, min(low + 1, n - 1) if h > low else low, h - low


def quantile_ranks(probs: Sequence[float]) -> Callable[[int], list[int]]:
    """The ranks that interpolation at ``probs`` needs, as a function of the row count."""

    def ranks(n: int) -> list[int]:
        return sorted({r for p in probs for r in _position(n, p)[:2]}) if n else []

    return ranks


def ordinals(df: DataFrame, exprs: Sequence[str | Column]) -> list[tuple[Column, bool]]:
    """An order-preserving number for each column and whether it is a bigint."""
    cols = [F.col(f"`{e}`") if isinstance(e, str) else e for e in exprs]
    kinds = [f.dataType for f in df.select(*[c.alias(f"x{i}") for i, c in enumerate(cols)]).schema]
    return [_ordinal(c, k) for c, k in zip(cols, kinds)]


def _ordinal(col: Column, kind: T.DataType) -> tuple[Column, bool]:
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.nanvl(col.cast("double"), F.lit(None).cast("double")), False
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return col.cast("bigint"), True
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(col.cast("timestamp"), F.current_timezone())), True
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col), True
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint"), True
    raise TypeError(f"a column of type {kind.simpleString()} has no numeric order")


def ordinal(df: DataFrame, expr: str | Column) -> tuple[Column, bool]:
    return ordinals(df, [expr])[0]


def _magnitude(v: float) -> float:
    """Signed logarithm: even parts of it resolve values of any size."""
    return 0.0 if v == 0 else math.copysign(math.log(abs(v)) + 745.0, v)


def _magnitude_of(d: Column) -> Column:
    return F.coalesce(F.signum(d) * (F.ln(F.abs(d)) + 745.0), F.lit(0.0))


def _parts(b: _Bracket) -> tuple[bool, float, float]:
    """How a bracket is parted: (by magnitude, start, parts per unit)."""
    lo, hi = float(b.low), float(b.high)
    by_magnitude = b.log_scale or not math.isfinite(hi - lo)
    if by_magnitude:
        lo, hi = _magnitude(lo), _magnitude(hi)
    step = BINS / (hi - lo) if hi > lo else 0.0
    return by_magnitude, lo, step if math.isfinite(step) else 0.0


def _narrow(bracket: _Bracket, buckets: list[tuple[int, float | int, float | int]]) -> list[_Bracket]:
    """The parts of a bracket that hold its ranks. Buckets are (rows, smallest, largest)."""
    merged: list[list] = []
    for rows, low, high in sorted(buckets, key=lambda b: (b[1], b[2])):
        if merged and low <= merged[-1][2]:  # rounding put a value one bucket off: treat both as one
            merged[-1][0] += rows
            merged[-1][2] = max(merged[-1][2], high)
        else:
            merged.append([rows, low, high])
    out, base, pending = [], bracket.base, sorted(bracket.ranks)
    for rows, low, high in merged:
        inside = tuple(r for r in pending if base <= r < base + rows)
        if inside:
            slow = rows * 8 > bracket.rows
            out.append(
                _Bracket(bracket.column, low, high, base, rows, inside, slow and not bracket.log_scale)
            )
        base += rows
    return out


def order_statistics(
    df: DataFrame, wanted: Mapping[str, Ranks], exprs: Mapping[str, str | Column] | None = None
) -> dict[str, ColumnOrder]:
    """Exact values at the wanted ranks (0-based, NULL and NaN excluded) of many columns at once.

    ``wanted`` maps a name to ranks, or to a function from the count to ranks; ``exprs`` maps a
    name to the column or expression it stands for (the column of that name by default).
    """
    if not wanted:
        return {}
    exprs = exprs or {}
    typed = dict(zip(wanted, ordinals(df, [exprs.get(name, name) for name in wanted])))
    infinity = float("inf")
    seen = _extremes(df, typed)

    found: dict[str, dict[int, OrderStat]] = {name: {} for name in typed}
    counts: dict[str, int] = {}
    open_brackets: list[_Bracket] = []
    for name in typed:
        n, low, high, negative, positive = seen[name]
        counts[name] = n
        spec = wanted[name]
        ranks = sorted(set(spec(n) if callable(spec) else spec))
        if any(r < 0 or r >= n for r in ranks):
            raise ValueError(f"rank outside 0..{n - 1} wanted of '{name}'")
        for r in ranks:
            if r < negative:
                found[name][r] = OrderStat(-infinity, 0, negative)
            elif r >= n - positive:
                found[name][r] = OrderStat(infinity, n - positive, positive)
        middle = tuple(r for r in ranks if r not in found[name])
        if middle:
            open_brackets.append(
                _Bracket(name, low, high, negative, n - negative - positive, middle)
            )

    def settle(brackets: list[_Bracket]) -> list[_Bracket]:
        left = []
        for b in brackets:
            if b.low == b.high:
                for r in b.ranks:
                    found[b.column][r] = OrderStat(b.low, b.base, b.rows)
            else:
                left.append(b)
        return left

    open_brackets = settle(open_brackets)
    for _ in range(MAX_PASSES):
        if not open_brackets:
            break
        small, large, budget = [], [], FETCH_ROWS
        for b in sorted(open_brackets, key=lambda b: b.rows):
            close = float(b.low) == float(b.high)  # bigints that doubles cannot tell apart
            if close or b.rows <= budget:
                small.append(b)
                budget -= 0 if close else b.rows
            else:
                large.append(b)
        histogram = _count_buckets(df, typed, small, large)
        refined: list[_Bracket] = []
        for i, b in enumerate(small + large):
            refined += _narrow(b, histogram.get(i, []))
        open_brackets = settle(refined)
    if open_brackets:
        raise RuntimeError(f"order statistics did not settle for {[b.column for b in open_brackets]}")
    return {name: ColumnOrder(counts[name], found[name]) for name in typed}


def _cells(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """One row (i, x) per value of each row, NULL left out.

    Everything after it is written once for all columns, which keeps the generated code of a pass
    small enough to be compiled, however many columns there are.
    """
    return df.select(F.posexplode(F.array(*values)).alias("i", "x")).where("x IS NOT NULL")


def _extremes(df: DataFrame, typed: Mapping[str, tuple[Column, bool]]) -> dict[str, tuple]:
    """Per column: count, smallest and largest finite value, negative and positive infinities."""
    out: dict[str, tuple] = {name: (0, None, None, 0, 0) for name in typed}
    infinity, x = float("inf"), F.col("x")
    for long in (False, True):
        names = [n for n, (_, is_long) in typed.items() if is_long is long]
        if not names:
            continue
        finite = x if long else F.when(F.abs(x) < infinity, x)
        below, above = (F.lit(0), F.lit(0)) if long else (F.count_if(x == -infinity), F.count_if(x == infinity))
        cells = _cells(df, [typed[n][0] for n in names])
        for r in cells.groupBy("i").agg(F.count(F.lit(1)), F.min(finite), F.max(finite), below, above).collect():
            out[names[r[0]]] = tuple(r)[1:]
    return out


def _count_buckets(
    df: DataFrame, typed: Mapping[str, tuple[Column, bool]], small: list[_Bracket], large: list[_Bracket]
) -> dict[int, list[tuple[int, float | int, float | int]]]:
    """Rows, smallest and largest value of each bucket of each bracket.

    A small bracket is counted by value (each value its own bucket), a large one by BINS parts.
    """
    brackets = small + large
    out: dict[int, list[tuple[int, float | int, float | int]]] = {}
    for long in (False, True):
        chosen = [i for i, b in enumerate(brackets) if typed[b.column][1] is long]
        if not chosen:
            continue
        parts = [_parts(brackets[i]) for i in chosen]
        x = F.col("x")

        def of(values: list) -> Column:
            return F.get(F.array(*[F.lit(v) for v in values]), F.col("i"))

        d = x.cast("double")
        if any(p[0] for p in parts):
            d = F.when(of([p[0] for p in parts]), _magnitude_of(d)).otherwise(d)
        part = F.floor((d - of([p[1] for p in parts])) * of([p[2] for p in parts]))
        part = F.least(F.greatest(part, F.lit(0)), F.lit(BINS - 1)).cast("int")
        by_value = of([i < len(small) for i in chosen])
        cells = _cells(df, [typed[brackets[i].column][0] for i in chosen])
        inside = (x >= of([brackets[i].low for i in chosen])) & (x <= of([brackets[i].high for i in chosen]))
        counted = (
            cells.where(inside)
            .groupBy("i", F.when(~by_value, part).alias("k"), F.when(by_value, x).alias("v"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
        )
        for r in counted.collect():  # at most BINS rows per large bracket, FETCH_ROWS in all small ones
            out.setdefault(chosen[r.i], []).append((r.rows, r.low, r.high))
    return out


def exact_quantiles(
    df: DataFrame,
    probs: Sequence[float],
    columns: Sequence[str] | None = None,
    exprs: Mapping[str, str | Column] | None = None,
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of every column, NULL where a column holds no value."""
    names = list(columns) if columns is not None else list(exprs or {})
    orders = order_statistics(df, {c: quantile_ranks(probs) for c in names}, exprs)
    return {c: [orders[c].quantile(p) for p in probs] for c in names}


def approximate_quantiles(
    df: DataFrame, probs: Sequence[float], columns: Sequence[str], accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """One pass with a bounded rank error, for callers who accept it."""
    cells = _cells(df, [v.cast("double") for v, _ in ordinals(df, columns)])
    found = dict(cells.groupBy("i").agg(F.percentile_approx("x", list(probs), accuracy)).collect())
    return {c: list(found[i]) if i in found else [None] * len(probs) for i, c in enumerate(columns)}


def quantiles(
    df: DataFrame, probs: Sequence[float], columns: Sequence[str], method: str = "exact"
) -> dict[str, list[float | None]]:
    if method == "exact":
        return exact_quantiles(df, probs, columns)
    if method == "approx":
        return approximate_quantiles(df, probs, columns)
    raise ValueError(f"unknown quantile method '{method}'")


def grouped_order_statistics(
    df: DataFrame, keys: Sequence[str], value: str, ranks: DataFrame, limit: int = FETCH_ROWS
) -> DataFrame:
    """The value at given ranks inside each group, whatever the size of a group.

    ``value`` is a double or bigint column. ``ranks`` has the keys and ``rank`` (0-based, inside
    0..n-1). Returns keys, rank, value, less, ties. The rounds keep their brackets in a DataFrame:
    count per (key, rank, bucket), combined map-side, then keep the bucket that holds the rank.
    """
    spark = df.sparkSession
    keys = list(keys)
    data = df.select(*keys, F.col(value).alias("x")).where(F.col("x").isNotNull())
    infinity = F.lit(float("inf"))
    finite = F.abs(F.col("x").cast("double")) < infinity
    bounds = data.groupBy(*keys).agg(
        F.min(F.when(finite, F.col("x"))).alias("low"), F.max(F.when(finite, F.col("x"))).alias("high"), F.count_if(finite).alias("rows"),
        F.count_if(F.col("x") == -infinity).alias("base"), F.count_if(F.col("x") == infinity).alias("above"),
    )
    asked = ranks.select(*keys, "rank").distinct().join(bounds, keys)
    # Ranks among the infinite values are answered at once; the brackets hold finite ones.
    lowest, highest = F.col("rank") < F.col("base"), F.col("rank") >= F.col("base") + F.col("rows")
    kind = dict(df.dtypes)[value]
    outside = asked.where(lowest | highest).select(
        *keys, "rank", F.when(lowest, -infinity).otherwise(infinity).cast(kind).alias("value"),
        F.when(lowest, F.lit(0)).otherwise(F.col("base") + F.col("rows")).cast("bigint").alias("less"),
        F.when(lowest, F.col("base")).otherwise(F.col("above")).alias("ties"),
    )
    state = asked.where(~lowest & ~highest).select(*keys, "rank", "low", "high", "rows", "base")
    data = data.where(finite)
    order = Window.partitionBy(*keys, "rank").orderBy("low", "high")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    for step in range(MAX_PASSES):
        path = scratch_path(spark, "brackets")
        state.write.parquet(path)
        state = spark.read.parquet(path)
        wide = (F.col("low") < F.col("high")) & (F.col("rows") > limit)
        if state.where(wide).isEmpty():
            break
        width = F.col("high").cast("double") - F.col("low").cast("double")
        log_turn = step % 3 == 2  # a long tail can starve equal-width parts; part by magnitude now and then

        def magnitude(c: Column) -> Column:
            d = c.cast("double")
            return _magnitude_of(d) if log_turn else d

        share = F.try_divide(magnitude(F.col("x")) - magnitude(F.col("low")), magnitude(F.col("high")) - magnitude(F.col("low")))
        bucket = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(0)), F.lit(BINS - 1))
        # bigints closer than a double can tell are parted exactly
        bucket = F.when(width < BINS, F.floor(F.col("x") - F.col("low"))).otherwise(bucket) if dict(df.dtypes)[value] == "bigint" else bucket
        hit = (
            data.join(broadcast_if_small(state.where(wide).select(*keys, "rank", "low", "high", "base")), keys)
            .where((F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high")))
            .groupBy(*keys, "rank", "base", bucket.alias("bucket"))
            .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("rows"))
            .withColumn("base", F.col("base") + F.coalesce(F.sum("rows").over(before), F.lit(0)))
            .where((F.col("base") <= F.col("rank")) & (F.col("rank") < F.col("base") + F.col("rows")))
        )
        columns = [*keys, "rank", "low", "high", "rows", "base"]
        state = state.where(~wide).select(*columns).unionByName(hit.select(*columns))
    else:
        raise RuntimeError("grouped order statistics did not settle")

    settled = state.where("low = high").select(*keys, "rank", F.col("low").alias("value"), F.col("base").alias("less"), F.col("rows").alias("ties"))
    by_value = Window.partitionBy(*keys, "rank").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    # at most `limit` rows per (key, rank) here
    fetched = (
        data.join(broadcast_if_small(state.where("low < high").select(*keys, "rank", "low", "high", "base")), keys)
        .where((F.col("x") >= F.col("low")) & (F.col("x") <= F.col("high")))
        .groupBy(*keys, "rank", "base", "x")
        .agg(F.count(F.lit(1)).alias("ties"))
        .withColumn("less", F.col("base") + F.coalesce(F.sum("ties").over(by_value), F.lit(0)))
        .where((F.col("less") <= F.col("rank")) & (F.col("rank") < F.col("less") + F.col("ties")))
        .select(*keys, "rank", F.col("x").alias("value"), "less", "ties")
    )
    settled = settled.unionByName(fetched)
    return settled if kind == "bigint" else settled.unionByName(outside)


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], limit: int = FETCH_ROWS
) -> DataFrame:
    """Interpolated quantiles per group: keys, then one column per name in ``probs``.

    Groups up to ``limit`` rows use the built-in aggregate; larger ones go through brackets, so
    that no task holds the values of a large group.
    """
    spark = df.sparkSession
    keys = list(keys)
    # a null-safe single key, so that NULL groups take part
    data = df.select(*keys, F.struct(*[F.col(k) for k in keys]).alias("_g"), as_value(df, value).alias("_x"))
    data = data.where(F.col("_x").isNotNull())
    sizes = data.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > limit)
    names, points = list(probs), [float(p) for p in probs.values()]
    pick = [F.col("_g")[k].alias(k) for k in keys]
    if large.isEmpty():
        small = data
    else:
        path = scratch_path(spark, "large-groups")
        large.withColumn("_id", F.to_json("_g", {"ignoreNullFields": "false"})).write.parquet(path)
        large = spark.read.parquet(path)
        data = data.withColumn("_id", F.to_json("_g", {"ignoreNullFields": "false"}))
        ids = broadcast_if_small(large.select("_id"))
        small = data.join(ids, "_id", "left_anti")
    out = small.groupBy("_g").agg(F.percentile("_x", F.array(*[F.lit(p) for p in points])).alias("_q"))
    out = out.select(*pick, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if small is data:
        return out

    h = [(F.col("_n") - 1) * F.lit(p) for p in points]
    wanted = F.array(*[F.floor(x) for x in h], *[F.least(F.floor(x) + 1, F.col("_n") - 1) for x in h])
    ranks = large.select("_id", F.explode(wanted).alias("rank"))
    stats = grouped_order_statistics(data.join(ids, "_id", "left_semi"), ["_id"], "_x", ranks, limit)
    by_rank = stats.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_m"))
    cells = []
    for n, x in zip(names, h):
        a = F.col("_m")[F.floor(x)]
        b = F.col("_m")[F.least(F.floor(x) + 1, F.col("_n") - 1)]
        # weighted as the built-in aggregate does it, so that infinite neighbours give the same
        part = x - F.floor(x)
        cells.append(F.when((part == 0) | (a == b), a).otherwise((1 - part) * a + part * b).alias(n))
    return out.unionByName(large.join(by_rank, "_id").select(*pick, *cells))


def as_value(df: DataFrame, value: str) -> Column:
    """The values of a numeric column as doubles, NaN as NULL."""
    return ordinal(df, value)[0].cast("double")


__all__ = [
    "ColumnOrder",
    "OrderStat",
    "approximate_quantiles",
    "exact_quantiles",
    "grouped_order_statistics",
    "grouped_quantiles",
    "order_statistics",
    "quantile_ranks",
    "quantiles",
]
