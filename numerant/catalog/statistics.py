"""Queries on scans, statistics, order statistics and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, clip, is_outlier, log_magnitude
from ..operators import stats
from ..operators.order_stats import exact_quantiles
from ..operators.split import assign_folds, leaked_keys, split_data, train_test
from ..plans.evaluation import box_plot
from ..plans.scoring import invalid_rows, request_columns, valid_rows, validate
from ..functions.rules import HOUSING_RULES
from ..session import cached, scratch_path
from ..sources.tables import load_raw_data, load_split_data, save_split_data, target_last
from .registry import FEATURES, H_COLUMNS, H_CTE, housing, query, r, rounded, sql_clip, sql_r, table, union_all

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def kept(df: DataFrame) -> DataFrame:
    """A table of a few rows per column, taken out of the cache it was computed from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _null_counts_sql(source: str, columns, extra: str = "") -> str:
    return union_all([f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS \"rows\"{extra.format(c=c)} FROM {source}" for c in columns])


# --- scans and sinks

@query(
    "src1_csv_scan",
    f"WITH {H_CTE} " + union_all(
        [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS \"rows\", {sql_r(f'avg({c})')} AS mean FROM h" for c in H_COLUMNS]
    ),
)
def csv_scan(spark, sf_dir):
    """Write a CSV with NA cells, scan it with inferred types, count missing values."""
    path = scratch_path(spark, "csv") + ".csv"
    housing(spark, sf_dir).write.csv(path, header=True, nullValue="NA")
    df = load_raw_data(spark, path)
    means = stats.moments(df, df.columns)
    rows = [(r_["column"], r_["nulls"], r_["rows"], means[r_["column"]]["mean"]) for r_ in stats.null_counts(df).collect()]
    return rounded(spark.createDataFrame(rows, "column string, nulls bigint, rows bigint, mean double"))


SPLIT_CTE = (
    "ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42-' || o_orderkey), o_orderkey) AS rn, "
    "count(*) OVER () AS n FROM orders), "
    "labelled AS (SELECT *, CASE WHEN rn <= ceil(n * 0.2::double) THEN 'test' ELSE 'train' END AS split FROM ranked)"
)


def order_split(spark, sf_dir, **options) -> DataFrame:
    return split_data(table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice", **options)


@query(
    "src2_snk1_split_tables",
    f"WITH {SPLIT_CTE} SELECT split, count(*) AS \"rows\", {sql_r('avg(o_totalprice)', 4)} AS mean FROM labelled GROUP BY split",
)
def split_tables(spark, sf_dir):
    """Split, write one table partitioned by the label, read both parts back."""
    path = scratch_path(spark, "split")
    save_split_data(order_split(spark, sf_dir), path, "o_totalprice")
    train, test = load_split_data(spark, path, "o_totalprice")
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), r(F.avg("o_totalprice"), 4).alias("mean"))


@query(
    "snk1_csv_split_tables",
    f"WITH {SPLIT_CTE} SELECT split, count(*) AS \"rows\", {sql_r('avg(o_totalprice)', 4)} AS mean, true AS target_is_last FROM labelled GROUP BY split",
)
def csv_split_tables(spark, sf_dir):
    """The same pair as CSV folders, the target as last column."""
    path = scratch_path(spark, "split csv")
    save_split_data(order_split(spark, sf_dir), path, "o_totalprice", fmt="csv")
    out = None
    for name, part in zip(("train", "test"), load_split_data(spark, path, "o_totalprice")):
        last = part.columns[-1] == "o_totalprice"
        row = part.agg(F.count(F.lit(1)).alias("rows"), r(F.avg("o_totalprice"), 4).alias("mean"))
        row = row.select(F.lit(name).alias("split"), "rows", "mean", F.lit(last).alias("target_is_last"))
        out = row if out is None else out.unionByName(row)
    return out


# --- projections and filters

@query("prj1_features_and_target", f"WITH {H_CTE} SELECT {', '.join(FEATURES)}, MEDV FROM h")
def features_and_target(spark, sf_dir):
    return target_last(housing(spark, sf_dir).select("MEDV", *FEATURES), "MEDV")


@query("prj4_request_rows", f"WITH {H_CTE} SELECT {', '.join(FEATURES)} FROM h")
def request_rows(spark, sf_dir):
    return request_columns(housing(spark, sf_dir).select("MEDV", *reversed(FEATURES)))


@query("flt2_not_null", f"WITH {H_CTE} SELECT count(*) AS \"rows\", {sql_r('avg(CRIM)')} AS mean FROM h WHERE CRIM IS NOT NULL")
def not_null(spark, sf_dir):
    df = housing(spark, sf_dir).where("CRIM IS NOT NULL")
    return df.agg(F.count(F.lit(1)).alias("rows"), r(F.avg("CRIM")).alias("mean"))


_BOUNDS = (
    "b AS (SELECT q1 - 1.5::double * (q3 - q1) AS lo, q3 + 1.5::double * (q3 - q1) AS hi FROM "
    "(SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))"
)


@query("flt3_outlier_rows", f"WITH {_BOUNDS} SELECT event_id, value FROM events, b WHERE value < lo OR value > hi")
def outlier_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    b = stats.iqr_bounds(events, ["value"])["value"]
    return events.where(is_outlier(as_double("value"), b["lower"], b["upper"])).select("event_id", "value")


def _violation_sql(rule) -> str:
    c, parts = rule.field, [f"WHEN {rule.field} IS NULL THEN '{rule.field}: missing'"]
    if rule.integer:
        parts.append(f"WHEN {c} <> floor({c}) THEN '{c}: not an integer'")
    if rule.lower is not None:
        parts.append(f"WHEN {c} < {rule.lower} THEN '{c}: below {rule.lower}'")
    if rule.upper is not None:
        parts.append(f"WHEN {c} > {rule.upper} THEN '{c}: above {rule.upper}'")
    return f"CASE {' '.join(parts)} END"


# The view with some values out of range.
_STRAY = {"ZN": "ZN * CAST(1.2 AS DOUBLE)", "PTRATIO": "PTRATIO * 3 - 30", "RAD": "RAD + (CASE WHEN TAX > 600 THEN CAST(0.5 AS DOUBLE) ELSE 0 END)"}
_STRAY_CTE = f"{H_CTE}, s AS (SELECT {', '.join(f'{_STRAY.get(c, c)} AS {c}' for c in FEATURES)}, MEDV FROM h)"
_VIOLATIONS_SQL = f"concat_ws('; ', {', '.join(_violation_sql(x) for x in HOUSING_RULES)})"


def stray_requests(spark, sf_dir) -> DataFrame:
    return housing(spark, sf_dir).selectExpr(*[f"{_STRAY.get(c, c)} AS {c}" for c in H_COLUMNS])


@query("flt4_validate_rows", f"WITH {_STRAY_CTE} SELECT MEDV, {_VIOLATIONS_SQL} AS violations FROM s")
def validate_rows(spark, sf_dir):
    return validate(stray_requests(spark, sf_dir)).select("MEDV", F.array_join("violations", "; ").alias("violations"))


@query(
    "flt4_quarantine",
    f"WITH {_STRAY_CTE}, v AS (SELECT *, {_VIOLATIONS_SQL} AS x FROM s) "
    f"SELECT CASE WHEN x = '' THEN 'valid' ELSE 'invalid' END AS kind, count(*) AS \"rows\", {sql_r('avg(MEDV)')} AS mean FROM v GROUP BY 1",
)
def quarantine(spark, sf_dir):
    v = validate(stray_requests(spark, sf_dir))
    both = valid_rows(v).select(F.lit("valid").alias("kind"), "MEDV").unionByName(invalid_rows(v).select(F.lit("invalid").alias("kind"), "MEDV"))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), r(F.avg("MEDV")).alias("mean"))


@query("flt6_null_columns", f"WITH {H_CTE}, c AS ({_null_counts_sql('h', H_COLUMNS)}) SELECT \"column\", nulls > 0 AS has_nulls FROM c")
def null_columns(spark, sf_dir):
    return stats.null_counts(housing(spark, sf_dir)).select("column", (F.col("nulls") > 0).alias("has_nulls"))


# --- aggregates

@query("agg1_null_counts", f"WITH {H_CTE} " + _null_counts_sql("h", H_COLUMNS))
def null_counts(spark, sf_dir):
    return stats.null_counts(housing(spark, sf_dir)).select("column", "nulls", "rows")


@query(
    "agg2_missing_fraction",
    f"WITH {H_CTE}, c AS ({_null_counts_sql('h', H_COLUMNS)}) SELECT \"column\", nulls, {sql_r('nulls::double / \"rows\"')} AS share FROM c WHERE nulls > 0 ORDER BY share DESC, 1",
)
def missing_fraction(spark, sf_dir):
    return stats.missing_fractions(housing(spark, sf_dir)).select("column", "nulls", r("share").alias("share"))


@query(
    "agg6_iqr_bounds",
    union_all([
        f"SELECT '{c}' AS \"column\", {sql_r('q1')} AS q1, {sql_r('q3')} AS q3, {sql_r('q1 - 1.5::double * (q3 - q1)')} AS lower, {sql_r('q3 + 1.5::double * (q3 - q1)')} AS upper "
        f"FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)" for c in LINE
    ]),
)
def iqr_bounds(spark, sf_dir):
    found = stats.iqr_bounds(table(spark, sf_dir, "lineitem"), LINE)
    rows = [(c, b["q1"], b["q3"], b["lower"], b["upper"]) for c, b in found.items()]
    return rounded(spark.createDataFrame(rows, "column string, q1 double, q3 double, lower double, upper double"))


@query(
    "agg7_outlier_counts",
    f"WITH {_BOUNDS} SELECT 'value' AS \"column\", {sql_r('any_value(lo)')} AS lower, {sql_r('any_value(hi)')} AS upper, "
    f"count(*) FILTER (value < lo OR value > hi) AS outliers, {sql_r('count(*) FILTER (value < lo OR value > hi)::double / count(*) * 100')} AS percent FROM events, b",
)
def outlier_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(stats.outlier_counts(events, stats.iqr_bounds(events, ["value"])))


def _corr_sql(a: str, b: str) -> str:
    both = f"FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) {both} * stddev_pop({b}) {both}, 0)"


@query(
    "agg11_corr_with",
    f"WITH {H_CTE}, c AS (" + union_all([f"SELECT '{c}' AS \"column\", {_corr_sql(c, 'RAD')} AS corr FROM h" for c in FEATURES])
    + f") SELECT \"column\", {sql_r('corr')} AS corr FROM c",
)
def corr_with(spark, sf_dir):
    with cached(housing(spark, sf_dir)) as h:
        return rounded(kept(stats.correlations_with(h, "RAD", FEATURES, top=None)))


@query(
    "agg12_corr_matrix",
    f"WITH {H_CTE}, w AS (SELECT " + ", ".join(f"{_corr_sql(a, b)} AS {a}__{b}" for a in H_COLUMNS for b in H_COLUMNS) + " FROM h) "
    + union_all([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sql_r(f'{a}__{b}')} AS corr FROM w" for a in H_COLUMNS for b in H_COLUMNS]),
)
def corr_matrix(spark, sf_dir):
    with cached(housing(spark, sf_dir)) as h:
        return rounded(kept(stats.correlations(h)))


@query(
    "ord5_top_correlations",
    f"WITH {H_CTE}, c AS (" + union_all([f"SELECT '{c}' AS \"column\", {sql_r(_corr_sql(c, 'B'))} AS corr FROM h" for c in FEATURES])
    + ") SELECT * FROM c ORDER BY corr DESC NULLS LAST, 1 LIMIT 5",
)
def top_correlations(spark, sf_dir):
    """INDUS and PTRATIO are one column but for scale: they tie, and the name decides."""
    with cached(housing(spark, sf_dir)) as h:
        return rounded(kept(stats.correlations_with(h, "B", FEATURES, top=5)))


@query(
    "agg13_split_target",
    f"WITH {SPLIT_CTE} SELECT split, {sql_r('avg(o_totalprice)', 4)} AS mean, {sql_r('stddev_samp(o_totalprice)', 4)} AS std FROM labelled GROUP BY split",
)
def split_target(spark, sf_dir):
    return rounded(stats.split_summary(order_split(spark, sf_dir), "o_totalprice").select("split", "mean", "std"), 4)


@query(
    "agg14_split_shares",
    f"WITH {SPLIT_CTE} SELECT split, count(*) AS \"rows\", {sql_r('count(*)::double / any_value(n) * 100')} AS percent FROM labelled GROUP BY split",
)
def split_shares(spark, sf_dir):
    return rounded(stats.split_summary(order_split(spark, sf_dir), "o_totalprice").select("split", "rows", "percent"))


def _describe_sql(source: str, columns, digits: int = 6) -> str:
    return union_all([
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {sql_r(f'avg({c})', digits)} AS mean, {sql_r(f'stddev_samp({c})', digits)} AS std, {sql_r(f'min({c})', digits)} AS min, "
        f"{sql_r(f'quantile_cont({c}, 0.25)', digits)} AS q1, {sql_r(f'quantile_cont({c}, 0.5)', digits)} AS median, {sql_r(f'quantile_cont({c}, 0.75)', digits)} AS q3, {sql_r(f'max({c})', digits)} AS max FROM {source}"
        for c in columns
    ])


@query("agg15_describe", f"WITH {H_CTE} " + _describe_sql("h", H_COLUMNS, 7))
def describe(spark, sf_dir):
    with cached(housing(spark, sf_dir)) as h:
        return rounded(stats.describe(h), 7)


@query(
    "agg16_quartile_profile",
    union_all([
        f"SELECT '{c}' AS \"column\", 'double' AS dtype, {sql_r('q1')} AS q1, {sql_r('q2')} AS median, {sql_r('q3')} AS q3, {sql_r('q3 - q1')} AS iqr "
        f"FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM lineitem)" for c in LINE
    ]),
)
def quartile_profile(spark, sf_dir):
    return rounded(stats.quartile_profile(table(spark, sf_dir, "lineitem"), LINE))


@query(
    "agg17_duplicate_rows",
    "WITH u AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 10 = 0) "
    "SELECT sum(c)::BIGINT AS \"rows\", sum(c - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS c FROM u GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)",
)
def duplicate_rows(spark, sf_dir):
    """All columns of a table that holds part of its rows twice."""
    lines = table(spark, sf_dir, "lineitem")
    return stats.duplicate_rows(lines.unionByName(lines.where("l_orderkey % 10 = 0")))


def histogram_sql(source: str, columns: dict[str, str], bins: int = 30) -> str:
    """Bins of named expressions, empty ones included."""
    out = []
    for name, e in columns.items():
        out.append(
            f"SELECT '{name}' AS \"column\", g.bin::INTEGER AS bin, coalesce(c.n, 0)::BIGINT AS count FROM range(0, {bins}) AS g(bin) LEFT JOIN ("
            f"SELECT least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS bin, count(*) AS n FROM "
            f"(SELECT {e} AS x, min({e}) OVER () AS lo, max({e}) OVER () AS hi FROM {source}) WHERE x IS NOT NULL GROUP BY 1) AS c ON c.bin = g.bin"
        )
    return union_all(out)


@query("agg18_histogram", histogram_sql("lineitem", {c: c for c in LINE}))
def histogram(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "lineitem"), LINE).select("column", "bin", "count")


@query("agg25_value_range", "SELECT min(least(l_quantity, l_extendedprice, l_discount, l_tax)) AS min_value, max(greatest(l_quantity, l_extendedprice, l_discount, l_tax)) AS max_value FROM lineitem")
def value_range(spark, sf_dir):
    return stats.value_range(table(spark, sf_dir, "lineitem"), LINE)


@query(
    "cht6_box_plot",
    "WITH d AS (" + _describe_sql("lineitem", LINE, 4) + "), o AS ("
    + union_all([
        f"SELECT '{c}' AS \"column\", {sql_r('any_value(lo)', 4)} AS lower, {sql_r('any_value(hi)', 4)} AS upper, count(*) FILTER ({c} < lo OR {c} > hi) AS outliers FROM lineitem, "
        f"(SELECT q1 - 1.5::double * (q3 - q1) AS lo, q3 + 1.5::double * (q3 - q1) AS hi FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem))"
        for c in LINE
    ]) + ") SELECT d.*, o.lower, o.upper, o.outliers FROM d JOIN o USING (\"column\")",
)
def box_plot_data(spark, sf_dir):
    return rounded(box_plot(table(spark, sf_dir, "lineitem"), LINE), 4)


# --- order statistics

_DECILES = [i / 10 for i in range(11)]


@query(
    "ord0_quantiles",
    union_all([f"SELECT '{c}' AS \"column\", {p}::double AS p, {sql_r(f'quantile_cont({c}, {p})')} AS value FROM lineitem" for c in LINE for p in _DECILES]),
)
def quantile_table(spark, sf_dir):
    found = exact_quantiles(table(spark, sf_dir, "lineitem"), _DECILES, LINE)
    rows = [(c, p, v) for c, values in found.items() for p, v in zip(_DECILES, values)]
    return rounded(spark.createDataFrame(rows, "column string, p double, value double"))


@query("ord1_split_exact", f"WITH {SPLIT_CTE} SELECT o_orderkey, o_totalprice, split FROM labelled")
def split_exact(spark, sf_dir):
    return order_split(spark, sf_dir).select("o_orderkey", "o_totalprice", "split")


@query(
    "ord1b_split_stratified",
    "WITH s AS (SELECT o_orderpriority, count(*) AS k FROM orders GROUP BY 1), t AS (SELECT *, (sum(k) OVER ())::BIGINT AS n FROM s), "
    "q AS (SELECT *, ceil(n * 0.2::double)::BIGINT AS n_test FROM t), "
    "f AS (SELECT *, (k * n_test) // n AS base, (k * n_test) % n AS rest FROM q), "
    "g AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, o_orderpriority) <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM f), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42-' || o_orderkey), o_orderkey) AS rn FROM orders) "
    "SELECT o_orderkey, o_orderpriority, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split FROM ranked JOIN g USING (o_orderpriority)",
)
def split_stratified(spark, sf_dir):
    return order_split(spark, sf_dir, stratify="o_orderpriority").select("o_orderkey", "o_orderpriority", "split")


FOLD_CTE = "folded AS (SELECT *, ntile(5) OVER (ORDER BY o_orderkey) - 1 AS fold FROM orders)"


@query("ord2_folds", f"WITH {FOLD_CTE} SELECT o_orderkey, fold::INTEGER AS fold FROM folded")
def folds(spark, sf_dir):
    return assign_folds(table(spark, sf_dir, "orders"), "o_orderkey", 5).select("o_orderkey", "fold")


@query(
    "ord3_winsorize",
    "WITH s AS (SELECT value, row_number() OVER (ORDER BY value) AS rn, count(*) OVER () AS n FROM events), "
    "b AS (SELECT max(value) FILTER (rn = floor(0.05::double * n)::BIGINT + 1) AS lo, max(value) FILTER (rn = n - floor(0.05::double * n)::BIGINT) AS hi FROM s) "
    f"SELECT event_id, {sql_clip('value', 'lo', 'hi')} AS value FROM events, b",
)
def winsorize(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bounds = stats.winsor_bounds(events, ["value"])["value"]
    return events.select("event_id", clip(as_double("value"), *bounds).alias("value"))


@query("ord6_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


# --- sets

@query(
    "set1_union_rows",
    "SELECT count(*) AS \"rows\", count(DISTINCT event_id) AS events, " + sql_r("sum(value)", 2) + " AS total FROM (SELECT event_id, value FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, value FROM events WHERE event_type <> 'view')",
)
def union_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("event_id", "value")
    others = events.where("event_type <> 'view'").select("value", "event_id")
    return views.unionByName(others).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event_id").alias("events"), r(F.sum("value"), 2).alias("total")
    )


@query(
    "set2_leakage",
    f"WITH {SPLIT_CTE} SELECT count(*) AS leaked FROM (SELECT o_orderkey FROM labelled WHERE split = 'train' INTERSECT SELECT o_orderkey FROM labelled WHERE split = 'test')",
)
def leakage(spark, sf_dir):
    train, test = train_test(order_split(spark, sf_dir))
    return leaked_keys(train, test, "o_orderkey").agg(F.count(F.lit(1)).alias("leaked"))


# --- scalar treatments of single columns

@query("scl2_log_transform", f"SELECT c_custkey, {sql_r('ln(1 + abs(c_acctbal))')} AS value FROM customer")
def log_transform(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", r(log_magnitude(as_double("c_acctbal"))).alias("value"))


@query("scl3_iqr_cap", f"WITH {_BOUNDS} SELECT event_id, {sql_r(sql_clip('value', 'lo', 'hi'))} AS value FROM events, b")
def iqr_cap(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    b = stats.iqr_bounds(events, ["value"])["value"]
    return events.select("event_id", r(clip(as_double("value"), b["lower"], b["upper"])).alias("value"))
