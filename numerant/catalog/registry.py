"""Where queries register, and what they share: tables, rounding, the housing-like view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query with the SQL of the same result, if SQL can say it."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A scan whose rows are computed on: over all cores even if it is one small file."""
    return spread(scan(spark, sf_dir, name))


def r(value: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison, without negative zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded."""
    return df.select(
        *[r(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def sql_r(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0::double)"


# The housing-like view of lineitem and part: (name, Spark SQL, DuckDB SQL where it differs).
H_COLUMNS: dict[str, str] = {
    "CRIM": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount * 100 END",
    "ZN": "CASE WHEN l_quantity > 40 THEN l_quantity * 2 ELSE 0 END",
    "INDUS": "CAST(p_size AS DOUBLE) * CAST(0.55 AS DOUBLE)",
    "CHAS": "CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "NOX": "CAST(0.3 AS DOUBLE) + l_tax * 6",
    "RM": "3 + l_quantity / 10",
    "AGE": "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey % 101 END",
    "DIS": "1 + l_suppkey % 11",
    "RAD": "1 + l_suppkey % 24",
    "TAX": "200 + l_partkey % 500",
    "PTRATIO": "12 + CAST(p_size AS DOUBLE) / 5",
    "B": "p_retailprice - 600",
    "LSTAT": "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE 1 + l_extendedprice / 3000 END",
    "MEDV": "l_extendedprice / 2000",
}
FEATURES = [c for c in H_COLUMNS if c != "MEDV"]

_h_select = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in H_COLUMNS.items())
H_CTE = f"h AS (SELECT {_h_select} FROM lineitem JOIN part ON l_partkey = p_partkey)"


def housing_of(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """The view over given tables; lineitem may be a stream."""
    joined = lineitem.join(part.select("p_partkey", "p_size", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(*[F.expr(f"CAST({e} AS DOUBLE)").alias(c) for c, e in H_COLUMNS.items()])


def housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return housing_of(table(spark, sf_dir, "lineitem"), scan(spark, sf_dir, "part"))


def union_all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# SQL fragments

def sql_median(column: str, source: str, q: float = 0.5) -> str:
    return f"(SELECT quantile_cont({column}, {q}) FROM {source})"


def sql_mode(column: str, source: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} ASC LIMIT 1)"
    )


def sql_clip(x: str, low: str, high: str) -> str:
    return f"CASE WHEN {x} < {low} THEN {low} WHEN {x} > {high} THEN {high} ELSE {x} END"


def sql_scale(x: str, center: str, scale: str) -> str:
    return f"(({x}) - {center}) / (CASE WHEN {scale} = 0 THEN 1 ELSE {scale} END)"


def sql_metrics(y: str, p: str) -> str:
    """rmse, mae, r2, mape of two expressions, to be selected from their table."""
    e = f"(({y}) - ({p}))"
    return (
        f"{sql_r(f'sqrt(avg({e} * {e}))')} AS rmse, {sql_r(f'avg(abs({e}))')} AS mae, "
        f"{sql_r(f'1 - sum({e} * {e}) / (var_pop({y}) * count(*))')} AS r2, "
        f"{sql_r(f'avg(abs({e}) / greatest(abs({y}), 2.220446049250313e-16)) * 100')} AS mape"
    )
