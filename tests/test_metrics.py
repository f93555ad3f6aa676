import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from numerant.operators import metrics, pairwise, stats


def arrays(y, p):
    y, p = np.array(y, float), np.array(p, float)
    e = y - p
    return {
        "rmse": math.sqrt((e**2).mean()), "mae": abs(e).mean(), "r2": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(),
        "mape": (abs(e) / np.maximum(abs(y), metrics.EPSILON)).mean() * 100, "max_error": abs(e).max(), "median_error": np.median(abs(e)),
    }


def test_formulas(frame):
    y, p = [3, -0.5, 2, 7, 4], [2.5, 0.0, 2, 8, 4.5]
    got = metrics.as_dict(metrics.extended_metrics(frame({"y": y, "p": p}), "y", "p", "test_"))
    assert got == pytest.approx({f"test_{k}": v for k, v in arrays(y, p).items()})


def test_constant_target(frame):
    assert metrics.as_dict(metrics.regression_metrics(frame({"y": [2, 2], "p": [2, 2]}), "y", "p"))["r2"] == 1.0
    assert metrics.as_dict(metrics.regression_metrics(frame({"y": [2, 2], "p": [2, 3]}), "y", "p"))["r2"] == 0.0


def test_perfect_and_zero_target(frame):
    got = metrics.as_dict(metrics.regression_metrics(frame({"y": [0, 1], "p": [0, 1]}), "y", "p"))
    assert got == {"rmse": 0, "mae": 0, "r2": 1, "mape": 0}


def test_cv_summary(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 5.0)], "fold int, score double")
    got = metrics.as_dict(metrics.cv_summary(df))
    assert got == pytest.approx({"cv_mean": 3, "cv_std": np.std([1, 3, 5]), "cv_min": 1, "cv_max": 5})


def test_best_name():
    scores = {"a": {"rmse": 2.0, "r2": 0.5}, "b": {"rmse": 1.0, "r2": 0.9}, "c": {"rmse": 1.0, "r2": 0.1}}
    assert metrics.best_name(scores) == "b" and metrics.best_name(scores, "test_r2") == "b"
    assert metrics.best_name({k: scores[k] for k in ("c", "b")}) == "c"
    for bad in (({}, "test_rmse"), (scores, "nothing"), (scores, "train_rmse")):
        with pytest.raises(ValueError):
            metrics.best_name(*bad)


def test_flags(spark):
    df = spark.createDataFrame([("a", 2.0, 0.2), ("b", 1.0, 0.9), ("c", None, None)], "model string, test_rmse double, test_r2 double")
    assert {r.model: r.best for r in metrics.flag_best(df).collect()} == {"a": False, "b": True, "c": False}
    assert {r.model: r.best for r in metrics.flag_best(df, "test_r2").collect()}["b"]
    flags = spark.createDataFrame([(1.0, 2.5), (1.0, 2.0), (3.0, 1.0)], "a double, b double")
    assert [r.f for r in flags.select(metrics.overfit_flag(F.col("a"), F.col("b")).alias("f")).collect()] == [True, False, False]


def test_gain():
    assert metrics.optimisation_gain(4.0, 3.0) == (1.0, 25.0)


def test_correlations(frame):
    rng = np.random.default_rng(0)
    a = rng.normal(1e6, 1, 200)
    b = a * 2 + rng.normal(size=200)
    df = frame({"a": [*a, None], "b": [*b, 3.0], "c": [5.0] * 201})
    got = {(r.col_a, r.col_b): r["corr"] for r in stats.correlations(df).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-7) == got["b", "a"]
    assert got["a", "c"] is None and got["c", "c"] is None and got["a", "a"] == pytest.approx(1)
    first = stats.correlations_with(df, "a", top=2).collect()
    assert [r.column for r in first] == ["a", "b"]


def test_correlations_of_many_columns(spark, monkeypatch):
    """Pairwise complete, as pandas has it; the plan is as long for 250 columns as for three, blocks give the same."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 300)) + rng.normal(size=(400, 1)) + np.arange(300) * 1e4
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 7] = np.nan
    names = [f"c{i}" for i in range(300)]
    wide = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(wide).repartition(5)
    means = {c: {"mean": None if np.isnan(wide[c].mean()) else float(wide[c].mean())} for c in names}
    expected = wide.corr().to_numpy()

    def table(cells):
        monkeypatch.setattr(pairwise, "CELLS", cells)
        got = stats.correlations(df, names, basic=means).toPandas()
        assert len(got) == 90_000
        return got.pivot(index="col_a", columns="col_b", values="corr").loc[names, names].to_numpy(dtype=float)

    whole = table(2 << 20)
    assert np.allclose(whole, expected, atol=1e-9, equal_nan=True)
    assert np.allclose(table(120 * 300), whole, atol=1e-12, equal_nan=True)
    nodes = lambda k: stats.correlations(df, names[:k], basic=means)._jdf.queryExecution().optimizedPlan().toString().count("\n")
    monkeypatch.setattr(pairwise, "CELLS", 2 << 20)
    assert nodes(250) == nodes(3)


def test_correlations_of_infinite_and_no_rows(frame, spark):
    df = frame({"a": [1.0, 2.0, 4.0, None], "b": [2.0, 4.0, 8.0, 1.0], "w": [1.0, float("inf"), 2.0, 3.0]})
    got = {(r.col_a, r.col_b): r["corr"] for r in stats.correlations(df).collect()}
    assert got["a", "b"] == pytest.approx(1) and got["a", "w"] is None and got["w", "w"] is None
    none = stats.correlations(df.where("a > 99")).collect()
    assert len(none) == 9 and all(r["corr"] is None for r in none)


def test_histogram_edges(frame):
    df = frame({"x": [0, 1, 2, 3, None], "k": [4] * 5})
    got = {(r.column, r.bin): (r["count"], r.lower, r.upper) for r in stats.histogram(df, ["x", "k"], 3).collect()}
    assert [got["x", i][0] for i in range(3)] == [1, 1, 2] and got["x", 2][2] == 3
    assert sum(got["k", i][0] for i in range(3)) == 5 and got["k", 0][1] == 3.5


def test_duplicates_count_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2.0), (1, 2.0), (1, 2.0), (3, None)], "a int, b double")
    assert stats.duplicate_rows(df).first() == (6, 3)
    assert stats.duplicate_rows(df.where("a > 9")).first() == (0, 0)


@pytest.mark.parametrize("bits", [1 << 28, 1 << 12])
def test_rows_do_not_move_for_many_repeated_fingerprints(spark, monkeypatch, bits):
    """Every print of the rows is let through a bitmap, and nearly nothing else if there is room."""
    monkeypatch.setattr(stats.sizing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(stats, "FILTER_BITS", bits)
    df = spark.range(30_000).selectExpr("id % 25000 AS a", "CAST(id % 25000 AS STRING) AS b")
    assert stats.duplicate_rows(df).first() == (30_000, 5_000)
    marked = df.withColumn("_print", stats.F.xxhash64("a", "b"))
    prints = marked.where("a < 5000").select("_print").distinct()
    some = stats._of_prints(marked, prints)
    assert some.columns == marked.columns and some.where("a < 5000").count() == 10_000
    assert bits < 1 << 20 or some.count() < 15_000
    assert "Exchange hashpartitioning" not in some._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_fingerprint_are_told_apart(spark):
    """Missing cells do not move the hash, so these rows have one fingerprint."""
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", None), (None, None)], "x string, y string")
    assert df.select(stats.F.xxhash64("x", "y")).distinct().count() == 2
    assert stats.duplicate_rows(df).first() == (4, 1)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    assert stats.duplicate_rows(zeros).first() == (4, 2)


def test_null_reports(frame):
    df = frame({"a": [1, None, float("nan")], "b": [1, 2, 3], "c": [None, 1, 1]})
    assert [(r.column, r.nulls) for r in stats.missing_fractions(df).collect()] == [("a", 2), ("c", 1)]
    assert stats.columns_by_missing(df) == (["a", "c"], ["b"]) and stats.total_missing(df, ["a"]) == 1


def test_describe(frame):
    row = stats.describe(frame({"x": [1, 2, 3, 4, None]})).first()
    assert tuple(row)[1:] == pytest.approx((4, 2.5, np.std([1, 2, 3, 4], ddof=1), 1, 1.75, 2.5, 3.25, 4))
