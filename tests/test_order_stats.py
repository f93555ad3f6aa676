import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from numerant.operators import order_stats
from numerant.operators.order_stats import exact_quantiles, grouped_quantiles, order_statistics, quantiles

PROBS = [0, 0.1, 0.25, 0.5, 0.75, 0.95, 1]


@pytest.fixture(params=[100_000, 3], ids=["fetch", "brackets"])
def fetch(request, monkeypatch):
    """Once with everything fetched at once, once through many passes."""
    monkeypatch.setattr(order_stats, "FETCH_ROWS", request.param)
    monkeypatch.setattr(order_stats, "BINS", 2048 if request.param > 3 else 16)
    return request.param


def check(spark, data):
    df = spark.createDataFrame([(v,) for v in data], "x double")
    found = exact_quantiles(df, PROBS, ["x"])["x"]
    clean = [v for v in data if v is not None and not math.isnan(v)]
    assert np.allclose(found, np.quantile(clean, PROBS), rtol=1e-12, atol=0)


def test_even_count_interpolates(spark, fetch):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 5.0)], "x double")
    assert exact_quantiles(df, [0.5], ["x"])["x"] == [3.0]


def test_nulls_and_nan_do_not_count(spark, fetch):
    check(spark, [3.0, None, float("nan"), 1.0, 2.0])


def test_one_third_of_the_rows_is_one_value(spark, fetch):
    rng = random.Random(1)
    check(spark, [5.0] * 300 + [5.0 + rng.random() * 1e-9 for _ in range(300)] + [rng.gauss(0, 1) for _ in range(300)])


def test_long_tail(spark, fetch):
    rng = random.Random(2)
    check(spark, [10.0 ** rng.uniform(-200, 200) * rng.choice([-1, 1]) for _ in range(500)] + [0.0] * 7)


def test_widest_range(spark, fetch):
    data = [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1.0]
    order = order_statistics(spark.createDataFrame([(v,) for v in data], "x double"), {"x": range(6)})["x"]
    assert [order.value(i) for i in range(6)] == sorted(data)


def test_infinities_are_ranked(spark, fetch):
    df = spark.createDataFrame([(v,) for v in (1.0, float("inf"), float("-inf"), 2.0)], "x double")
    order = order_statistics(df, {"x": [0, 1, 2, 3]})["x"]
    assert [order.value(i) for i in range(4)] == [float("-inf"), 1.0, 2.0, float("inf")]


def test_bigints_beyond_double_precision(spark, fetch):
    data = [2**60 + i for i in range(100)]
    df = spark.createDataFrame([(v,) for v in data], "x bigint")
    order = order_statistics(df, {"x": [0, 1, 57, 99]})["x"]
    assert [order.value(i) for i in (0, 1, 57, 99)] == [data[i] for i in (0, 1, 57, 99)]
    assert order.stats[57].less == 57 and order.stats[57].ties == 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_values(spark, fetch, data):
    check(spark, data)


def test_many_columns_at_once(spark, frame, fetch):
    df = frame({"a": range(50), "b": [1] * 50, "c": [None] * 50})
    found = exact_quantiles(df, [0.5], ["a", "b", "c"])
    assert found == {"a": [24.5], "b": [1.0], "c": [None]}


def test_dates_and_strings(spark):
    df = spark.sql("SELECT DATE'2020-01-02' AS d, 'x' AS s")
    assert order_statistics(df, {"d": [0]})["d"].value(0) == 18263
    with pytest.raises(TypeError):
        order_statistics(df, {"s": [0]})


def test_rank_outside(spark, frame):
    with pytest.raises(ValueError):
        order_statistics(frame({"x": [1, 2]}), {"x": [2]})


def test_methods(spark, frame):
    df = frame({"x": range(1001)})
    assert quantiles(df, [0.5], ["x"], "approx")["x"][0] == pytest.approx(500, abs=2)
    with pytest.raises(ValueError):
        quantiles(df, [0.5], ["x"], "guess")


@pytest.mark.parametrize("limit", [100_000, 5])
def test_groups_of_any_size(spark, limit):
    rng = random.Random(3)
    data = {"hot": [rng.lognormvariate(0, 3) for _ in range(400)], "tied": [2.0] * 200 + [1.0, 3.0], "one": [7.0], None: [4.0, 6.0]}
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.p50, r.p95) for r in grouped_quantiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95}, limit).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert np.allclose(got[k], np.quantile(vs, [0.5, 0.95]), rtol=1e-12)
