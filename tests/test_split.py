import hashlib
import math

import pytest
from pyspark.sql import functions as F

from numerant.operators import order_stats
from numerant.operators.split import assign_folds, leaked_keys, split_data, train_test


def keyed(spark, n):
    return spark.range(n).select(F.col("id").alias("key"), (F.col("id") * 2.5).alias("MEDV"))


@pytest.mark.parametrize("size", [0.1, 0.2, 0.3, 0.5])
def test_exact_sizes(spark, size):
    train, test = train_test(split_data(keyed(spark, 300), "key", "MEDV", size))
    assert test.count() == math.ceil(300 * size)
    assert train.count() == 300 - math.ceil(300 * size)


def test_506_rows(spark):
    train, test = train_test(split_data(keyed(spark, 506), "key", "MEDV"))
    assert (train.count(), test.count()) == (404, 102)
    assert leaked_keys(train, test, "key").count() == 0


def test_rows_with_the_smallest_hashes(spark):
    _, test = train_test(split_data(keyed(spark, 100), "key", seed=7))
    wanted = sorted(range(100), key=lambda k: hashlib.md5(f"7-{k}".encode()).hexdigest())[:20]
    assert sorted(r.key for r in test.collect()) == sorted(wanted)


def test_same_split_on_any_partitioning(spark):
    df = keyed(spark, 200)
    a = split_data(df.repartition(7), "key").collect()
    b = split_data(df.coalesce(1), "key").collect()
    assert sorted(a) == sorted(b)
    assert sorted(a) != sorted(split_data(df, "key", seed=1).collect())


def test_single_row_and_unknown_columns(spark):
    with pytest.raises(ValueError):
        split_data(keyed(spark, 1), "key")
    with pytest.raises(ValueError):
        split_data(keyed(spark, 10), "key", "NOT_THERE")
    with pytest.raises(ValueError):
        split_data(keyed(spark, 10), "key", test_size=1.5)


def test_a_key_that_a_third_of_the_rows_share(spark):
    df = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("key"), (F.col("id") % 7).alias("v"))
    for size in (0.2, 0.35, 0.5):
        out = split_data(df, "key", test_size=size)
        assert out.where("split = 'test'").count() == math.ceil(300 * size)
        assert sorted(out.drop("split").collect()) == sorted(df.collect())


def test_equal_rows_keep_their_number(spark):
    df = spark.range(90).select(F.lit(1).alias("key"), F.lit("x").alias("s"), F.when(F.col("id") > -1, 2.0).alias("d"))
    out = split_data(df, "key", test_size=0.25)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"test": 23, "train": 67}
    assert out.drop("split").distinct().collect() == df.distinct().collect()


@pytest.mark.parametrize("limit", [100_000, 10])
def test_stratified(spark, monkeypatch, limit):
    monkeypatch.setattr(order_stats, "FETCH_ROWS", limit)
    df = spark.range(400).select(F.col("id").alias("key"), F.when(F.col("id") < 133, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("s"))
    out = split_data(df, "key", stratify="s", test_size=0.25)
    assert out.where("split = 'test'").count() == 100
    for r in out.groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r.t in (math.floor(r.n / 4), math.ceil(r.n / 4))


def test_stratum_of_one_row(spark):
    with pytest.raises(ValueError):
        split_data(keyed(spark, 10), "key", stratify="MEDV")


def test_fold_sizes_and_order(spark):
    out = assign_folds(keyed(spark, 12).repartition(5), "key", 5).orderBy("key").collect()
    assert [r.fold for r in out] == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4]


def test_folds_over_equal_rows(spark):
    df = spark.range(10).select(F.lit(5).alias("key"), F.lit(1.0).alias("v"))
    out = assign_folds(df, "key", 3)
    assert sorted(r["count"] for r in out.groupBy("fold").count().collect()) == [3, 3, 4]


def test_folds_need_rows_and_order(spark):
    with pytest.raises(ValueError):
        assign_folds(keyed(spark, 3), "key", 5)
    with pytest.raises(ValueError):
        assign_folds(spark.sql("SELECT * FROM VALUES (1), (NULL), (3) AS t(key)"), "key", 2)


def test_folds_ordered_by_text(spark):
    names = ["b", "a", "", "aaaaaaaab", "aaaaaaaaa", "z" * 20 + "1", "z" * 20 + "0", "é", "a\0", "Z"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.fold for r in assign_folds(df, "name", 10).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names, key=lambda s: s.encode()))}
