"""Results do not depend on size limits, micro-batches, formats left behind, or the form of a key."""

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from numerant.operators import order_stats, sizing
from numerant.operators.order_stats import grouped_quantiles
from numerant.operators.sizing import broadcast_if_small
from numerant.operators.split import assign_folds, numbered_in_order, split_data
from numerant.plans.models import REGISTRY, LabelStats, assemble, as_pipeline, fit_regressor
from numerant.plans.preprocessing import DataPreprocessor
from numerant.plans.scoring import Scorer
from numerant.session import scratch_path, shared_folder
from numerant.sources.tables import load_split_data, read_table, save_split_data
from numerant.streaming.scoring import start_scoring


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stratified_split_with_any_limit(spark, monkeypatch):
    """20 strata, of which more than one has the largest remainder; a key shared by many rows of one stratum."""
    df = spark.range(700).select(
        F.when(F.col("id") < 250, 0).otherwise(F.col("id")).alias("key"), F.concat(F.lit("s"), F.col("id") % 20).alias("s"), (F.col("id") % 3).alias("v")
    )
    whole = rows_of(split_data(df, "key", stratify="s", test_size=0.23))
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(order_stats, "FETCH_ROWS", 1)
    assert rows_of(split_data(df, "key", stratify="s", test_size=0.23)) == whole
    assert sum(r[-1] == "test" for r in whole) == math.ceil(700 * 0.23)


@pytest.mark.parametrize("limit", [100_000, 1])
def test_infinite_values_in_groups(spark, limit):
    data = {"a": [-math.inf, 1.0, 2.0, math.inf, math.inf], "b": [3.0] * 5, "c": [-math.inf, 5.0], "d": [math.inf]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    got = {r.k: (r.low, r.mid, r.high) for r in grouped_quantiles(df, ["k"], "v", {"low": 0.0, "mid": 0.5, "high": 0.9}, limit).collect()}
    assert got == {"a": (-math.inf, 2.0, math.inf), "b": (3.0, 3.0, 3.0), "c": (-math.inf, -math.inf, -math.inf), "d": (math.inf,) * 3}


def test_folds_by_exact_decimals(spark):
    keys = [Decimal(2**53 + i) for i in range(10)]
    df = spark.createDataFrame([(k,) for k in keys], "key decimal(20,0)")
    assert [r.fold for r in assign_folds(df, "key", 5).orderBy("key").collect()] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    wide = [Decimal(f"-9{i:037d}") for i in range(6)] + [Decimal(f"{i:038d}") for i in range(6)]
    df = spark.createDataFrame([(k,) for k in wide], "key decimal(38,0)")
    assert [r.fold for r in assign_folds(df, "key", 3).orderBy("key").collect()] == [0] * 4 + [1] * 4 + [2] * 4


def test_folds_by_long_texts_take_few_jobs(spark):
    names = ["p" * 3000 + f"{i:03d}" for i in range(12)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string")
    spark.sparkContext.setJobGroup("folds", "folds")
    got = assign_folds(df, "name", 5).orderBy("name").collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("folds"))
    spark.sparkContext.setJobGroup("", "")
    assert [r.fold for r in got] == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4] and jobs < 15


def test_rows_numbered_in_order(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("a"), F.concat(F.lit("x"), F.col("id") % 11).alias("b"), "id")
    got = numbered_in_order(df, ["b", "a"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(500)) and [(r.b, r.a) for r in got] == sorted((r.b, r.a) for r in got)


def test_broadcast_counts_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, size=5000)) and not hinted(broadcast_if_small(df, limit=9))


def test_depth_and_bootstrap_are_not_swallowed(spark):
    forest = REGISTRY[("sklearn.ensemble", "RandomForestRegressor")]
    with pytest.raises(ValueError, match="30"):
        forest({"max_depth": 50}, LabelStats(1, 1.0))
    assert REGISTRY[("xgboost", "XGBRegressor")]({"max_depth": 31}).spec.depth == 31
    assert forest({"bootstrap": False}, LabelStats(1, 1.0)).getBootstrap() is False


def test_line_breaks_and_bad_cells(spark, tmp_path):
    path = str(tmp_path / "broken.csv")
    (tmp_path / "broken.csv").write_text('A,name\n1,"two\nlines"\n2,plain\n')
    assert [tuple(r) for r in read_table(spark, path).orderBy("A").collect()] == [(1, "two\nlines"), (2, "plain")]
    (tmp_path / "bad.csv").write_text("A,B\n1,2\nx,3\nNA,y\n")
    schema = spark.createDataFrame([], "A bigint, B bigint").schema
    with pytest.raises(ValueError, match="'A': 1, 'B': 1"):
        read_table(spark, str(tmp_path / "bad.csv"), schema)
    assert rows_of(read_table(spark, str(tmp_path / "bad.csv"), schema, bad_cells="null")) == sorted([(1, 2), (None, 3), (None, None)], key=str)


@pytest.mark.parametrize("first,second", [("parquet", "csv"), ("csv", "parquet")])
def test_split_written_twice(spark, frame, tmp_path, first, second):
    folder = str(tmp_path / "split")
    save_split_data(frame({"MEDV": [1, 2, 3]}).withColumn("split", F.expr("IF(MEDV < 3, 'train', 'test')")), folder, "MEDV", fmt=first)
    save_split_data(frame({"MEDV": [4, 5, 6, 7]}).withColumn("split", F.expr("IF(MEDV < 7, 'train', 'test')")), folder, "MEDV", fmt=second)
    assert [p.count() for p in load_split_data(spark, folder, "MEDV")] == [3, 1]
    (tmp_path / "split" / ("split" if second == "csv" else "train.csv")).mkdir()
    with pytest.raises(ValueError, match="both"):
        load_split_data(spark, folder, "MEDV")


def test_scores_do_not_depend_on_micro_batches(spark, tmp_path):
    rng = np.random.default_rng(5)
    data = spark.createDataFrame([(i, float(v), float(3 * v + rng.normal())) for i, v in enumerate(rng.lognormal(0, 2, 200))], "id bigint, PTRATIO double, y double")
    config = {"handling_outliers": {"capping_winsor": ["PTRATIO"]}, "scaler": "StandardScaler"}
    prep = DataPreprocessor(config, ["id", "y"]).fit(data)
    assert prep.options.get("winsor_mode", "per_batch") == "per_batch"
    rows = assemble(prep.transform(data), ["PTRATIO"], "y")
    model = as_pipeline(fit_regressor(REGISTRY[("sklearn.linear_model", "Ridge")], {}, rows), ["PTRATIO"])
    scorer = Scorer(prep, None, model)
    found = []
    for parts in (1, 8):
        base = str(tmp_path / str(parts))
        data.repartition(parts).write.parquet(f"{base}/in")
        stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        start_scoring(stream, scorer, f"{base}/out", f"{base}/bad", f"{base}/checkpoint", ["id"], rules=[], trigger={"availableNow": True}).awaitTermination()
        found.append(rows_of(spark.read.parquet(f"{base}/out").select("id", "predicted_price")))
    assert found[0] == found[1] == rows_of(scorer.score(data, ["id"]).select("id", "predicted_price"))


def test_scratch_is_shared_or_refused(spark, monkeypatch):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))

    class Cluster:
        conf = type("", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = type("", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())
