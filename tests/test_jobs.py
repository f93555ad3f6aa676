"""Sources, sinks, validation, scoring, streams and the command-line jobs end to end."""

import datetime as dt

import pytest
import yaml
from pyspark.sql import functions as F

from numerant.functions.rules import HOUSING_FIELDS, HOUSING_RULES, violations
from numerant.jobs import evaluate, ingest, preprocess, profile, score, train
from numerant.operators.split import split_data
from numerant.plans.profile import suggested_config
from numerant.plans.scoring import Scorer, invalid_rows, parted, request_columns, valid_rows, validate
from numerant.sources.documents import load_config, load_metrics, save_yaml
from numerant.sources.tables import load_raw_data, load_split_data, read_table, save_split_data, target_last
from numerant.streaming.monitor import error_rate, throughput
from numerant.streaming.scoring import read_requests, score_stream, start_scoring

VALID = dict(CRIM=0.00632, ZN=18.0, INDUS=2.31, CHAS=0, NOX=0.538, RM=6.575, AGE=65.2, DIS=4.09, RAD=1, TAX=296.0, PTRATIO=15.3, B=396.9, LSTAT=4.98)


@pytest.fixture
def requests(spark):
    def make(*changes):
        rows = [{**VALID, **c} for c in changes]
        schema = ", ".join(f"{f} double" for f in HOUSING_FIELDS)
        return spark.createDataFrame([tuple(None if r[f] is None else float(r[f]) for f in HOUSING_FIELDS) for r in rows], schema)

    return make


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "with space.csv"
    path.write_text("A,B,name,MEDV\n1,4,x,7\nNA,5.5,,8\n3,nan,NULL,9\n")
    df = load_raw_data(spark, str(path))
    assert df.dtypes == [("A", "double"), ("B", "double"), ("name", "string"), ("MEDV", "bigint")]
    assert [tuple(r) for r in df.collect()] == [(1.0, 4.0, "x", 7), (None, 5.5, None, 8), (3.0, None, None, 9)]
    typed = read_table(spark, str(path), df.select("A", F.col("B").cast("double"), "name", F.col("MEDV").cast("double")).schema)
    assert typed.schema["MEDV"].dataType.simpleString() == "double"


def test_cells_are_parsed_once_to_split(spark, tmp_path, monkeypatch):
    """Odd cells get the types they had; the passes of the split read a typed copy, not the text."""
    path = tmp_path / "odd.csv"
    lines = [f"{i}, +{i} ,{i}.,1e{i % 9},{'9' * 18},{'9' * 19},{'' if i % 2 else i},{'.' if i == 3 else i},{i}.5" for i in range(40)]
    path.write_text("k,a,b,c,d,e,f,g,MEDV\n" + "\n".join(lines) + "\n")
    seen = []
    monkeypatch.setattr(ingest, "split_data", lambda df, *rest: seen.append(df) or split_data(df, *rest))
    assert ingest.main(["--input", str(path), "--output", str(tmp_path / "out"), "--key", "k"]) == 0
    assert [t for _, t in seen[0].dtypes] == ["bigint", "bigint", "double", "double", "bigint", "double", "double", "string", "double"]
    assert all(f.endswith(".parquet") for f in seen[0].inputFiles())
    train, test = load_split_data(spark, str(tmp_path / "out"), "MEDV")
    assert test.count() == 8 and sorted(r.a for r in train.unionByName(test).collect()) == list(range(40))


def test_raw_scan_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw_data(spark, str(tmp_path / "nothing.csv"))
    (tmp_path / "empty.csv").write_text("A,B\n")
    with pytest.raises(ValueError):
        load_raw_data(spark, str(tmp_path / "empty.csv"))


def test_parquet_nan_becomes_null(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(str(tmp_path / "p"))
    assert sorted(r.x is None for r in read_table(spark, str(tmp_path / "p")).collect()) == [False, True]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_split_round_trip(spark, frame, tmp_path, fmt):
    df = frame({"MEDV": [1, 2, 3], "A": [4, None, 6]}).withColumn("split", F.expr("CASE WHEN A = 6 THEN 'test' ELSE 'train' END"))
    save_split_data(df, str(tmp_path / "out dir"), "MEDV", fmt=fmt)
    parts = load_split_data(spark, str(tmp_path / "out dir"), "MEDV")
    assert [p.columns for p in parts] == [["A", "MEDV"]] * 2 and [p.count() for p in parts] == [2, 1]
    with pytest.raises(ValueError):
        load_split_data(spark, str(tmp_path / "out dir"), "OTHER")
    with pytest.raises(FileNotFoundError):
        load_split_data(spark, str(tmp_path / "nothing"), "MEDV")
    with pytest.raises(ValueError):
        target_last(df, "OTHER")


def test_config_files(tmp_path):
    path = str(tmp_path / "c" / "config.yaml")
    save_yaml(path, {"z": 1, "a": [1, 2]})
    assert list(load_config(path)) == ["z", "a"]
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "nothing.yaml"))


@pytest.mark.parametrize("field,value", [("CRIM", -1), ("ZN", 150), ("CHAS", 2), ("NOX", 2), ("RM", -1), ("PTRATIO", 100), ("RAD", 1.5), ("AGE", None), ("TAX", float("nan"))])
def test_invalid_fields(requests, field, value):
    found = invalid_rows(validate(requests({field: value}))).collect()
    assert len(found) == 1 and len(found[0].violations) == 1 and found[0].violations[0].startswith(f"{field}: ")


def test_valid_rows(requests):
    ends = dict(CRIM=0, ZN=100, INDUS=0, CHAS=1, NOX=1, RM=20, AGE=100, DIS=0, RAD=24, TAX=0, PTRATIO=50, B=0, LSTAT=100)
    df = validate(requests({}, ends, {"RM": -1, "ZN": 101}))
    assert valid_rows(df).count() == 2 and len(invalid_rows(df).first().violations) == 2
    assert invalid_rows(validate(requests({}).drop("RM"))).first().violations == ["RM: missing"]
    assert request_columns(requests({}).select(*reversed(HOUSING_FIELDS))).columns == HOUSING_FIELDS


def test_parts_are_told_apart_by_plain_comparisons(requests):
    odd = [{"CRIM": None}, {"CRIM": float("nan")}, {"CHAS": 0.5}, {"RAD": 0}, {"RM": -1, "ZN": 101, "AGE": None}, {"TAX": float("inf")}, {"B": -0.0}, {}]
    for df in (requests(*odd), requests(*odd).withColumn("INDUS", F.expr("IF(B = 0, 'much', '3')")), requests(*odd).drop("RM")):
        valid, invalid = parted(df)
        texts = [violations(HOUSING_RULES, df.columns).alias("v"), *df.columns]
        rows = df.select(*texts).collect()
        assert sorted(str(r) for r in valid.collect()) == sorted(str(r) for r in df.select(*texts).where("size(v) = 0").drop("v").collect())
        assert sorted(r.violations for r in invalid.collect()) == sorted(r.v for r in rows if r.v)
        assert sorted(r.violations for r in validate(df).collect()) == sorted(r.v for r in rows)
        assert "lambda" not in valid._jdf.queryExecution().executedPlan().toString()  # no texts for rows that keep all rules


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    """A project folder taken through ingest, preprocess and train."""
    base = tmp_path_factory.mktemp("project")
    raw = spark.range(240).selectExpr(
        "CASE WHEN id % 9 = 0 THEN NULL ELSE (id * 7) % 50 / 10.0 END AS CRIM", "id % 5 * 20.0 AS ZN", "id % 27 * 1.0 AS INDUS", "id % 2 AS CHAS",
        "0.4 + id % 6 / 20.0 AS NOX", "5 + (id * 13) % 40 / 10.0 AS RM", "CASE WHEN id % 11 = 0 THEN NULL ELSE (id * 3) % 101 END AS AGE",
        "1 + id % 11 / 2.0 AS DIS", "1 + id % 24 AS RAD", "200 + (id * 17) % 500 AS TAX", "12 + id % 9 AS PTRATIO", "300.0 + id % 97 AS B",
        "2 + (id * 31) % 35 * 1.0 AS LSTAT", "10 + 3 * ((id * 13) % 40 / 10.0) - 0.2 * ((id * 31) % 35) AS MEDV",
    )
    raw.coalesce(1).write.csv(str(base / "raw.csv"), header=True, nullValue="NA")
    assert ingest.main(["--input", str(base / "raw.csv"), "--output", str(base / "split")]) == 0
    assert preprocess.main(["--input-dir", str(base / "split"), "--output-dir", str(base / "interim"), "--artifacts-dir", str(base / "prep"), "--config", _packaged("preprocessing.yaml")]) == 0
    config = load_config(_packaged("models.yaml"))
    config["training"].update(data_dir=str(base / "interim"), model_dir=str(base / "models"))
    config["models"]["xgboost"]["params"]["n_estimators"] = 5
    config["validation"]["cv_folds"] = 3
    save_yaml(str(base / "models.yaml"), config)
    assert train.main(["--config", str(base / "models.yaml"), "--models", "ridge", "xgboost", "mlp"]) == 0
    return base


def _packaged(name):
    import numerant

    return f"{numerant.__path__[0]}/configs/{name}"


def test_ingest_and_preprocess(spark, project):
    parts = load_split_data(spark, str(project / "split"), "MEDV")
    assert [p.count() for p in parts] == [192, 48]
    processed = spark.read.parquet(str(project / "interim" / "split_processed"))
    features = [c for c in processed.columns if c not in ("MEDV", "_row_id", "split")]
    assert len(features) == 17 and "accessibility_score" not in features and not {"RAD", "B"} & set(features)


def test_train_outputs(spark, project):
    models = project / "models"
    table = spark.read.csv(str(models / "model_comparison_baseline.csv"), header=True)
    assert {r.model for r in table.collect()} == {"ridge", "xgboost"} and len(table.columns) == 11
    for name in ("best_model", "best_model_baseline", "ridge_model"):
        assert (models / name).exists()
    assert yaml.safe_load((models / "best_model_metadata.yaml").read_text())["model_name"] in ("ridge", "xgboost")
    assert spark.read.parquet(str(models / "runs")).count() == 2


def test_evaluate_job(project):
    args = ["--model", str(project / "models" / "best_model"), "--data-dir", str(project / "interim"), "--output-dir", str(project / "report"), "--include-train"]
    assert evaluate.main(args) == 0
    assert {"test_rmse", "train_rmse", "test_median_error"} <= set(load_metrics(str(project / "report" / "best_model_metrics.json")))
    assert evaluate.main(["--model", str(project / "nothing"), "--data-dir", str(project / "interim")]) == 1


def test_profile_job(spark, project):
    assert profile.main(["--input", str(project / "raw.csv"), "--output", str(project / "profile")]) == 0
    config = load_config(str(project / "profile" / "preprocessing.yaml"))
    assert "CRIM" not in config["feature_processing"]["handling_na"]["no_action"] and config["feature_processing"]["scaler"] == "RobustScaler"
    assert spark.read.parquet(str(project / "profile" / "correlations")).count() == 14 * 14
    made = suggested_config(spark.read.parquet(str(project / "split" / "split")).drop("split"), median=["CRIM"])
    assert made["feature_processing"]["handling_na"]["median"] == ["CRIM"]


def scorer_of(project):
    return Scorer.load(str(project / "prep" / "data_preprocessor"), str(project / "prep" / "feature_engineer"), str(project / "models" / "best_model"))


def test_batch_and_stream_scores_agree(spark, project, requests, tmp_path):
    df = requests({}, {"RM": 7}, {"RM": -1}, {"LSTAT": 30, "AGE": 3}, {"TAX": None})
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    assert score.main(["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--keep", "RM", *_artifacts(project)]) == 0
    batch = spark.read.parquet(str(tmp_path / "out"))
    assert batch.columns == ["RM", "predicted_price", "model_name", "model_version"] and batch.count() == 3
    assert spark.read.parquet(str(tmp_path / "out_invalid")).count() == 2
    args = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "stream"), "--keep", "RM", "--stream", "--once", *_artifacts(project)]
    assert score.main(args) == 0
    stream = spark.read.parquet(str(tmp_path / "stream")).select(*batch.columns)
    assert sorted(stream.collect()) == sorted(batch.collect())
    assert spark.read.parquet(str(tmp_path / "stream_invalid")).count() == 2


def _artifacts(project):
    return ["--preprocessor", str(project / "prep" / "data_preprocessor"), "--engineer", str(project / "prep" / "feature_engineer"), "--model", str(project / "models" / "best_model")]


def test_stateless_stream_plan(spark, project, requests, tmp_path):
    df = requests({}, {"RM": 8})
    df.write.parquet(str(tmp_path / "in"))
    stream = score_stream(read_requests(spark, str(tmp_path / "in"), schema=df.schema), scorer_of(project), ["RM"])
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_a_second_run_scores_only_new_files(spark, project, requests, tmp_path):
    paths = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "c")
    for i in range(2):
        requests({"RM": 5 + i}).write.mode("append").parquet(paths[0])
        start_scoring(read_requests(spark, paths[0], schema=requests({}).schema), scorer_of(project), *paths[1:], ["RM"], trigger={"availableNow": True}).awaitTermination()
        assert spark.read.parquet(paths[1]).count() == i + 1


def test_empty_batch_and_missing_artifacts(project, requests):
    with pytest.raises(ValueError):
        scorer_of(project).score(requests({}).limit(0))
    from numerant.plans.preprocessing import DataPreprocessor

    with pytest.raises(ValueError):
        Scorer(DataPreprocessor({}), None, None)


def test_sliding_windows(spark):
    at = dt.datetime(2024, 1, 1, 0, 4, 30)
    df = spark.createDataFrame([(at, "view"), (at, "error"), (at + dt.timedelta(minutes=1), "view")], "ts timestamp_ntz, event_type string")
    rate = {r.window_start.minute: (r.errors, r.requests) for r in error_rate(df).collect()}
    assert rate[0] == (1, 2) and rate[4] == (1, 3) and rate[5] == (0, 1) and len(rate) == 6
    per = throughput(df, by=()).where("requests = 3").first()
    assert per.per_second == pytest.approx(0.01)


def test_watermarked_stream_closes_windows(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1, h, m), "view") for h in range(3) for m in range(0, 60, 10)]
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string").write.parquet(str(tmp_path / "in"))
    stream = throughput(spark.readStream.schema("ts timestamp_ntz, event_type string").parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert 0 < out.count() <= 18 * 5 and out.agg(F.max("window_end")).first()[0] <= dt.datetime(2024, 1, 1, 2, 40)
