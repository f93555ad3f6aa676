"""Queries that run the jobs one after the other, sources that are hard to read, reports, streams as in production, checked trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..jobs import evaluate, ingest, preprocess, score, train
from ..operators.split import assign_folds
from ..operators.stats import null_counts
from ..plans.base import column_changes
from ..plans.models import REGISTRY, as_pipeline, assemble, feature_importance, fit_regressor, predict
from ..plans.profile import suggested_config
from ..session import scratch_path
from ..sources.documents import load_config, load_metrics, save_yaml
from ..sources.runs import RunLog
from ..sources.tables import load_processed_data, load_raw_data, load_split_data, read_table, save_split_data
from ..streaming.monitor import error_rate, latency_quantiles, throughput
from .modeling import CUSTOMER_FEATURES, customers, fitted_scorer, search, sql_linear
from .registry import FEATURES, H_COLUMNS, H_CTE, housing, query, r, rounded, scan, sql_metrics, sql_r, table, union_all
from .statistics import SPLIT_CTE
from .streams import _SLIDES, _START, ONCE, _text_start, stream_of

# --- the jobs, from a raw file to scores

# An order as a house: every field of a request, LSTAT with holes, a key, and a target.
_HOUSE = {
    "CRIM": "o_orderkey % 50 / 10.0", "ZN": "o_orderkey % 5 * 20.0", "INDUS": "o_custkey % 27 + 0.5", "CHAS": "o_orderkey % 2", "NOX": "0.4 + o_orderkey % 6 / 20.0",
    "RM": "5 + o_orderkey % 40 / 10.0", "AGE": "o_custkey % 101", "DIS": "1 + o_orderkey % 11 / 2.0", "RAD": "1 + o_orderkey % 24", "TAX": "200 + o_custkey % 500",
    "PTRATIO": "12 + o_orderkey % 9", "B": "300 + o_orderkey % 97", "LSTAT": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 1 + o_totalprice / 20000 END",
    "MEDV": "5 + o_totalprice / 15000 + o_custkey % 7",
}
_DOUBLES = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _HOUSE.items())
_HOUSES = f"{SPLIT_CTE}, o AS (SELECT o_orderkey, split, {_DOUBLES} FROM labelled)"
_MEDIAN = "(SELECT quantile_cont(LSTAT, 0.5) FROM o WHERE split = 'train')"
_PREPARED = (
    f"{_HOUSES}, i AS (SELECT o_orderkey, split, MEDV AS y, coalesce(LSTAT, {_MEDIAN}) AS x FROM o), "
    "z AS (SELECT o_orderkey, split, y, (x - (SELECT avg(x) FROM i WHERE split = 'train')) / (SELECT stddev_pop(x) FROM i WHERE split = 'train') AS z FROM i)"
)
_MODEL = f"{_PREPARED}, coef AS ({sql_linear('z', 'y', '(SELECT * FROM z WHERE split = $$train$$)')}), s AS (SELECT split, o_orderkey, y, w * z + b AS p FROM z, coef)"


def _run_jobs(spark: SparkSession, sf_dir: str, last: str) -> dict[str, str]:
    """Run the jobs up to ``last`` on a CSV of houses, default flags but for paths and key; their folders."""
    base = scratch_path(spark, "chain")
    paths = {n: f"{base}/{n}" for n in ("raw.csv", "split", "interim", "prep", "models", "evaluation", "scores")}
    houses = scan(spark, sf_dir, "orders").selectExpr("o_orderkey", *[f"CAST({e} AS DOUBLE) AS {c}" for c, e in _HOUSE.items()])
    houses.write.csv(paths["raw.csv"], header=True, nullValue="NA")
    config = {"feature_processing": {
        "handling_na": {"median": ["LSTAT"]}, "handling_correlated_features": {"remove": [c for c in FEATURES if c != "LSTAT"]}, "scaler": "StandardScaler",
    }}
    save_yaml(f"{base}/preprocessing.yaml", config, spark)
    models = {"ridge": {"enabled": True, "module": "sklearn.linear_model", "class": "Ridge", "params": {}}, "off": {"enabled": False, "module": "none", "class": "None"}}
    models |= {"absent": {"enabled": True, "module": "sklearn.neural_network", "class": "MLPRegressor", "params": {}}}
    training = {"models": models, "training": {"target_column": "MEDV", "model_dir": paths["models"], "data_dir": paths["interim"]}, "validation": {"cv_folds": 5}}
    save_yaml(f"{base}/models.yaml", training, spark)
    steps = {
        "ingest": lambda: ingest.ingest(spark, ingest.arguments(["--input", paths["raw.csv"], "--output", paths["split"], "--key", "o_orderkey"])),
        "preprocess": lambda: preprocess.preprocess(spark, preprocess.arguments([
            "--config", f"{base}/preprocessing.yaml", "--input-dir", paths["split"], "--output-dir", paths["interim"], "--artifacts-dir", paths["prep"], "--key", "o_orderkey"])),
        "train": lambda: train.train(spark, train.arguments(["--config", f"{base}/models.yaml", "--order-by", "o_orderkey"])),
        "evaluate": lambda: evaluate.evaluate(spark, evaluate.arguments([
            "--model", f"{paths['models']}/best_model", "--data-dir", paths["interim"], "--output-dir", paths["evaluation"], "--include-train"])),
        "score": lambda: score.score(spark, score.arguments([
            "--input", paths["split"] + "/split", "--output", paths["scores"], "--preprocessor", f"{paths['prep']}/data_preprocessor", "--engineer", "",
            "--model", f"{paths['models']}/best_model", "--keep", "o_orderkey"])),
    }
    for name, step in steps.items():
        step()
        if name == last:
            return paths
    raise ValueError(last)


@query("job2_ingest", f"WITH {_HOUSES} SELECT split, o_orderkey, {', '.join(sql_r(c, 8) + ' AS ' + c for c in _HOUSE)} FROM o")
def job_ingest(spark, sf_dir):
    """Both parts as the job has written them."""
    parts = load_split_data(spark, _run_jobs(spark, sf_dir, "ingest")["split"], "MEDV")
    both = parts[0].withColumn("split", F.lit("train")).unionByName(parts[1].withColumn("split", F.lit("test")))
    return both.select("split", "o_orderkey", *[r(quoted(c).cast("double"), 8).alias(c) for c in _HOUSE])


@query("job3_preprocess", f"WITH {_PREPARED} SELECT split, o_orderkey, {sql_r('z')} AS LSTAT, {sql_r('y')} AS MEDV FROM z")
def job_preprocess(spark, sf_dir):
    parts = load_processed_data(spark, _run_jobs(spark, sf_dir, "preprocess")["interim"], "MEDV")
    both = parts[0].withColumn("split", F.lit("train")).unionByName(parts[1].withColumn("split", F.lit("test")))
    return both.select("split", "o_orderkey", r("LSTAT").alias("LSTAT"), r("MEDV").alias("MEDV"))


@query(
    "job4_train",
    f"WITH {_MODEL}, m AS (SELECT 'ridge' AS model, {sql_metrics('y', 'p')} FROM s WHERE split = 'test') SELECT model, rmse AS test_rmse, mae AS test_mae, r2 AS test_r2 FROM m",
)
def job_train(spark, sf_dir):
    """The comparison the job has written: a disabled model and one of a missing module are not in it."""
    found = read_table(spark, f"{_run_jobs(spark, sf_dir, 'train')['models']}/model_comparison_baseline.csv")
    cells = [r(F.col(f"test_{m}").cast("double")).alias(f"test_{m}") for m in ("rmse", "mae", "r2")]
    return found.select("model", *cells)


@query(
    "job5_report",
    f"WITH {_MODEL} " + union_all([
        f"SELECT '{p}_{k}' AS name, {sql_r(e)} AS value FROM s WHERE split = '{p}'" for p in ("train", "test")
        for k, e in {"rmse": "sqrt(avg((y - p) * (y - p)))", "mae": "avg(abs(y - p))", "max_error": "max(abs(y - p))", "median_error": "quantile_cont(abs(y - p), 0.5)"}.items()
    ]),
)
def job_report(spark, sf_dir):
    """The report the evaluation has written, read back."""
    found = load_metrics(f"{_run_jobs(spark, sf_dir, 'evaluate')['evaluation']}/best_model_metrics.json", spark)
    names = [f"{p}_{k}" for p in ("train", "test") for k in ("rmse", "mae", "max_error", "median_error")]
    return rounded(spark.createDataFrame([(n, float(found[n])) for n in names], "name string, value double"))


@query("job6_scores", f"WITH {_MODEL} SELECT s.o_orderkey, {sql_r('p')} AS predicted_price FROM s JOIN o USING (o_orderkey) WHERE o.LSTAT IS NOT NULL")
def job_scores(spark, sf_dir):
    """Scores of both parts; rows without LSTAT are invalid requests."""
    return rounded(spark.read.parquet(_run_jobs(spark, sf_dir, "score")["scores"]).select("o_orderkey", "predicted_price"))


# --- sources that are hard to read

@query("src1_csv_line_breaks", "SELECT count(*) AS documents, sum(length(text))::BIGINT AS chars, sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS line_breaks FROM documents")
def csv_line_breaks(spark, sf_dir):
    """Texts with line breaks and quotes through a CSV."""
    path = scratch_path(spark, "texts") + ".csv"
    texts = scan(spark, sf_dir, "documents").select("doc_id", "text")
    texts.write.csv(path, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    found = load_raw_data(spark, path)
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return found.agg(F.count("doc_id").alias("documents"), F.sum(F.length("text").cast("bigint")).alias("chars"), F.sum(breaks.cast("bigint")).alias("line_breaks"))


@query(
    "src1_csv_bad_cells",
    "SELECT 'l_orderkey' AS \"column\", 0 AS nulls, count(*) AS \"rows\" FROM lineitem UNION ALL SELECT 'l_quantity', count(*) FILTER (l_orderkey % 50 = 0), count(*) FROM lineitem "
    "UNION ALL SELECT 'refused', 1, 1",
)
def csv_bad_cells(spark, sf_dir):
    """Numbers that are none: refused, or counted and read as missing if that is asked for."""
    path = scratch_path(spark, "bad") + ".csv"
    lines = scan(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "IF(l_orderkey % 50 = 0, 'n/q', CAST(l_quantity AS STRING)) AS l_quantity")
    lines.write.csv(path, header=True)
    schema = spark.createDataFrame([], "l_orderkey bigint, l_quantity double").schema
    try:
        read_table(spark, path, schema)
        refused = 0
    except ValueError:
        refused = 1
    counts = null_counts(read_table(spark, path, schema, bad_cells="null")).select("column", "nulls", "rows")
    return counts.unionByName(spark.createDataFrame([("refused", refused, 1)], "column string, nulls bigint, rows bigint"))


@query("snk1_split_written_twice", "SELECT 'train' AS split, count(*) AS \"rows\" FROM orders WHERE o_orderkey % 3 > 0 UNION ALL SELECT 'test', count(*) FROM orders WHERE o_orderkey % 3 = 0")
def split_written_twice(spark, sf_dir):
    """A CSV split over a Parquet split of other rows: only the later one is there."""
    path, orders = scratch_path(spark, "twice"), scan(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    save_split_data(orders.limit(10).withColumn("split", F.expr("IF(o_orderkey % 2 = 0, 'test', 'train')")), path, "o_totalprice")
    save_split_data(orders.withColumn("split", F.expr("IF(o_orderkey % 3 = 0, 'test', 'train')")), path, "o_totalprice", fmt="csv")
    train_, test_ = load_split_data(spark, path, "o_totalprice")
    return train_.withColumn("split", F.lit("train")).unionByName(test_.withColumn("split", F.lit("test"))).groupBy("split").agg(F.count("*").alias("rows"))


# --- folds by keys that no 64-bit number holds

def _fold_sql(order: str, key: str, source: str) -> str:
    return f"WITH k AS (SELECT {key}, row_number() OVER (ORDER BY {order}) - 1 AS place, count(*) OVER () AS n FROM {source}) SELECT {key}, ((place * 5 + 4) // n)::INT AS fold FROM k WHERE n % 5 = 0"


@query("ord2_folds_by_text", _fold_sql("text, doc_id", "doc_id", "documents"))
def folds_by_text(spark, sf_dir):
    """Whole texts put documents in order; the number of documents is a multiple of five."""
    docs = scan(spark, sf_dir, "documents").select("text", "doc_id")
    return assign_folds(docs, ["text", "doc_id"], 5).select("doc_id", "fold")


@query("ord2_folds_by_decimal", _fold_sql("(o_orderkey * 7919) % 100003, o_orderkey", "o_orderkey", "orders"))
def folds_by_decimal(spark, sf_dir):
    """Keys of 38 digits that doubles cannot tell apart."""
    key = F.expr("CAST(12345678901234567890000000000000000000BD AS DECIMAL(38,0)) + CAST((o_orderkey * 7919) % 100003 AS DECIMAL(38,0))").cast("decimal(38,0)")
    return assign_folds(scan(spark, sf_dir, "orders").select(key.alias("key"), "o_orderkey"), ["key", "o_orderkey"], 5).select("o_orderkey", "fold")


# --- streams in append mode: windows the watermark has closed

_CLOSED = "WHERE start + 300 <= (SELECT epoch(max(ts)) - 600 FROM events)"


def _appended(df: DataFrame) -> DataFrame:
    """Run a windowed stream in append mode; what it has written for closed windows."""
    spark = df.sparkSession
    base = scratch_path(spark, "closed")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    writer = df.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
    writer.trigger(**ONCE).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query(
    "str3_closed_windows",
    f"WITH {_SLIDES} SELECT strftime({_START}, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS requests FROM w {_CLOSED} GROUP BY start, event_type",
)
def closed_throughput(spark, sf_dir):
    out = _appended(throughput(stream_of(spark, sf_dir, "events")))
    return _text_start(out).select("window_start", "event_type", "requests")


@query(
    "str4_closed_windows",
    f"WITH {_SLIDES} SELECT strftime({_START}, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (event_type = 'error') AS errors, count(*) AS requests FROM w {_CLOSED} GROUP BY start",
)
def closed_error_rate(spark, sf_dir):
    out = _appended(error_rate(stream_of(spark, sf_dir, "events")))
    return _text_start(out).select("window_start", "errors", "requests")


@query(
    "str5_closed_windows",
    f"WITH w AS (SELECT floor(epoch(ts) / 300)::BIGINT * 300 AS start, value FROM events) SELECT strftime({_START}, '%Y-%m-%d %H:%M:%S') AS window_start, "
    f"count(*) AS requests, true AS p50, true AS p95, true AS p99 FROM w {_CLOSED} GROUP BY start",
)
def closed_latency(spark, sf_dir):
    """Quantiles of the stream by the ranks they have among the events of their window: off by one rank at most."""
    out = _text_start(_appended(latency_quantiles(stream_of(spark, sf_dir, "events"))))
    events = _text_start(table(spark, sf_dir, "events").select(F.window(F.col("ts").cast("timestamp"), "300 seconds")["start"].alias("window_start"), "value"))
    joined = events.join(out, "window_start").groupBy("window_start")
    ranks = {}
    for name, p in {"p50": 0.5, "p95": 0.95, "p99": 0.99}.items():
        below, upto = F.count_if(F.col("value") < F.col(name)), F.count_if(F.col("value") <= F.col(name))
        ranks[name] = (below - 1 <= p * F.count("*")) & (p * F.count("*") <= upto + 1)
    return joined.agg(F.count("*").alias("requests"), *[v.alias(n) for n, v in ranks.items()])


# --- trees with a closed form: one split of one feature

def _stump_sql() -> str:
    """The best split by variance on the nation key and the means of its sides."""
    source = (
        "c AS (SELECT c_custkey, c_nationkey::double AS f, target FROM customer JOIN "
        "(SELECT o_custkey, avg(o_totalprice) AS target FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"
    )
    return (
        f"{source}, v AS (SELECT f, count(*) AS n, sum(target) AS s FROM c GROUP BY f), "
        "k AS (SELECT f, sum(n) OVER (ORDER BY f) AS ln, sum(s) OVER (ORDER BY f) AS ls, sum(n) OVER () AS n, sum(s) OVER () AS s FROM v), "
        "b AS (SELECT f, ls / ln AS low, (s - ls) / (n - ln) AS high FROM k WHERE ln < n ORDER BY ls * ls / ln + (s - ls) * (s - ls) / (n - ln) DESC, f LIMIT 1)"
    )


def _stump(spark, sf_dir, module: str, name: str, params: dict) -> tuple:
    df = customers(spark, sf_dir)
    rows = assemble(df, ["c_nationkey"], "target", ["c_custkey"])
    return as_pipeline(fit_regressor(REGISTRY[(module, name)], params, rows), ["c_nationkey"]), df


_STUMP_ROWS = f"WITH {_stump_sql()} SELECT c_custkey, {sql_r('CASE WHEN c.f <= b.f THEN low ELSE high END', 4)} AS prediction FROM c, b"


@query("ml2_forest_of_one_split", _STUMP_ROWS)
def forest_of_one_split(spark, sf_dir):
    model, df = _stump(spark, sf_dir, "sklearn.ensemble", "RandomForestRegressor", {"n_estimators": 1, "max_depth": 1, "bootstrap": False})
    return predict(model, df).select("c_custkey", r("prediction", 4).alias("prediction"))


@query("ml3_boosting_of_one_split", _STUMP_ROWS)
def boosting_of_one_split(spark, sf_dir):
    """Without penalties the first full step of boosting is the tree of the labels themselves."""
    model, df = _stump(spark, sf_dir, "xgboost", "XGBRegressor", {"n_estimators": 1, "max_depth": 1, "learning_rate": 1.0, "reg_lambda": 0.0})
    return predict(model, df).select("c_custkey", r("prediction", 4).alias("prediction"))


# Two rounds with both penalties on two features, split by split.
PENALISED = {"n_estimators": 2, "max_depth": 1, "learning_rate": 0.5, "reg_lambda": 50.0, "reg_alpha": 20_000.0}


def _rounds_sql(rounds: int = 2) -> str:
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - {PENALISED['reg_alpha']}, 0))"
    score = lambda g, n: f"{soft(g)} * {soft(g)} / ({n} + {PENALISED['reg_lambda']})"
    ctes = [
        "p0 AS (SELECT l_quantity::DOUBLE AS a, l_discount::DOUBLE AS b, count(*) AS n, sum(l_extendedprice) AS s, "
        "(SELECT avg(l_extendedprice) FROM lineitem) AS guess FROM lineitem GROUP BY l_quantity, l_discount)"
    ]
    for i in range(rounds):
        ctes += [
            f"v{i} AS (SELECT 0 AS f, a AS v, sum(n * guess - s) AS g, sum(n) AS n FROM p{i} GROUP BY a UNION ALL SELECT 1, b, sum(n * guess - s), sum(n) FROM p{i} GROUP BY b)",
            f"k{i} AS (SELECT f, v, sum(g) OVER w AS lg, sum(n) OVER w AS ln, sum(g) OVER (PARTITION BY f) AS g, sum(n) OVER (PARTITION BY f) AS n FROM v{i} WINDOW w AS (PARTITION BY f ORDER BY v))",
            f"b{i} AS (SELECT f, v, -{soft('lg')} / (ln + {PENALISED['reg_lambda']}) AS low, -{soft('(g - lg)')} / (n - ln + {PENALISED['reg_lambda']}) AS high FROM k{i} WHERE ln < n "
            f"ORDER BY {score('lg', 'ln')} + {score('(g - lg)', '(n - ln)')} DESC, f, v LIMIT 1)",
            f"p{i + 1} AS (SELECT a, b, p{i}.n, s, guess + {PENALISED['learning_rate']} * CASE WHEN CASE f WHEN 0 THEN a ELSE b END <= v THEN low ELSE high END AS guess FROM p{i}, b{i})",
        ]
    return f"WITH {', '.join(ctes)} SELECT a AS l_quantity, b AS l_discount, {sql_r('guess', 4)} AS prediction FROM p{rounds}"


@query("ml3_boosting_two_rounds", _rounds_sql())
def boosting_two_rounds(spark, sf_dir):
    """Gains and weights with L1 and L2 terms, from histograms over all lines."""
    names = ["l_quantity", "l_discount"]
    lines = table(spark, sf_dir, "lineitem").select(*(F.col(c).cast("double").alias(c) for c in names), F.col("l_extendedprice").cast("double").alias("target"))
    model = as_pipeline(fit_regressor(REGISTRY[("xgboost", "XGBRegressor")], PENALISED, assemble(lines, names, "target")), names)
    return predict(model, lines.select(*names).distinct()).select(*names, r("prediction", 4).alias("prediction"))


@query("ml12_importance_of_one_split", "SELECT 'c_nationkey' AS feature, 1.0::DOUBLE AS importance UNION ALL SELECT 'constant', 0.0::DOUBLE FROM (SELECT count(*) AS n FROM customer) WHERE n > 0")
def importance_of_one_split(spark, sf_dir):
    """All importance is with the feature that is split."""
    df = customers(spark, sf_dir).withColumn("constant", F.lit(1.0))
    names = ["c_nationkey", "constant"]
    model = fit_regressor(REGISTRY[("sklearn.ensemble", "RandomForestRegressor")], {"n_estimators": 1, "max_depth": 1, "bootstrap": False}, assemble(df, names, "target"))
    return feature_importance(as_pipeline(model, names), spark)



# --- the models with their default parameters, and the search

_SPLIT_TARGETS = (
    "c AS (SELECT c_custkey, target, row_number() OVER (ORDER BY c_custkey) - 1 AS place, count(*) OVER () AS n FROM customer JOIN "
    "(SELECT o_custkey, avg(o_totalprice) AS target FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey), "
    # contiguous folds, the first n % 5 of which hold one row more; the last one is the test part
    "t AS (SELECT target, place >= n - n // 5 AS test FROM c)"
)
_MEAN_RMSE = sql_r('sqrt(avg((target - (SELECT avg(target) FROM t WHERE NOT test)) ^ 2) FILTER (test))', 4)
_BEATS_MEAN = f"WITH {_SPLIT_TARGETS} SELECT count(*) FILTER (test) AS \"rows\", {_MEAN_RMSE} AS mean_rmse, true AS beats_mean FROM t"


def _against_mean(spark, sf_dir, module: str, name: str) -> DataFrame:
    """Train with default parameters on four folds of customers; is the error on the fifth below that of the mean?"""
    names = ["orders", "total"]
    total = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("total"))
    path = scratch_path(spark, "customers")  # read by many passes: joined and summed up once
    customers(spark, sf_dir).join(total, "c_custkey").write.parquet(path)
    parts = assign_folds(spark.read.parquet(path), "c_custkey", 5)
    train, test = parts.where("fold < 4"), parts.where("fold = 4")
    model = as_pipeline(fit_regressor(REGISTRY[(module, name)], {}, assemble(train, names, "target")), names)
    mean = train.agg(F.avg("target")).first()[0]
    error = lambda guess: F.sqrt(F.avg((F.col("target") - guess) ** 2))
    found = predict(model, test).agg(F.count("*").alias("rows"), error(F.lit(mean)).alias("m"), error(F.col("prediction")).alias("e"))
    return found.select("rows", r("m", 4).alias("mean_rmse"), (F.col("e") < F.col("m")).alias("beats_mean"))


@query("ml2_forest_defaults", _BEATS_MEAN)
def forest_defaults(spark, sf_dir):
    """100 trees, as deep as they grow."""
    return _against_mean(spark, sf_dir, "sklearn.ensemble", "RandomForestRegressor")


@query("ml3_boosting_defaults", _BEATS_MEAN)
def boosting_defaults(spark, sf_dir):
    """100 rounds of depth 6."""
    return _against_mean(spark, sf_dir, "xgboost", "XGBRegressor")


@query(
    "ml9_ml10_search_checked",
    f"WITH {_SPLIT_TARGETS} SELECT 2 AS trials, true AS best_is_least, {_MEAN_RMSE} AS mean_rmse, true AS beats_mean FROM t",
)
def search_checked(spark, sf_dir):
    """The search names the trial of least error, and its refit beats the mean."""
    found = {x["name"]: x["value"] for x in search(spark, sf_dir).collect()}
    trials = {n: v for n, v in found.items() if n.startswith("trial_")}
    parts = assign_folds(customers(spark, sf_dir), "c_custkey", 5)
    mean = parts.where("fold < 4").agg(F.avg("target")).first()[0]
    m = parts.where("fold = 4").agg(F.sqrt(F.avg((F.col("target") - F.lit(mean)) ** 2)).alias("m"))
    least = min(trials.values()) == found["best_cv_rmse"]
    return m.select(F.lit(len(trials)).alias("trials"), F.lit(least).alias("best_is_least"), r("m", 4).alias("mean_rmse"), (F.lit(found["test_rmse"]) < F.col("m")).alias("beats_mean"))


# --- small sinks and rules

@query("snk9_src5_profile_config", f"WITH {H_CTE} " + union_all([f"SELECT '{c}' AS \"column\", count(*) = count({c}) AS no_action FROM h" for c in H_COLUMNS]))
def profile_config(spark, sf_dir):
    """The suggested configuration, written as YAML and loaded again."""
    path = f"{scratch_path(spark, 'profile')}/suggested.yaml"
    save_yaml(path, suggested_config(housing(spark, sf_dir)), spark)
    alone = load_config(path, spark)["feature_processing"]["handling_na"]["no_action"]
    return spark.createDataFrame([(c, c in alone) for c in H_COLUMNS], "column string, no_action boolean")


@query("scl16_flt7_runs", "SELECT 'ridge' AS model_name, count(*) FILTER (o_orderkey IS NOT NULL) > 0 AS trained_at_set, 1 AS runs FROM orders")
def runs_of_a_job(spark, sf_dir):
    """Disabled, filtered and failing models leave no run; the trained one leaves a row with its time."""
    runs = RunLog(spark, _run_jobs(spark, sf_dir, "train")["models"]).read()
    return runs.groupBy("model_name").agg(F.bool_and(F.col("trained_at").isNotNull()).alias("trained_at_set"), F.count("*").cast("int").alias("runs"))


@query("set3_column_changes", union_all([f"SELECT '{c}' AS \"column\", 'removed' AS change FROM (SELECT count(*) AS n FROM orders) WHERE n > 0" for c in FEATURES if c != "LSTAT"]))
def columns_changed(spark, sf_dir):
    paths = _run_jobs(spark, sf_dir, "preprocess")
    before, after = (load_split_data(spark, paths["split"], "MEDV")[0], load_processed_data(spark, paths["interim"], "MEDV")[0])
    removed, added = column_changes(before.columns, after.columns)
    return spark.createDataFrame([(c, "removed") for c in removed] + [(c, "added") for c in added], "column string, change string")


@query("flt5_empty_batch", f"WITH {H_CTE} SELECT count(*) AS scored, true AS refused FROM h WHERE MEDV < -1")
def empty_batch(spark, sf_dir):
    """A batch without rows is refused, or scored to a table without rows if that is asked for."""
    h = housing(spark, sf_dir)
    scorer, none = fitted_scorer(h), h.where("MEDV < -1")
    try:
        scorer.score(none, ["MEDV"])
        refused = False
    except ValueError:
        refused = True
    return scorer.score(none, ["MEDV"], allow_empty=True).agg(F.count("*").alias("scored")).withColumn("refused", F.lit(refused))
