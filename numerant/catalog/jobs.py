"""Queries that take whole jobs through their files: processed tables, models, runs, reports."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..operators.split import assign_folds
from ..plans.evaluation import ModelEvaluator
from ..plans.models import predict
from ..plans.profile import profile
from ..plans.training import ModelTrainer
from ..session import cached, scratch_path
from ..sources.tables import load_processed_data, save_processed_data
from .modeling import ORDER_CTE, RIDGE, SCORE_CTES, fitted_scorer, order_rows, sql_linear
from .registry import H_COLUMNS, H_CTE, housing, query, r, rounded, sql_metrics, sql_r, union_all
from .statistics import SPLIT_CTE, _corr_sql, order_split

_DESCRIBED = {
    "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "q1": "quantile_cont({c}, 0.25)", "median": "quantile_cont({c}, 0.5)",
    "q3": "quantile_cont({c}, 0.75)", "max": "max({c})",
}


@query("src3_src4_processed_tables", f"WITH {SPLIT_CTE} SELECT count(*) AS \"rows\", {sql_r('avg(o_totalprice)', 4)} AS mean FROM labelled WHERE split = 'test'")
def processed_tables(spark, sf_dir):
    """Write a processed pair; read the test part alone, which touches its partition only."""
    path = scratch_path(spark, "interim")
    save_processed_data(order_split(spark, sf_dir).select("o_orderkey", "o_totalprice", "split"), path, "o_totalprice")
    (test,) = load_processed_data(spark, path, "o_totalprice", ("test",))
    return test.agg(F.count(F.lit(1)).alias("rows"), r(F.avg("o_totalprice"), 4).alias("mean"))


@query("snk4_model_round_trip", f"WITH {SCORE_CTES} SELECT count(*) AS \"rows\", {sql_r('avg(w * z + b)')} AS mean, {sql_r('max(w * z + b)')} AS top FROM z, coef")
def model_round_trip(spark, sf_dir):
    """Save a model, load it, score with the loaded one."""
    h = housing(spark, sf_dir)
    scorer, path = fitted_scorer(h), scratch_path(spark, "model")
    scorer.model.write().overwrite().save(path)
    scored = predict(PipelineModel.load(path), scorer.preprocess(h))
    return scored.agg(F.count(F.lit(1)).alias("rows"), r(F.avg("prediction")).alias("mean"), r(F.max("prediction")).alias("top"))


_RMSE = "sqrt(avg((y - (w * x1 + b)) ^ 2) FILTER (fold {} 4))"


@query(
    "snk5_snk6_run_log",
    f"WITH {ORDER_CTE}, c AS ({sql_linear('x1', 'y', '(SELECT * FROM o WHERE fold < 4)')}) SELECT 'model_ridge' AS run_name, 'Ridge' AS model_class, "
    f"count(*) FILTER (fold < 4) AS n_train, count(*) FILTER (fold = 4) AS n_test, {sql_r(_RMSE.format('<'), 4)} AS train_rmse, {sql_r(_RMSE.format('='), 4)} AS test_rmse FROM o, c",
)
def run_log(spark, sf_dir):
    """Train with a model folder and read the row it left in the runs table."""
    rows = assign_folds(order_rows(spark, sf_dir), "o_orderkey", 5).drop("x2")
    config = {"models": {"ridge": RIDGE}, "training": {"target_column": "y", "model_dir": scratch_path(spark, "models")}, "validation": {"cv_folds": 3}}
    trainer = ModelTrainer(config, spark, ["o_orderkey"])
    trainer.train_all_models(rows.where("fold < 4").drop("fold"), rows.where("fold = 4").drop("fold"))
    cells = [r(F.col("metrics")[m], 4).alias(m) for m in ("train_rmse", "test_rmse")]
    return trainer.run_log.read().select("run_name", "model_class", "n_train", "n_test", *cells)


@query(
    "job1_profile",
    f"WITH {H_CTE} " + union_all(
        [f"SELECT 'no_action' AS part, '{c}' AS name, '' AS other, (count(*) = count({c}))::INT::DOUBLE AS value FROM h" for c in H_COLUMNS]
        + [f"SELECT 'nulls', '{c}', '', (count(*) - count({c}))::DOUBLE FROM h" for c in H_COLUMNS]
        + [f"SELECT '{k}', '{c}', '', {sql_r(e.format(c=c), 4)} FROM h" for c in H_COLUMNS for k, e in _DESCRIBED.items()]
        + [
            f"SELECT 'outliers', '{c}', '', count(*) FILTER ({c} < q1 - 1.5::double * (q3 - q1) OR {c} > q3 + 1.5::double * (q3 - q1))::DOUBLE "
            f"FROM h, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM h)" for c in H_COLUMNS
        ]
        + [f"SELECT 'corr', '{a}', '{b}', {sql_r(_corr_sql(a, b), 4)} FROM h" for a in H_COLUMNS for b in H_COLUMNS]
        + ["SELECT 'duplicates', '', '', (sum(c - 1))::DOUBLE FROM (SELECT count(*) AS c FROM h GROUP BY " + ", ".join(H_COLUMNS) + ")"]
    ),
)
def profile_tables(spark, sf_dir):
    """All tables of the profile of the view, as one: nulls, description, outliers, correlations, duplicates, configuration."""
    p = profile(housing(spark, sf_dir))
    alone = p.config["feature_processing"]["handling_na"]["no_action"]
    cell = lambda part, name, other, value: F.struct(F.lit(part).alias("part"), name.alias("name"), other.alias("other"), value.cast("double").alias("value"))
    none = F.lit("")

    def of(df, *cells):
        return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")

    c = F.col("column")
    parts = [
        of(p.nulls, cell("no_action", c, none, c.isin(alone).cast("int")), cell("nulls", c, none, F.col("nulls"))),
        of(p.describe, *[cell(k, c, none, r(F.col(k), 4)) for k in _DESCRIBED]),
        of(p.outliers, cell("outliers", c, none, F.col("outliers"))),
        of(p.correlations, cell("corr", F.col("col_a"), F.col("col_b"), r(F.col("corr"), 4))),
        of(p.duplicates, cell("duplicates", none, none, F.col("duplicates"))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "job5_evaluate",
    f"WITH {SCORE_CTES}, s AS (SELECT y, w * z + b AS p FROM z, coef) SELECT rmse AS test_rmse, mae AS test_mae, r2 AS test_r2, mape AS test_mape, x AS test_max_error, m AS test_median_error FROM "
    f"(SELECT {sql_metrics('y', 'p')}, {sql_r('max(abs(y - p))')} AS x, {sql_r('quantile_cont(abs(y - p), 0.5)')} AS m FROM s)",
)
def evaluate(spark, sf_dir):
    """Evaluate a saved model on prepared rows."""
    h = housing(spark, sf_dir)
    scorer, path = fitted_scorer(h), scratch_path(spark, "model")
    scorer.model.write().overwrite().save(path)
    with cached(scorer.preprocess(h)) as rows:
        metrics = ModelEvaluator(spark, path, "ridge").evaluate(rows)
    return rounded(spark.createDataFrame([tuple(metrics.values())], ", ".join(f"{k} double" for k in metrics)))
