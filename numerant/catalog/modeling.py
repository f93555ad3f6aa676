"""Queries on metrics, cross-validation, models, selection and chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.split import assign_folds
from ..plans.evaluation import error_distribution, prediction_summary, residual_histogram, residual_points
from ..plans.models import PREDICTION, REGISTRY, as_pipeline, assemble, feature_importance, fit_regressor, predict
from ..plans.preprocessing import DataPreprocessor
from ..plans.scoring import Scorer, valid_rows, validate
from ..plans.training import FOLD, ModelOptimizer, ModelTrainer, cross_validate
from ..session import cached
from .registry import FEATURES, H_CTE, housing, query, r, rounded, scan, sql_median, sql_metrics, sql_r, table, union_all
from .statistics import FOLD_CTE, SPLIT_CTE, histogram_sql, kept, order_split

# A prediction to measure: price of a line from its quantity.
Y, P = "l_extendedprice", "l_quantity * 1500"
E = f"({Y} - {P})"


def predicted_lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(Y, f"{P} AS guess")


@query("agg19_metrics", f"SELECT {sql_metrics(Y, P)} FROM lineitem")
def regression_metrics(spark, sf_dir):
    return rounded(metrics.regression_metrics(predicted_lines(spark, sf_dir), Y, "guess"))


@query(
    "agg21_metrics_extended",
    f"SELECT rmse AS test_rmse, mae AS test_mae, r2 AS test_r2, mape AS test_mape, x AS test_max_error, m AS test_median_error FROM "
    f"(SELECT {sql_metrics(Y, P)}, {sql_r(f'max(abs({E}))')} AS x, {sql_r(f'quantile_cont(abs({E}), 0.5)')} AS m FROM lineitem)",
)
def metrics_extended(spark, sf_dir):
    return rounded(metrics.extended_metrics(predicted_lines(spark, sf_dir), Y, "guess", "test_"))


_PART_RMSE = "sqrt(avg((o_totalprice - 250000) ^ 2) FILTER (split = '{}'))"


@query(
    "agg24_overfit_flag",
    f"WITH {SPLIT_CTE}, m AS (SELECT {sql_r(_PART_RMSE.format('train'))} AS train_rmse, {sql_r(_PART_RMSE.format('test'))} AS test_rmse FROM labelled) "
    "SELECT *, train_rmse - test_rmse < -1.0 AS overfit FROM m",
)
def overfit_flag(spark, sf_dir):
    rows = order_split(spark, sf_dir).withColumn("guess", F.lit(250000.0))
    per = metrics.regression_metrics(rows, "o_totalprice", "guess", by=["split"])
    one = per.groupBy().pivot("split", ["train", "test"]).agg(F.first("rmse"))
    one = one.select(r("train").alias("train_rmse"), r("test").alias("test_rmse"))
    return one.withColumn("overfit", metrics.overfit_flag(F.col("train_rmse"), F.col("test_rmse")))


# Three closed-form predictors of an order's price, compared on train and test parts.
GUESSES = {"flat": "250000.0", "by_key": "200000.0 + o_orderkey % 1000", "by_customer": "240000.0 + o_custkey % 100 * 100"}


def order_metrics(spark, sf_dir) -> DataFrame:
    """(model, metric, value) of every predictor on both parts, in one pass."""
    rows = order_split(spark, sf_dir)
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(f"CAST({e} AS DOUBLE)").alias("guess")) for m, e in GUESSES.items()])
    long = rows.select("split", "o_totalprice", F.inline(cells))
    per = metrics.regression_metrics(long, "o_totalprice", "guess", by=["split", "model"])
    return per.unpivot(["split", "model"], list(metrics.METRICS), "name", "value").select(
        "model", F.concat_ws("_", "split", "name").alias("metric"), "value"
    )


_MODEL_METRICS = union_all(
    [f"SELECT '{m}' AS model, split, {sql_metrics('o_totalprice', e.replace('.0', '.0::double'))} FROM labelled GROUP BY split" for m, e in GUESSES.items()]
)
_PARTS = [f"{p}_{k}" for p in ("train", "test") for k in metrics.METRICS]
_COMPARED = f"{SPLIT_CTE}, m AS ({_MODEL_METRICS}), c AS (SELECT model, " + ", ".join(
    f"max({k}) FILTER (split = '{p}') AS {p}_{k}" for p in ("train", "test") for k in metrics.METRICS
) + " FROM m GROUP BY model)"


@query("agg20_comparison_table", f"WITH {_COMPARED} SELECT * FROM c")
def comparison_table(spark, sf_dir):
    return rounded(metrics.comparison_table(order_metrics(spark, sf_dir), _PARTS))


@query("agg23_best_model", f"WITH {_COMPARED} SELECT model, test_rmse FROM c ORDER BY test_rmse, model LIMIT 1")
def best_model(spark, sf_dir):
    scores: dict[str, dict[str, float]] = {}
    for row in order_metrics(spark, sf_dir).where("metric LIKE 'test%'").orderBy("model").collect():
        scores.setdefault(row["model"], {})[row["metric"].removeprefix("test_")] = row["value"]
    name = metrics.best_name(scores, "test_rmse")
    return rounded(spark.createDataFrame([(name, scores[name]["rmse"])], "model string, test_rmse double"))


@query("cht5_model_comparison", f"WITH {_COMPARED} SELECT model, test_r2 AS value, test_r2 = (SELECT max(test_r2) FROM c) AS best FROM c")
def model_comparison(spark, sf_dir):
    compared = metrics.comparison_table(order_metrics(spark, sf_dir), _PARTS)
    return rounded(metrics.flag_best(kept(compared), "test_r2"))


@query(
    "agg27_gain",
    f"WITH {_COMPARED}, x AS (SELECT max(test_rmse) AS a, min(test_rmse) AS b FROM c) SELECT {sql_r('a - b', 4)} AS gain, {sql_r('(a - b) / a * 100', 4)} AS percent FROM x",
)
def gain(spark, sf_dir):
    row = order_metrics(spark, sf_dir).where("metric = 'test_rmse'").agg(F.max("value").alias("a"), F.min("value").alias("b")).first()
    return rounded(spark.createDataFrame([metrics.optimisation_gain(row.a, row.b)], "gain double, percent double"), 4)


# --- linear models with closed forms

def sql_linear(x: str, y: str, source: str, alpha: float = 1.0) -> str:
    """Slope and intercept of ridge on one feature."""
    return (
        f"SELECT w, avg_y - w * avg_x AS b FROM (SELECT covar_pop({y}, {x}) * count(*) / (var_pop({x}) * count(*) + {alpha}::double) AS w, "
        f"avg({x}) AS avg_x, avg({y}) AS avg_y FROM {source})"
    )


def order_rows(spark, sf_dir) -> DataFrame:
    """Orders with two features; the rest of an order plays no part."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(o_custkey % 100 AS DOUBLE) AS x1", "CAST(o_orderkey % 37 AS DOUBLE) AS x2", "o_totalprice + 1000 * (o_custkey % 100) AS y"
    )


ORDER_CTE = (
    "o AS (SELECT o_orderkey, (o_custkey % 100)::double AS x1, (o_orderkey % 37)::double AS x2, o_totalprice + 1000 * (o_custkey % 100) AS y, "
    "ntile(5) OVER (ORDER BY o_orderkey) - 1 AS fold FROM orders)"
)


@query(
    "ml4_ridge",
    f"WITH {ORDER_CTE}, s AS (SELECT count(*)::double AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) + 10::double / count(*) AS a, covar_pop(x1, x2) AS b, "
    "var_pop(x2) + 10::double / count(*) AS d, covar_pop(y, x1) AS p, covar_pop(y, x2) AS q FROM o), "
    "w AS (SELECT *, (p * d - b * q) / (a * d - b * b) AS w1, (a * q - b * p) / (a * d - b * b) AS w2 FROM s) "
    f"SELECT {sql_r('w1', 3)} AS w1, {sql_r('w2', 3)} AS w2, {sql_r('my - w1 * m1 - w2 * m2', 2)} AS intercept FROM w",
)
def ridge(spark, sf_dir):
    rows = assemble(order_rows(spark, sf_dir), ["x1", "x2"], "y")
    m = fit_regressor(REGISTRY[("sklearn.linear_model", "Ridge")], {"alpha": 10.0}, rows)
    w = m.coefficients.toArray().tolist()
    out = spark.createDataFrame([(*w, m.intercept)], "w1 double, w2 double, intercept double")
    return out.select(r("w1", 3).alias("w1"), r("w2", 3).alias("w2"), r("intercept", 2).alias("intercept"))


@query(
    "ml5_elastic_net",
    f"WITH {ORDER_CTE}, s AS (SELECT avg(x1) AS mx, avg(y) AS my, var_pop(x1) AS v, covar_pop(y, x1) AS c FROM o), "
    "w AS (SELECT *, sign(c) * greatest(abs(c) - 200.0::double * 0.5, 0) / (v + 200.0::double * 0.5) AS w1 FROM s) "
    f"SELECT {sql_r('w1', 3)} AS w1, {sql_r('my - w1 * mx', 2)} AS intercept FROM w",
)
def elastic_net(spark, sf_dir):
    rows = assemble(order_rows(spark, sf_dir), ["x1"], "y")
    m = fit_regressor(REGISTRY[("sklearn.linear_model", "ElasticNet")], {"alpha": 200.0, "l1_ratio": 0.5}, rows)
    out = spark.createDataFrame([(float(m.coefficients[0]), m.intercept)], "w1 double, intercept double")
    return out.select(r("w1", 3).alias("w1"), r("intercept", 2).alias("intercept"))


_FOLD_SCORES = f"{ORDER_CTE}, f AS (" + union_all(
    [
        f"SELECT {k} AS fold, sqrt(avg((y - (w * x1 + b)) ^ 2)) AS score FROM o, ({sql_linear('x1', 'y', f'(SELECT * FROM o WHERE fold <> {k})')}) WHERE fold = {k}"
        for k in range(5)
    ]
) + ")"


def _fold_scores(spark, sf_dir) -> DataFrame:
    rows = assign_folds(order_rows(spark, sf_dir), "o_orderkey", 5, FOLD)
    with cached(assemble(rows, ["x1"], "y", [FOLD])) as folded:
        return cross_validate(REGISTRY[("sklearn.linear_model", "Ridge")], {}, folded, 5)


@query("ml8_cross_validation", f"WITH {_FOLD_SCORES} SELECT fold::INTEGER AS fold, {sql_r('score', 4)} AS score FROM f")
def cross_validation(spark, sf_dir):
    return rounded(_fold_scores(spark, sf_dir), 4)


@query(
    "agg22_cv_summary",
    f"WITH {_FOLD_SCORES} SELECT {sql_r('avg(score)', 4)} AS cv_mean, {sql_r('stddev_pop(score)', 4)} AS cv_std, {sql_r('min(score)', 4)} AS cv_min, {sql_r('max(score)', 4)} AS cv_max FROM f",
)
def cv_summary(spark, sf_dir):
    return rounded(metrics.cv_summary(_fold_scores(spark, sf_dir)), 4)


@query(
    "agg22_fold_means",
    f"WITH {FOLD_CTE}, m AS (SELECT fold, sum(o_totalprice) AS s, count(*) AS n FROM folded GROUP BY fold), "
    "t AS (SELECT a.fold, sum(b.s) / sum(b.n) AS mean FROM m a JOIN m b ON a.fold <> b.fold GROUP BY a.fold), "
    "s AS (SELECT fold, sqrt(avg((o_totalprice - mean) ^ 2)) AS score FROM folded JOIN t USING (fold) GROUP BY fold) "
    f"SELECT {sql_r('avg(score)', 4)} AS cv_mean, {sql_r('stddev_pop(score)', 4)} AS cv_std, {sql_r('min(score)', 4)} AS cv_min, {sql_r('max(score)', 4)} AS cv_max FROM s",
)
def fold_means(spark, sf_dir):
    """The error of predicting each fold by the mean of the others, from per-fold sums alone."""
    y = F.col("o_totalprice")
    folded = assign_folds(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 5)
    per = folded.groupBy("fold").agg(F.sum(y).alias("s"), F.count(y).alias("n"), F.avg(y).alias("m"), F.var_pop(y).alias("v"))
    rows = per.collect()  # five
    s, n = sum(x.s for x in rows), sum(x.n for x in rows)
    scores = [(x.fold, (x.v + (x.m - (s - x.s) / (n - x.n)) ** 2) ** 0.5) for x in rows]
    return rounded(metrics.cv_summary(spark.createDataFrame(scores, "fold int, score double")), 4)


# --- scoring

# One prepared feature and a ridge on it: the whole path from raw rows to scores in closed form.
SCORE_CONFIG = {
    "handling_na": {"median": ["LSTAT"]},
    "handling_outliers": {"log_transform": ["LSTAT"], "capping_winsor": ["LSTAT"]},
    "handling_correlated_features": {"remove": [c for c in FEATURES if c != "LSTAT"]},
    "scaler": "StandardScaler",
}
SCORE_CTES = (
    f"{H_CTE}, u AS (SELECT ln(1 + abs(coalesce(LSTAT, {sql_median('LSTAT', 'h')}))) AS x, MEDV AS y, CRIM, CHAS, AGE, LSTAT FROM h), "
    "wl AS (SELECT max(x) FILTER (rn = floor(0.05::double * n)::BIGINT + 1) AS lo, max(x) FILTER (rn = n - floor(0.05::double * n)::BIGINT) AS hi "
    "FROM (SELECT x, row_number() OVER (ORDER BY x) AS rn, count(*) OVER () AS n FROM u)), "
    "i AS (SELECT least(greatest(x, lo), hi) AS x, y, CRIM, CHAS, AGE, LSTAT FROM u, wl), "
    "z AS (SELECT *, (x - (SELECT avg(x) FROM i)) / (SELECT stddev_pop(x) FROM i) AS z FROM i), "
    f"coef AS ({sql_linear('z', 'y', 'z')})"
)


def fitted_scorer(h: DataFrame) -> Scorer:
    """Preprocessing and ridge fitted on the view; columns that are dropped anyway are kept as names only."""
    gone = SCORE_CONFIG["handling_correlated_features"]["remove"]
    with cached(h.select(*[c for c in h.columns if c not in gone])) as kept:
        h = kept.withColumns({c: F.lit(None).cast("double") for c in gone})
        prep = DataPreprocessor(SCORE_CONFIG, ["MEDV"]).fit(h, cache=False)
        rows = assemble(prep.transform_training(h), ["LSTAT"], "MEDV")
        model = fit_regressor(REGISTRY[("sklearn.linear_model", "Ridge")], {}, rows)
    return Scorer(prep, None, as_pipeline(model, ["LSTAT"]), "ridge", "1.0.0")


@query("ml11_score_rows", f"WITH {SCORE_CTES} SELECT {sql_r('y')} AS MEDV, {sql_r('w * z + b')} AS predicted_price, 'ridge' AS model_name, '1.0.0' AS model_version FROM z, coef")
def score_rows(spark, sf_dir):
    h = housing(spark, sf_dir)
    return rounded(fitted_scorer(h).score(h, ["MEDV"]))


@query(
    "job6_validated_scores",
    f"WITH {SCORE_CTES} SELECT {sql_r('y')} AS MEDV, {sql_r('w * z + b')} AS predicted_price, 'ridge' AS model_name, '1.0.0' AS model_version FROM z, coef "
    "WHERE CRIM IS NOT NULL AND CHAS IS NOT NULL AND AGE IS NOT NULL AND LSTAT IS NOT NULL",
)
def validated_scores(spark, sf_dir):
    """Only rows that pass validation are scored."""
    h = housing(spark, sf_dir)
    return rounded(fitted_scorer(h).score(valid_rows(validate(h)), ["MEDV"]))


@query(
    "agg19_model_metrics",
    f"WITH {SCORE_CTES}, s AS (SELECT y, w * z + b AS p FROM z, coef) SELECT {sql_metrics('y', 'p')} FROM s",
)
def model_metrics(spark, sf_dir):
    """Metrics of the fitted model on the rows it scores."""
    h = housing(spark, sf_dir)
    scored = fitted_scorer(h).score(h, ["MEDV"])
    return rounded(metrics.regression_metrics(scored, "MEDV", "predicted_price"))


# --- trees, training runs and search: no closed form, rows only

TREES = {"n_estimators": 10, "max_depth": 5}
FOREST = {"enabled": True, "module": "sklearn.ensemble", "class": "RandomForestRegressor", "params": TREES}
BOOSTING = {"enabled": True, "module": "xgboost", "class": "XGBRegressor", "params": {"n_estimators": 8, "max_depth": 4}}
RIDGE = {"enabled": True, "module": "sklearn.linear_model", "class": "Ridge", "params": {}}
ABSENT = {"enabled": True, "module": "sklearn.neural_network", "class": "MLPRegressor", "params": {}}
CUSTOMER_FEATURES = ["c_nationkey", "segment", "orders", "spent"]


def customers(spark, sf_dir) -> DataFrame:
    """One row per customer: predict the mean order price from counts and codes."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("orders"), F.max("o_totalprice").alias("spent"), F.avg("o_totalprice").alias("target")
    )
    people = scan(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("c_nationkey"), F.pmod(F.xxhash64("c_mktsegment"), F.lit(5)).cast("double").alias("segment"))
    return people.join(orders, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", *CUSTOMER_FEATURES, "target")


def _tree_scores(spark, sf_dir, spec) -> DataFrame:
    df = customers(spark, sf_dir)
    with cached(assemble(df, CUSTOMER_FEATURES, "target", ["c_custkey"])) as rows:
        builder = REGISTRY[(spec["module"], spec["class"])]
        model = fit_regressor(builder, spec["params"], rows)
    return predict(as_pipeline(model, CUSTOMER_FEATURES), df).select("c_custkey", "target", PREDICTION)


@query("ml2_random_forest")
def random_forest(spark, sf_dir):
    return _tree_scores(spark, sf_dir, FOREST)


@query("ml3_boosting")
def boosting(spark, sf_dir):
    return _tree_scores(spark, sf_dir, BOOSTING)


@query("ml12_ord4_feature_importance")
def importance(spark, sf_dir):
    with cached(assemble(customers(spark, sf_dir), CUSTOMER_FEATURES, "target")) as rows:
        model = fit_regressor(REGISTRY[(FOREST["module"], FOREST["class"])], TREES, rows)
    return feature_importance(as_pipeline(model, CUSTOMER_FEATURES), spark)


def _trained(spark, sf_dir, models) -> tuple[ModelTrainer, DataFrame, DataFrame]:
    df = customers(spark, sf_dir)
    parts = assign_folds(df, "c_custkey", 5)
    train, test = parts.where("fold < 4").drop("fold"), parts.where("fold = 4").drop("fold")
    config = {"models": models, "training": {"target_column": "target"}, "validation": {"cv_folds": 3}}
    return ModelTrainer(config, spark, ["c_custkey"]), train, test


@query("ml6_ml7_train_models")
def train_models(spark, sf_dir):
    """A forest and a ridge are trained; a model of a missing module is passed over."""
    trainer, train, test = _trained(spark, sf_dir, {"random_forest": FOREST, "ridge": RIDGE, "mlp": ABSENT})
    return trainer.train_all_models(train, test).compare_models()


@query("ml9_ml10_search")
def search(spark, sf_dir):
    """Two seeded trials over a narrowed space, then the refit with the better one."""
    trainer, train, test = _trained(spark, sf_dir, {"xgboost": BOOSTING})
    space = {"xgboost": {"max_depth": ("int", 2, 4), "learning_rate": ("log", 0.05, 0.3), "n_estimators": ("int", 3, 6)}}
    optimizer = ModelOptimizer("xgboost", trainer, spaces=space)
    with cached(train) as train, cached(test) as test:
        optimizer.optimize(train, 2)
        _, measured = optimizer.train_best_model(train, test)
    rows = [(f"trial_{t['trial']}", float(t["cv_rmse"])) for t in optimizer.trials] + [("best_cv_rmse", optimizer.best_value), *measured.items()]
    return spark.createDataFrame(rows, "name string, value double")


# --- chart data

@query("scl15_cht1_residuals", f"SELECT {sql_r(Y)} AS actual, {sql_r(P)} AS predicted, {sql_r(E)} AS residual, {sql_r(f'abs({E})')} AS absolute_error, {sql_r(f'abs({E}) / abs({Y}) * 100')} AS percentage_error FROM lineitem")
def residuals(spark, sf_dir):
    return rounded(residual_points(predicted_lines(spark, sf_dir), Y, "guess"))


def _points(spark, sf_dir) -> DataFrame:
    return residual_points(predicted_lines(spark, sf_dir), Y, "guess")


@query("cht1_residual_histogram", histogram_sql("lineitem", {"residual": E}))
def residual_bins(spark, sf_dir):
    return residual_histogram(_points(spark, sf_dir)).select("column", "bin", "count")


@query(
    "cht2_prediction_summary",
    f"SELECT min(least({Y}, {P})) AS min_value, max(greatest({Y}, {P})) AS max_value, {sql_r(f'1 - sum({E} * {E}) / (var_pop({Y}) * count(*))')} AS r2 FROM lineitem",
)
def prediction_frame(spark, sf_dir):
    return rounded(prediction_summary(_points(spark, sf_dir)))


@query("cht3_error_distribution", histogram_sql("lineitem", {"absolute_error": f"abs({E})", "percentage_error": f"(abs({E}) / abs({Y}) * 100)"}))
def error_bins(spark, sf_dir):
    return error_distribution(_points(spark, sf_dir))[0].select("column", "bin", "count")


@query("cht3_error_means", f"SELECT {sql_r(f'avg(abs({E}))')} AS mean_absolute, {sql_r(f'avg(abs({E}) / abs({Y}) * 100)')} AS mean_percentage FROM lineitem")
def error_means(spark, sf_dir):
    return rounded(error_distribution(_points(spark, sf_dir))[1])
