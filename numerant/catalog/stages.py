"""Queries on fitted stages and derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..plans.features import DomainFeatures, FeatureEngineer, InteractionFeatureCreator, PolynomialFeatureCreator
from ..plans.preprocessing import CorrelationReducer, DataPreprocessor, FeatureScaler, MissingValueHandler, OutlierHandler
from ..session import scratch_path
from .registry import FEATURES, H_CTE, housing, query, rounded, sql_clip, sql_median, sql_mode, sql_r, sql_scale, table
from .statistics import LINE

HOLED = ["CRIM", "AGE", "LSTAT", "CHAS"]

# The treatment of the housing-like columns.
NA = {"median": ["CRIM", "ZN", "INDUS", "AGE", "LSTAT"], "most_frequent": ["CHAS"], "no_action": ["NOX", "RM", "DIS", "RAD", "TAX", "PTRATIO", "B"]}
OUTLIERS = {"log_transform": ["CRIM", "ZN", "LSTAT"], "capping_iqr": ["RM", "B"], "capping_winsor": ["PTRATIO"]}
REDUCE = {"remove": ["RAD", "B"]}
PROCESSING = {"handling_na": NA, "handling_outliers": OUTLIERS, "handling_correlated_features": REDUCE, "scaler": "RobustScaler"}
KEPT = [c for c in FEATURES if c not in REDUCE["remove"]]


def _impute_sql(columns, fill) -> str:
    return f"WITH {H_CTE} SELECT " + ", ".join(sql_r(f"coalesce({c}, {fill(c)})") + f" AS {c}" for c in columns) + " FROM h"


def _imputed(spark, sf_dir, strategy, columns):
    df = housing(spark, sf_dir).select(*columns)
    return rounded(MissingValueHandler({strategy: columns}, columns).fit(df).transform(df))


@query("agg3_mean_impute", _impute_sql(HOLED, lambda c: f"(SELECT avg({c}) FROM h)"))
def mean_impute(spark, sf_dir):
    return _imputed(spark, sf_dir, "mean", HOLED)


@query("agg4_median_impute", _impute_sql(HOLED, lambda c: sql_median(c, "h")))
def median_impute(spark, sf_dir):
    return _imputed(spark, sf_dir, "median", HOLED)


@query("agg5_mode_impute", _impute_sql(HOLED, lambda c: sql_mode(c, "h")))
def mode_impute(spark, sf_dir):
    return _imputed(spark, sf_dir, "most_frequent", HOLED)


IMPUTED_CTE = "imp AS (SELECT " + ", ".join(
    (f"coalesce({c}, {sql_median(c, 'h')})" if c in NA["median"] else f"coalesce({c}, {sql_mode(c, 'h')})" if c in NA["most_frequent"] else c) + f" AS {c}"
    for c in FEATURES
) + ", MEDV FROM h)"


@query("cmp1_missing_values", f"WITH {H_CTE}, {IMPUTED_CTE} SELECT " + ", ".join(f"{sql_r(c, 7)} AS {c}" for c in [*FEATURES, "MEDV"]) + " FROM imp")
def missing_values(spark, sf_dir):
    h = housing(spark, sf_dir)
    return rounded(MissingValueHandler(NA, FEATURES).fit(h).transform(h), 7)


def outlier_ctes(source: str) -> str:
    """CTE 'treated' with log, IQR bounds of the values before the log, then per-frame winsorizing."""
    bounds = ", ".join(
        f"{sql_median(c, source, 0.25)} - 1.5::double * ({sql_median(c, source, 0.75)} - {sql_median(c, source, 0.25)}) AS lo_{c}, "
        f"{sql_median(c, source, 0.75)} + 1.5::double * ({sql_median(c, source, 0.75)} - {sql_median(c, source, 0.25)}) AS hi_{c}"
        for c in OUTLIERS["capping_iqr"]
    )
    cells = []
    for c in FEATURES:
        if c in OUTLIERS["log_transform"]:
            cells.append(f"ln(1 + abs({c})) AS {c}")
        elif c in OUTLIERS["capping_iqr"]:
            cells.append(f"{sql_clip(c, f'lo_{c}', f'hi_{c}')} AS {c}")
        elif c in OUTLIERS["capping_winsor"]:
            cells.append(f"{sql_clip(c, f'wlo_{c}', f'whi_{c}')} AS {c}")
        else:
            cells.append(c)
    (w,) = OUTLIERS["capping_winsor"]
    winsor = (
        f"winsor AS (SELECT max({w}) FILTER (rn = floor(0.05::double * n)::BIGINT + 1) AS wlo_{w}, max({w}) FILTER (rn = n - floor(0.05::double * n)::BIGINT) AS whi_{w} "
        f"FROM (SELECT {w}, row_number() OVER (ORDER BY {w}) AS rn, count({w}) OVER () AS n FROM {source} WHERE {w} IS NOT NULL))"
    )
    return f"bounds AS (SELECT {bounds}), {winsor}, treated AS (SELECT {', '.join(cells)}, MEDV FROM {source}, bounds, winsor)"


@query("cmp2_outliers", f"WITH {H_CTE}, {outlier_ctes('h')} SELECT " + ", ".join(f"{sql_r(c, 7)} AS {c}" for c in [*FEATURES, "MEDV"]) + " FROM treated")
def outliers(spark, sf_dir):
    """Missing values stay missing through all treatments."""
    h = housing(spark, sf_dir)
    return rounded(OutlierHandler(OUTLIERS, FEATURES).fit(h).transform(h), 7)


@query("prj2_cmp3_column_reduce", f"WITH {H_CTE} SELECT {', '.join(KEPT)}, MEDV FROM h")
def column_reduce(spark, sf_dir):
    h = housing(spark, sf_dir)
    return CorrelationReducer({"remove": ["RAD", "B", "NOT_THERE"]}, FEATURES).fit(h).transform(h)


def _scaled(spark, sf_dir, kind):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE)
    return rounded(FeatureScaler(kind, LINE).fit(line).transform(line))


def _scale_sql(center, scale) -> str:
    cells = ", ".join(f"{sql_r(sql_scale(c, f'm_{c}', f's_{c}'))} AS {c}" for c in LINE)
    fitted = ", ".join(f"{center(c)} AS m_{c}, {scale(c)} AS s_{c}" for c in LINE)
    return f"WITH f AS (SELECT {fitted} FROM lineitem) SELECT l_orderkey, {cells} FROM lineitem, f"


@query("agg8_cmp4_robust_scale", _scale_sql(lambda c: f"quantile_cont({c}, 0.5)", lambda c: f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def robust_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "RobustScaler")


@query("agg9_cmp4_standard_scale", _scale_sql(lambda c: f"avg({c})", lambda c: f"stddev_pop({c})"))
def standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "StandardScaler")


@query("agg10_cmp4_minmax_scale", _scale_sql(lambda c: f"min({c})", lambda c: f"max({c}) - min({c})"))
def minmax_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "MinMaxScaler")


def scaled_ctes(source: str, columns) -> str:
    fitted = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in columns)
    cells = ", ".join(f"{sql_scale(c, f'm_{c}', f's_{c}')} AS {c}" for c in columns)
    return f"fitted AS (SELECT {fitted} FROM {source}), scaled AS (SELECT {cells}, MEDV FROM {source}, fitted)"


PREPARED_CTES = f"{H_CTE}, {IMPUTED_CTE}, {outlier_ctes('imp')}, {scaled_ctes('treated', KEPT)}"


@query("cmp5_preprocess_chain", f"WITH {PREPARED_CTES} SELECT " + ", ".join(f"{sql_r(c, 7)} AS {c}" for c in [*KEPT, "MEDV"]) + " FROM scaled")
def preprocess_chain(spark, sf_dir):
    """Flagship: impute, treat outliers, reduce, scale; each fitted on the output of the one before."""
    h = housing(spark, sf_dir)
    return rounded(DataPreprocessor(PROCESSING, ["MEDV"]).fit_transform(h), 7)


@query(
    "agg26_completeness",
    f"WITH {H_CTE}, {IMPUTED_CTE} SELECT " + " + ".join(f"(count(*) - count({c}))" for c in HOLED) + " AS left_over FROM imp",
)
def completeness(spark, sf_dir):
    h = housing(spark, sf_dir)
    model = MissingValueHandler(NA, FEATURES).fit(h)
    return spark.createDataFrame([(model.remaining_missing(h),)], "left_over bigint")


# --- derived features

INTERACTIONS = [
    {"type": "product", "features": ["RM", "AGE"], "name": "RM_x_AGE"},
    {"type": "ratio", "features": ["LSTAT", "ZN"], "name": "LSTAT_per_ZN"},
    {"type": "diff", "features": ["TAX", "B"], "name": "TAX_less_B"},
    {"type": "sum", "features": ["CRIM", "INDUS"], "name": "CRIM_and_INDUS"},
    {"type": "ratio", "features": ["LSTAT", "NOT_THERE"], "name": "left_out"},
]
INTERACTION_SQL = {
    "RM_x_AGE": "RM * AGE", "LSTAT_per_ZN": "LSTAT / nullif(ZN, 0)", "TAX_less_B": "TAX - B", "CRIM_and_INDUS": "CRIM + INDUS",
}
DOMAIN_SQL = {
    "rooms_per_age": "RM / nullif(AGE + 1, 0)",
    "tax_per_room": "TAX / nullif(RM, 0)",
    "accessibility_score": "RAD / nullif(DIS + 0.1::double, 0)",
    "socioeconomic_index": "LSTAT * PTRATIO",
    "property_quality": "RM * (1 - LSTAT / 100)",
    "crime_per_capita_weighted": "CRIM * INDUS",
    "pollution_residential": "NOX * (1 - INDUS / 100)",
}


def _cells(exprs: dict[str, str], digits: int = 9) -> str:
    return ", ".join(f'{sql_r(e, digits)} AS "{n}"' for n, e in exprs.items())


@query("scl5_interactions", f"WITH {H_CTE} SELECT {_cells(INTERACTION_SQL, 11)} FROM h")
def interactions(spark, sf_dir):
    h = housing(spark, sf_dir)
    return rounded(InteractionFeatureCreator(INTERACTIONS, FEATURES).fit(h).transform(h).select(*INTERACTION_SQL), 11)


@query("scl6_domain_features", f"WITH {H_CTE} SELECT {_cells(DOMAIN_SQL)} FROM h")
def domain_features(spark, sf_dir):
    h = housing(spark, sf_dir)
    return rounded(DomainFeatures(FEATURES).fit(h).transform(h).select(*DOMAIN_SQL), 9)


@query("scl13_domain_gating", f"WITH {H_CTE} SELECT {_cells({k: v for k, v in DOMAIN_SQL.items() if k != 'accessibility_score'})} FROM h")
def domain_gating(spark, sf_dir):
    """Without RAD the feature that needs it does not appear."""
    h = housing(spark, sf_dir).drop("RAD")
    made = DomainFeatures(numeric_columns(h, ["MEDV"])).fit(h)
    return rounded(made.transform(h).select(*[c for c in made.feature_names_out if c not in FEATURES]), 9)


@query(
    "scl7_ieee_division",
    "SELECT l_orderkey, CASE WHEN d = 0 THEN CASE WHEN n > 0 THEN 'inf' WHEN n < 0 THEN '-inf' ELSE 'nan' END ELSE 'finite' END AS kind "
    "FROM (SELECT l_orderkey, l_quantity - 25 AS n, l_discount * 100 - 5 AS d0, CASE WHEN abs(l_discount - 0.05) < 0.001 THEN 0 ELSE 1 END AS d FROM lineitem)",
)
def ieee_division(spark, sf_dir):
    """tax_per_room with array semantics over a denominator that is often zero."""
    line = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_quantity - 25 AS TAX", "CAST(CASE WHEN abs(l_discount - 0.05) < 0.001 THEN 0 ELSE 1 END AS DOUBLE) AS RM"
    )
    out = DomainFeatures(["TAX", "RM"], division="ieee").fit(line).transform(line)
    x = F.col("tax_per_room")
    kind = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").otherwise("finite")
    return out.select("l_orderkey", kind.alias("kind"))


POLY = {
    "RM": "RM", "DIS": "DIS", "NOX": "NOX", "RM^2": "RM * RM", "RM DIS": "RM * DIS", "RM NOX": "RM * NOX",
    "DIS^2": "DIS * DIS", "DIS NOX": "DIS * NOX", "NOX^2": "NOX * NOX",
}


@query("scl14_polynomial", f"WITH {H_CTE} SELECT {sql_r('MEDV', 9)} AS MEDV, {_cells(POLY)} FROM h")
def polynomial(spark, sf_dir):
    h = housing(spark, sf_dir).select("RM", "DIS", "NOX", "MEDV")
    return rounded(PolynomialFeatureCreator(2, features=["RM", "DIS", "NOX"]).fit(h).transform(h), 9)


POLY_INTERACTIONS = {
    "1": "1.0::double", "RM": "RM", "DIS": "DIS", "NOX": "NOX", "RM DIS": "RM * DIS", "RM NOX": "RM * NOX", "DIS NOX": "DIS * NOX", "RM DIS NOX": "RM * DIS * NOX",
}


@query("scl14_polynomial_interactions", f"WITH {H_CTE} SELECT {sql_r('TAX', 9)} AS TAX, {_cells(POLY_INTERACTIONS)} FROM h")
def polynomial_interactions(spark, sf_dir):
    h = housing(spark, sf_dir).select("RM", "TAX", "DIS", "NOX")
    creator = PolynomialFeatureCreator(3, True, True, ["RM", "DIS", "NOX"], ["RM", "TAX", "DIS", "NOX"])
    return rounded(creator.fit(h).transform(h), 9)


_ENGINEERED = {**{c: c for c in FEATURES if c not in ("RM", "LSTAT")}, **INTERACTION_SQL, **DOMAIN_SQL, "RM": "RM", "LSTAT": "LSTAT", "RM^2": "RM * RM", "RM LSTAT": "RM * LSTAT", "LSTAT^2": "LSTAT * LSTAT"}


@query("cmp6_feature_chain", f"WITH {H_CTE} SELECT {_cells({**_ENGINEERED, 'MEDV': 'MEDV'}, 10)} FROM h")
def feature_chain(spark, sf_dir):
    h = housing(spark, sf_dir)
    config = {"interactions": INTERACTIONS, "domain_features": True, "polynomial": {"degree": 2, "features": ["RM", "LSTAT"]}}
    return rounded(FeatureEngineer(config, ["MEDV"]).fit_transform(h), 10)


_SERVED = {**{c: c for c in KEPT}, **{k: v for k, v in DOMAIN_SQL.items() if k != "accessibility_score"}, "MEDV": "MEDV"}


@query("cmp7_serving_chain", f"WITH {PREPARED_CTES} SELECT {_cells(_SERVED, 7)} FROM scaled")
def serving_chain(spark, sf_dir):
    """Preprocessing then engineering, both saved and loaded again before use."""
    h = housing(spark, sf_dir)
    fitted = DataPreprocessor(PROCESSING, ["MEDV"]).fit(h)
    base = scratch_path(spark, "artifacts")
    fitted.save(f"{base}/data_preprocessor")
    loaded = DataPreprocessor.load(f"{base}/data_preprocessor")
    prepared = loaded.transform(h)
    FeatureEngineer({"domain_features": True}, ["MEDV"], loaded.get_feature_names_out()).fit(prepared).save(f"{base}/feature_engineer")
    return rounded(FeatureEngineer.load(f"{base}/feature_engineer").transform(prepared), 7)
