import math

import numpy as np
import pytest
from conftest import values

from numerant.functions.columns import safe_div
from numerant.operators import stats
from numerant.plans.base import column_changes
from numerant.plans.features import DomainFeatures, FeatureEngineer, InteractionFeatureCreator, PolynomialFeatureCreator
from numerant.plans.preprocessing import (
    CorrelationReducer,
    DataPreprocessor,
    FeatureScaler,
    MissingValueHandler,
    OutlierHandler,
)


@pytest.fixture
def sample(frame):
    return frame({"A": [1, 2, None, 4, 5, 100], "B": [10, None, 30, 40, 50, 60], "C": [1] * 6, "D": [5, 6, 7, 8, 9, 10]})


def fit_transform(stage, df):
    return stage.fit(df).transform(df)


def test_impute_mean_median_mode(sample, frame):
    out = fit_transform(MissingValueHandler({"median": ["A"], "mean": ["B"]}), sample)
    assert values(out, "A")[2] == 4.0 and values(out, "B")[1] == 38.0
    ties = frame({"x": [2, 1, 1, 2, 3, None]})
    assert values(fit_transform(MissingValueHandler({"most_frequent": ["x"]}), ties), "x")[-1] == 1.0


def test_no_action_keeps_missing(sample):
    out = fit_transform(MissingValueHandler({"no_action": ["A", "B"]}), sample)
    assert values(out, "A").count(None) == 1 and values(out, "B").count(None) == 1


def test_nan_counts_as_missing(frame):
    df = frame({"x": [1, float("nan"), 3]})
    assert values(fit_transform(MissingValueHandler({"mean": ["x"]}), df), "x") == [1, 2, 3]


def test_all_missing_is_an_error(frame):
    for strategy in ("mean", "median", "most_frequent"):
        with pytest.raises(ValueError, match="'x'"):
            MissingValueHandler({strategy: ["x"]}).fit(frame({"x": [None, None]}))


def test_unknown_columns_are_passed_over(sample):
    model = MissingValueHandler({"mean": ["A", "Z"], "median": ["Y"]}).fit(sample)
    assert model.get("state") == {"A": pytest.approx(22.4)}
    assert model.feature_names_out == ["A", "B", "C", "D"]


def test_remaining_missing(sample):
    assert MissingValueHandler({"mean": ["A"]}).fit(sample).remaining_missing(sample) == 1
    assert MissingValueHandler({"mean": ["A"], "no_action": ["B"]}).fit(sample).remaining_missing(sample) == 0


def test_iqr_bounds_and_clip(frame):
    df = frame({"A": [1, 2, 3, 100, 5, None]})
    model = OutlierHandler({"capping_iqr": ["A"]}).fit(df)
    b = model.get("state")["iqr"]["A"]
    assert (b["q1"], b["q3"], b["lower"], b["upper"]) == (2.0, 5.0, -2.5, 9.5)
    assert values(model.transform(df), "A") == [1, 2, 3, 9.5, 5, None]


def test_log_then_bounds_of_the_values_before(frame):
    df = frame({"A": [-3, 0, 1, 2, 3, 1000]})
    out = values(fit_transform(OutlierHandler({"log_transform": ["A"], "capping_iqr": ["A"]}), df), "A")
    assert out == pytest.approx([math.log1p(3), 0, math.log1p(1), math.log1p(2), math.log1p(3), 6.5])


def winsor(data, low=0.05, high=0.05):
    s = sorted(v for v in data if v is not None)
    lo, hi = s[int(low * len(s))], s[len(s) - int(high * len(s)) - 1]
    return [None if v is None else min(max(v, lo), hi) for v in data]


def test_winsor_per_batch_and_fitted(frame):
    data = [float(i * i % 37) for i in range(41)] + [None]
    train, other = frame({"x": data}), frame({"x": [1000.0]})
    batch = OutlierHandler({"capping_winsor": ["x"]}).fit(train)
    assert values(batch.transform(train), "x") == winsor(data)
    assert values(batch.transform(other), "x") == [1000.0]
    fitted = OutlierHandler({"capping_winsor": ["x"]}, winsor_mode="fitted").fit(train)
    assert values(fitted.transform(train), "x") == winsor(data)
    assert values(fitted.transform(other), "x") == [max(v for v in winsor(data) if v is not None)]
    wide = OutlierHandler({"capping_winsor": ["x"]}, winsor_limits=(0.2, 0.1)).fit(train)
    assert values(wide.transform(train), "x") == winsor(data, 0.2, 0.1)


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_bounds_and_winsor_on_one_column(frame, method):
    data = [float(i) for i in range(40)] + [500.0, -500.0]
    df = frame({"A": data, "W": data})
    config = {"capping_iqr": ["A"], "capping_winsor": ["A", "W"], "log_transform": ["W"]}
    model = OutlierHandler(config, method=method).fit(df)
    b = model.get("state")["iqr"]["A"]
    if method == "exact":
        q1, q3 = np.quantile(data, [0.25, 0.75])
        assert (b["lower"], b["upper"]) == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    wanted = winsor([min(max(v, b["lower"]), b["upper"]) for v in data])
    for out in (model.transform(df), model.transform_training(df)):
        assert values(out, "A") == pytest.approx(wanted)
        assert values(out, "W") == pytest.approx(winsor([math.log1p(abs(v)) for v in data]))


def test_column_changes():
    assert column_changes(["a", "b", "c"], ["c", "d", "a"]) == (["b"], ["d"])


def test_outlier_remove_changes_nothing(sample):
    assert fit_transform(OutlierHandler({"remove": ["A"], "no_action": ["B"]}), sample).collect() == sample.collect()


def test_reducer(sample):
    model = CorrelationReducer({"remove": ["C", "Z"]}).fit(sample)
    assert model.transform(sample).columns == ["A", "B", "D"] == model.get_feature_names_out()
    assert model.get_feature_names_out(["C", "X"]) == ["X"]
    assert {r.col_a for r in CorrelationReducer({"remove": ["A"]}).report(sample).collect()} == {"A"}


def test_scalers(frame):
    df = frame({"A": [1, 2, 3, 100], "C": [7, 7, 7, 7]})
    a = np.array([1, 2, 3, 100.0])
    q1, q2, q3 = np.quantile(a, [0.25, 0.5, 0.75])
    wanted = {"RobustScaler": (a - q2) / (q3 - q1), "StandardScaler": (a - a.mean()) / a.std(), "MinMaxScaler": (a - 1) / 99}
    for kind, scaled in wanted.items():
        out = fit_transform(FeatureScaler(kind), df)
        assert np.allclose(values(out, "A"), scaled) and values(out, "C") == [0.0] * 4
    with pytest.raises(ValueError):
        FeatureScaler("OtherScaler").fit(df)


CONFIG = {
    "handling_na": {"median": ["A"], "mean": ["B"]},
    "handling_outliers": {"log_transform": ["B"], "capping_iqr": ["A"], "capping_winsor": ["D"]},
    "handling_correlated_features": {"remove": ["C"]},
    "scaler": "RobustScaler",
}


def test_chain_saves_and_loads(spark, sample, tmp_path):
    df = sample.selectExpr("*", "A * 2 AS target", "'k' AS key")
    chain = DataPreprocessor(CONFIG, ["target"]).fit(df)
    out = chain.transform(df)
    assert out.columns == ["A", "B", "D", "target", "key"] and chain.get_feature_names_out() == ["A", "B", "D"]
    assert stats.total_missing(out, ["target"]) == 0
    chain.save(str(tmp_path / "chain"))
    again = DataPreprocessor.load(str(tmp_path / "chain"))
    assert again.transform(df).collect() == out.collect() and again.get_feature_names_out() == ["A", "B", "D"]
    assert sorted(chain.transform(df.repartition(5)).collect()) == sorted(out.collect())


def test_stage_exists_only_with_its_key(sample):
    chain = DataPreprocessor({"scaler": "MinMaxScaler"}).fit(sample)
    assert len(chain.model_.stages) == 1
    with pytest.raises(ValueError):
        DataPreprocessor({}).transform(sample)


def test_dropped_columns_are_not_fitted(sample):
    config = {**CONFIG, "handling_correlated_features": {"remove": ["A"]}}
    assert "A" not in DataPreprocessor(config).fit(sample).model_.stages[0].get("state")


def test_interactions(frame):
    df = frame({"A": [2, 4, 6], "B": [3, 5, 0]})
    specs = [
        {"type": t, "features": ["A", "B"], "name": t} for t in ("product", "ratio", "diff", "sum", "power")
    ] + [{"type": "sum", "features": ["A", "Z"], "name": "none"}]
    stage = InteractionFeatureCreator(specs)
    out = fit_transform(stage, df)
    assert out.columns == ["A", "B", "product", "ratio", "diff", "sum"] == stage.fit(df).feature_names_out
    assert values(out, "product") == [6, 20, 0] and values(out, "ratio") == [2 / 3, 4 / 5, None]
    assert values(out, "diff") == [-1, -1, 6] and values(out, "sum") == [5, 9, 6]


def test_domain_features(frame):
    row = {"RM": [6], "AGE": [50], "TAX": [300], "LSTAT": [10], "PTRATIO": [15], "CRIM": [0.5], "INDUS": [5], "NOX": [0.5], "DIS": [3.9], "RAD": [8]}
    got = fit_transform(DomainFeatures(), frame(row)).first()
    wanted = {
        "rooms_per_age": 6 / 51, "tax_per_room": 50, "accessibility_score": 2, "socioeconomic_index": 150,
        "property_quality": 5.4, "crime_per_capita_weighted": 2.5, "pollution_residential": 0.475,
    }
    assert {k: got[k] for k in wanted} == pytest.approx(wanted)
    del row["RAD"]
    assert "accessibility_score" not in fit_transform(DomainFeatures(), frame(row)).columns
    renamed = frame({"rooms": [6], "tax": [300]})
    made = fit_transform(DomainFeatures(mapping={"RM": "rooms", "TAX": "tax"}), renamed)
    assert made.columns == ["rooms", "tax", "tax_per_room"] and made.first().tax_per_room == 50


def test_division_modes(frame):
    from pyspark.sql import functions as F

    df = frame({"a": [1, -1, 0, 4, None], "b": [0, 0, 0, 2, 0]})
    null = values(df.select(safe_div(F.col("a"), F.col("b")).alias("q")), "q")
    assert null == [None, None, None, 2, None]
    assert values(df.select(safe_div(F.col("a"), F.col("b"), "zero").alias("q")), "q") == [0, 0, 0, 2, None]
    ieee = values(df.select(safe_div(F.col("a"), F.col("b"), "ieee").alias("q")), "q")
    assert ieee[:2] == [math.inf, -math.inf] and math.isnan(ieee[2]) and ieee[3:] == [2, None]


def test_polynomial(frame):
    df = frame({"A": [1, 2, 3], "B": [2, 3, 4]})
    out = fit_transform(PolynomialFeatureCreator(2), df)
    assert out.columns == ["A", "B", "A^2", "A B", "B^2"] and [list(r) for r in out.collect()][1] == [2, 3, 4, 6, 9]
    assert fit_transform(PolynomialFeatureCreator(3), df).columns[-4:] == ["A^3", "A^2 B", "A B^2", "B^3"]
    assert fit_transform(PolynomialFeatureCreator(2, True, True), df).columns == ["1", "A", "B", "A B"]
    three = frame({"A": [1], "B": [2], "C": [3]})
    assert fit_transform(PolynomialFeatureCreator(2, features_to_transform=["A", "C"]), three).columns == ["B", "A", "C", "A^2", "A C", "C^2"]
    assert fit_transform(PolynomialFeatureCreator(2, features_to_transform=["Z"]), three).columns == ["A", "B", "C"]


def test_engineer_chain(frame, tmp_path):
    df = frame({"RM": [6, 7], "LSTAT": [10, 20], "target": [1, 2]})
    config = {"interactions": [{"type": "sum", "features": ["RM", "LSTAT"], "name": "s"}], "polynomial": {"degree": 2, "features": ["RM"]}}
    chain = FeatureEngineer(config, ["target"]).fit(df)
    out = chain.transform(df)
    assert out.columns == ["LSTAT", "s", "property_quality", "RM", "RM^2", "target"]
    chain.save(str(tmp_path / "engineer"))
    again = FeatureEngineer.load(str(tmp_path / "engineer"))
    assert again.transform(df).collect() == out.collect()
    off = FeatureEngineer({"domain_features": False}, ["target"]).fit(df)
    assert off.transform(df).columns == ["RM", "LSTAT", "target"] and off.get_feature_names_out() == ["RM", "LSTAT"]
    assert chain.fit(df).get_feature_names_out() == out.columns[:-1]


def test_per_batch_winsor_is_refused_on_streams(spark, sample, tmp_path):
    sample.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(sample.schema).parquet(str(tmp_path / "in"))
    model = OutlierHandler({"capping_winsor": ["D"]}).fit(sample)
    with pytest.raises(ValueError, match="fitted"):
        model.transform(stream)
