"""Fold models from Gram matrices against refits, and the number of scans they take."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from numerant.operators.metrics import metric_columns
from numerant.plans import gram, training
from numerant.plans.models import LABEL, PREDICTION, REGISTRY, VECTOR, assemble, fit_regressor, label_stats
from numerant.plans.training import FOLD, cross_validate

RIDGE, NET = REGISTRY[("sklearn.linear_model", "Ridge")], REGISTRY[("sklearn.linear_model", "ElasticNet")]


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [2000, -3, 0]  # a large mean beside a small spread
    y = x @ [2.0, -0.5, 0.0] + rng.normal(size=400) * 0.3 + 1e4
    rows = [(*map(float, a), float(b), i % 4) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, f"a double, b double, c double, y double, `{FOLD}` int").repartition(3)
    return assemble(df, ["a", "b", "c"], "y", [FOLD]).cache()


@pytest.mark.parametrize("builder,params", [(RIDGE, {"alpha": 2.0}), (RIDGE, {"alpha": 0.0}), (RIDGE, {"alpha": 5.0, "fit_intercept": False}), (NET, {"alpha": 0.1, "l1_ratio": 0.5}), (NET, {"alpha": 0.5, "l1_ratio": 0.9})])
@pytest.mark.parametrize("scoring", sorted(training.SCORINGS))
def test_folds_are_those_of_refits(folded, builder, params, scoring):
    metric, factor = training.SCORINGS[scoring]
    got = {r.fold: r.score for r in cross_validate(builder, params, folded, 4, scoring).collect()}
    for fold in (0, 3):
        rest = folded.where(F.col(FOLD) != fold)
        model = fit_regressor(builder, params, rest, label_stats(rest))
        row = model.transform(folded.where(F.col(FOLD) == fold)).agg(*metric_columns(LABEL, PREDICTION)).first()
        assert got[fold] == pytest.approx(row[metric] * factor, rel=2e-5)
    assert sorted(got) == [0, 1, 2, 3]


def test_one_scan_for_all_folds_and_penalties(spark, folded):
    seen = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = folded.select("*").mapInArrow(tally, folded.schema)
    grams = gram.fold_grams(counted, VECTOR, LABEL, FOLD)
    scanned = seen.value
    penalties = [gram.Penalty(l2=a) for a in (0.1, 1.0, 10.0)] + [gram.Penalty(0.1, 0.1, True)]
    scores = gram.fold_scores(counted, grams, penalties, "rmse", VECTOR, LABEL, FOLD)
    assert seen.value == scanned <= 2 * 400 and len(scores) == 4 and all(len(s) == 4 for s in scores)
    assert np.allclose(sum(g[0, 0] for g in grams.folds.values()), 400)


def test_coordinate_descent_meets_its_conditions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6))
    x[:, 5] = x[:, 4]  # equal columns
    y = x @ [1, 0, 0, -2, 0.5, 0.5] + rng.normal(size=200)
    z = np.column_stack([np.ones(200), x, y])
    m = gram.solve(z.T @ z, np.zeros(7), gram.Penalty(0.2, 0.1, True))
    slope = x.T @ (y - x @ m.weights - m.intercept) / 200 - 0.1 * m.weights
    on = m.weights != 0
    assert np.allclose(slope[on], 0.2 * np.sign(m.weights[on]), atol=1e-9) and (np.abs(slope[~on]) <= 0.2 + 1e-9).all()


def test_no_rows(folded):
    with pytest.raises(ValueError, match="no rows"):
        gram.fold_grams(folded.where("false"), VECTOR, LABEL, FOLD)
