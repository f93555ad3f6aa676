"""Boosted trees against plain Python: growth by level, by leaf and symmetric, penalties, folds side by side, saving."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from numerant.plans import boosting
from numerant.plans.boosting import Boosting, HistogramBoosting
from numerant.plans.models import LABEL, PREDICTION, REGISTRY, VECTOR, as_pipeline, assemble, feature_importance, fit_regressor, predict
from numerant.plans.training import FOLD, cross_validate

NAMES = ["a", "b", "c"]


def data():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 9, 300), rng.integers(0, 5, 300), rng.normal(size=300).round(1)]).astype(float)
    y = np.where(x[:, 0] > 4, 3.0, 0) * x[:, 1] + x[:, 2] + rng.normal(size=300) * 0.2
    return x, y, np.arange(300) % 3


@pytest.fixture(scope="module")
def rows(spark):
    x, y, fold = data()
    df = spark.createDataFrame([(*map(float, a), float(b), int(f)) for a, b, f in zip(x, y, fold)], f"a double, b double, c double, y double, `{FOLD}` int")
    return df.repartition(4).cache()


def plain(x, y, spec, at):
    """Predictions at ``at`` by the definition, one node at a time."""
    soft = lambda g: np.sign(g) * max(abs(g) - spec.alpha, 0)
    score = lambda g: soft(g.sum()) ** 2 / (len(g) + spec.lambda_) if len(g) + spec.lambda_ > 0 else 0.0
    guess, out = np.full(len(y), y.mean()), np.full(len(at), y.mean())

    def gains(g, some):
        found = {}
        for f in range(x.shape[1]):
            for v in np.unique(x[:, f])[:-1]:
                left = some[x[some, f] <= v]
                if min(len(left), len(some) - len(left)) >= max(1, spec.least_rows):
                    found[f, v] = score(g[left]) + score(g[some[x[some, f] > v]]) - score(g[some])
        return {k: v for k, v in found.items() if v > 1e-9}

    for _ in range(spec.rounds):
        g = guess - y
        leaves = [(np.arange(len(y)), np.arange(len(at)), 0)]
        final = []
        cut = lambda leaf, f, v: [(leaf[0][m(x[leaf[0], f])], leaf[1][m(at[leaf[1], f])], leaf[2] + 1) for m in (lambda z: z <= v, lambda z: z > v)]
        top = lambda found: min(found, key=lambda k: (-round(found[k], 9), k)) if found else None
        if spec.growth == "symmetric":
            while leaves[0][2] < spec.depth:
                total = {}
                for leaf in leaves:
                    for k, v in gains(g, leaf[0]).items():
                        total[k] = total.get(k, 0) + v
                if not total:
                    break
                leaves = [x_ for leaf in leaves for x_ in cut(leaf, *top(total))]
            final = leaves
        elif spec.growth == "by_level":
            while leaves:
                leaf = leaves.pop()
                best = top(gains(g, leaf[0])) if leaf[2] < spec.depth else None
                if best:
                    leaves += cut(leaf, *best)
                else:
                    final.append(leaf)
        else:
            final = leaves
            while len(final) < spec.leaves:
                found = [(max(gs.values()), i, top(gs)) for i, leaf in enumerate(final) if leaf[2] < spec.depth and (gs := gains(g, leaf[0]))]
                if not found:
                    break
                _, i, best = max(found, key=lambda k: k[0])
                final += cut(final.pop(i), *best)
        for some, there, _ in final:
            w = -soft(g[some].sum()) / (len(some) + spec.lambda_) * spec.step
            guess[some] += w
            out[there] += w
    return out


@pytest.mark.parametrize("spec", [
    Boosting("by_level", 3, 0.5, 3, lambda_=1.0), Boosting("by_level", 2, 0.5, 2, alpha=20.0, lambda_=5.0, least_rows=10), Boosting("by_leaf", 3, 0.3, 64, 7, lambda_=0.0, least_rows=20),
    Boosting("by_leaf", 2, 0.3, 3, 12, lambda_=2.0), Boosting("symmetric", 3, 0.3, 3, lambda_=3.0),
])
def test_trees_are_the_definition(rows, spec):
    x, y, _ = data()
    model = HistogramBoosting(spec, VECTOR, LABEL, PREDICTION).fit(assemble(rows, NAMES, "y"))
    got = predict(as_pipeline(model, NAMES), rows).select(*NAMES, PREDICTION).collect()
    wanted = plain(x, y, spec, np.array([[r.a, r.b, r.c] for r in got]))
    assert np.allclose([r.prediction for r in got], wanted, atol=1e-8)


def test_predictions_in_blocks_do_not_change_trees(rows, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 11)
    x, y, _ = data()
    spec = Boosting("by_level", 5, 0.5, 2, lambda_=1.0)
    model = HistogramBoosting(spec, VECTOR, LABEL, PREDICTION).fit(assemble(rows, NAMES, "y"))
    got = predict(as_pipeline(model, NAMES), rows).select(*NAMES, PREDICTION).collect()
    assert np.allclose([r.prediction for r in got], plain(x, y, spec, np.array([[r.a, r.b, r.c] for r in got])), atol=1e-8)


def test_slots_differ_and_save(spark, rows, tmp_path):
    guesses = []
    for module, name in (("xgboost", "XGBRegressor"), ("lightgbm", "LGBMRegressor"), ("catboost", "CatBoostRegressor")):
        params = {"iterations" if module == "catboost" else "n_estimators": 2, "subsample": 0.8, "random_state": 1}
        model = as_pipeline(fit_regressor(REGISTRY[(module, name)], params, assemble(rows, NAMES, "y")), NAMES)
        model.write().overwrite().save(str(tmp_path / module))
        again = predict(PipelineModel.load(str(tmp_path / module)), rows).orderBy(*NAMES, "y").collect()
        guesses.append([r.prediction for r in predict(model, rows).orderBy(*NAMES, "y").collect()])
        assert [r.prediction for r in again] == guesses[-1]
        found = feature_importance(model, spark).collect()
        assert sum(r.importance for r in found) == pytest.approx(1.0)
    assert not np.allclose(guesses[0], guesses[1]) and not np.allclose(guesses[1], guesses[2])


def test_folds_side_by_side_are_single_fits(rows):
    x, y, fold = data()
    folded = assemble(rows, NAMES, "y", [FOLD])
    params = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.5, "reg_lambda": 2.0}
    got = {r.fold: r.score for r in cross_validate(REGISTRY[("xgboost", "XGBRegressor")], params, folded, 3).collect()}
    for f in range(3):
        wanted = plain(x[fold != f], y[fold != f], Boosting("by_level", 3, 0.5, 2, lambda_=2.0), x[fold == f])
        assert got[f] == pytest.approx(np.sqrt(np.mean((y[fold == f] - wanted) ** 2)), rel=1e-6)


def test_bins(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(5000)], "u double, v double")
    edges = boosting.bin_edges(assemble(df.withColumn("y", F.lit(1.0)), ["u", "v"], "y"), VECTOR, 64)
    assert 55 <= len(edges[0]) <= 63 and edges[1].tolist() == [0.0, 1.0]


def test_passes_use_many_tasks_and_sums_meet_in_either_place(spark, monkeypatch):
    """400,000 cells are more than one task's; sums by task give the same trees in the driver as over the tasks."""
    rows = spark.range(0, 200_000, 1, 4).select((F.col("id") % 101).cast("double").alias("u"), (F.col("id") % 7).cast("double").alias("v"))
    rows = assemble(rows.withColumn("y", F.col("u") * F.col("u") - F.col("v") * 3), ["u", "v"], "y")
    seen, one_pass = [], boosting._pass
    monkeypatch.setattr(boosting, "_pass", lambda blocks, *a: seen.append((blocks.rdd.getNumPartitions(), a[-1])) or one_pass(blocks, *a))
    trees = []
    for limit in (boosting.DRIVER_BYTES, 0):
        monkeypatch.setattr(boosting, "DRIVER_BYTES", limit)
        trees.append(HistogramBoosting(Boosting("by_level", 2, 0.5, 3), VECTOR, LABEL, PREDICTION).fit(rows).trees)
    half = len(seen) // 2
    assert {n for n, _ in seen} == {2} and [few for _, few in seen] == [True] * half + [False] * half
    for one, other in zip(*trees):
        assert one["feature"] == other["feature"] and one["cut"] == other["cut"] and np.allclose(one["value"], other["value"])
