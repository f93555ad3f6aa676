"""Hard negatives against plain Python: ties, repeated rows, short and awkward vectors, several blocks, huge components."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from numerant.llm import hard_negatives
from numerant.llm.common import written

SCHEMA = "vec_id bigint, embedding array<float>, label int, slot string, row string, score string"


def brute(rows, k=5, clip=False):
    """(anchor, positive, rank, negative, scores) by the definition, from rows (id, vector, label)."""
    some = []
    for at, (i, v, label) in enumerate(rows):
        if i is not None and i % 7 == 0 and label is not None:
            label = (label + 1) % 10
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        some.append((at, i, [int(np.floor(np.float64(256) * np.float64(np.float32(x)))) for x in v], label))
    out = []
    for a in some:
        if a[1] is None or a[1] % 100:
            continue
        near = []
        for b in some:
            if b[0] != a[0]:
                s = sum(x * y for x, y in zip(a[2], b[2]))
                near.append((-max(-(2**63), min(2**63 - 1, s)) if clip else -s, math.inf if b[1] is None else b[1], b[0], b[3]))
        near.sort()
        for p in [x for x in near if x[3] == a[3]][:k]:
            inside = [x for x in near if x[3] != a[3] and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]][:k]
            out += [(a[1], p[1], r + 1, x[1], -p[0], -x[0]) for r, x in enumerate(inside)]
    return sorted(out, key=str)


def found(spark, path, rows, **options):
    spark.createDataFrame([(i, v, x, "clash", "clash", "clash") for i, v, x in rows], SCHEMA).repartition(3).write.parquet(path)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    each = written(hard_negatives.quantised(spark.read.parquet(path), label), "test")
    anchors = written(each.where(F.col("key") % 100 == 0), "test")
    got = hard_negatives.selected(each, anchors, **options).collect()
    no_id = lambda i: math.inf if i is None else i
    return sorted(((r.anchor, no_id(r.positive), r.rank, no_id(r.negative), r.positive_score, r.negative_score) for r in got), key=str)


def test_selection_is_the_definition(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 6, (400, 6)) / 8.0  # many equal scores
    rows = [(int(i), vectors[i].tolist(), int(rng.integers(0, 3))) for i in range(400)]
    rows += [(500, vectors[0].tolist(), None), (501, None, 1), (502, [None, 1.0], 1), (503, [float("nan")] * 6, 1), (504, [float("inf")] * 6, 1), (600, [], 1), (601, [0.5, 0.5], 2)]
    rows += [(None, vectors[3].tolist(), 1), (None, vectors[3].tolist(), 2)]
    wanted = brute(rows)
    assert len(wanted) > 30
    assert found(spark, str(tmp_path / "a"), rows) == wanted
    assert found(spark, str(tmp_path / "b"), rows, block_bytes=120) == wanted  # an anchor or two a block
    assert found(spark, str(tmp_path / "c"), rows, k=2, k_positives=2) == brute(rows, 2)


def test_repeated_rows_and_negative_scores(spark, tmp_path):
    same = [(100, [1.0, 0.0], 1)] * 3 + [(100, [1.0, 0.0], 2)] * 3 + [(3, [-1.0, 0.5], 1), (4, [-1.0, 0.5], 2), (5, [0.0, 1.0], 2), (6, [0.0, 1.0], 1)]
    assert found(spark, str(tmp_path / "a"), same) == brute(same)


@pytest.mark.parametrize("scale", [1e6, 1e12, 1e30])
def test_large_components_stay_exact(spark, tmp_path, scale):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.random(4).astype(np.float32) * np.float32(scale)).tolist(), i % 2) for i in range(95, 130)]
    assert found(spark, str(tmp_path / "a"), rows) == brute(rows, clip=True)


def test_no_rows_and_no_anchors(spark, tmp_path):
    assert found(spark, str(tmp_path / "a"), []) == []
    assert found(spark, str(tmp_path / "b"), [(1, [1.0], 1), (2, [1.0], 2)]) == []
