"""The similarity join against all pairs in plain Python: chains, hot groups, tiny blocks, awkward rows."""

import collections
import itertools
import re

import numpy as np
import pytest
from test_operators import SCHEMA, awkward_rows

from numerant.llm import linking, ngram_join

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(rows, least=(85, 100)):
    """(key, size, component) of each row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and least[1] * len(sets[i] & sets[j]) >= least[0] * len(sets[i] | sets[j]):
            parent[top(i)] = top(j)
    keys = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        keys[top(i)].append(k)
    smallest = lambda ks: min((k for k in ks if k is not None), default=None)
    return sorted(((k, len(s), smallest(keys[top(i)])) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def found(spark, path, rows, **options):
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(path)
    return sorted(((r.key, r["size"], r.component) for r in ngram_join.joined(spark.read.parquet(path), **options).collect()), key=str)


def near_copies(seed, base, copies, changes):
    rng = np.random.default_rng(seed)
    for _ in range(copies):
        w = base.copy()
        for at in rng.integers(0, len(w), changes):
            w[at] = f"x{rng.integers(10**9)}"
        yield " ".join(w)


def rows_of(seed):
    """Texts of near copies around the limit, chains of small changes, and a passage that unlike texts share."""
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    texts = []
    for n, copies, changes in ((120, 40, 2), (150, 25, 3), (60, 20, 1), (200, 20, 4)):
        texts += near_copies(seed + n, word(n), copies, changes)
    chain = word(100)
    for _ in range(12):
        chain = chain.copy()
        chain[int(rng.integers(0, 100))] = word(1)[0]
        texts.append(" ".join(chain))
    passage = word(90)
    texts += [" ".join(passage + word(int(n))) for n in rng.integers(5, 25, 40)]
    texts += [texts[0], texts[0].upper(), texts[5].replace(" ", "\n\t ")]
    order = rng.permutation(len(texts))
    return [(int(i) + 1, texts[j]) for i, j in enumerate(order)]


def test_components_are_those_of_all_pairs(spark, tmp_path):
    rows = rows_of(1)
    wanted = brute(rows)
    assert len({c for _, _, c in wanted}) < len(rows) - 30
    assert found(spark, str(tmp_path / "a"), rows) == wanted


def test_no_link_is_lost_with_tiny_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK", 6)
    monkeypatch.setattr(linking, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)  # one leader a bucket: most links are left to the crossing
    rows = rows_of(2)
    assert found(spark, str(tmp_path / "a"), rows, slots=64) == brute(rows)


def test_same_prefix_and_size_is_one_group(spark, tmp_path):
    """Texts that differ only in frequent shingles: one group of several nodes, whose members are verified one by one."""
    rng = np.random.default_rng(4)
    often = [[f"o{i}_{j}" for j in range(4)] for i in range(12)]
    fill = [(100 + i, " ".join(o)) for i, o in enumerate(often) for _ in range(9)]  # shingles that occur often
    base = [f"r{i}" for i in range(60)]
    rows = [(i, " ".join(base + sum((often[j] for j in sorted(rng.choice(12, 3, replace=False))), []))) for i in range(30)]
    rows = [(i, k[1]) for i, k in enumerate(rows + fill)]
    assert found(spark, str(tmp_path / "a"), rows) == brute(rows)


def test_awkward_rows(spark, tmp_path):
    rows = [(*r, "x", "x", "x") for r in awkward_rows()]
    spark.createDataFrame(rows, SCHEMA + ", size string, bits string, component string").write.parquet(str(tmp_path / "d"))
    got = ngram_join.joined(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert sorted(((r.key, r["size"], r.component) for r in got), key=str) == brute([r[:2] for r in rows])
    assert found(spark, str(tmp_path / "e"), []) == []
    blank = [(1, None), (2, ""), (3, " \n")]
    assert found(spark, str(tmp_path / "f"), blank) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_words_do_not_depend_on_pieces(monkeypatch, piece):
    import pyarrow as pa

    texts = ["", "Abc  déf\n", "one", " ", "abc " + "long" * 50 + " x", "a b c", ""]
    whole = ngram_join.words(pa.array(texts))
    monkeypatch.setattr(ngram_join, "PIECE", piece)
    parts = ngram_join.words(pa.array(["skipped", *texts]).slice(1))
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]
    assert [len(x) for x in whole] == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    assert whole[1][0] == whole[4][0] != whole[5][0]


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for n, m, both in rng.integers(0, 400, (50, 3)):
        x = rng.integers(0, 2**63, n + m + both).astype(np.uint64)
        a, b = x[: n + both], np.r_[x[n : n + both], x[n + both :]]
        pa_, pb = (np.frombuffer(linking.parity(s), np.uint64) for s in (a, b))
        assert linking.differing(pa_[None], pb[None])[0] <= n + m
