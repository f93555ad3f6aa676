"""Spelling variants against plain Python, on words over a small alphabet, on long runs and on awkward rows."""

import collections
import itertools
import re
import zlib

import numpy as np
from test_operators import SCHEMA, awkward_rows

from numerant.llm import spelling

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, letters=6, least=5, ratio=5, every=199):
    counts = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            word = spelling.slips(run, zlib.crc32(f"{'' if key is None else key}:{run}".encode()), every)
            if len(word) >= letters:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= least}
    near = collections.defaultdict(list)
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b), near[b].append(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def found(spark, path, rows, **options):
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(path)
    got = spelling.variants(spark.read.parquet(path), **options).collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got}
    assert len(out) == len(got)
    return out


def test_variants_are_the_definition(spark, tmp_path):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abÀ"), rng.integers(5, 9))) for _ in range(900)]
    often = [w for w in words for _ in range(int(5 ** rng.uniform(0, 3.2)))]
    rng.shuffle(often)
    rows = [(int(i) % 40, ("-" if i % 3 else "\n1").join(x)) for i, x in enumerate(np.array_split(often, 50))]
    rows += [(70, "cdcdcd " * 5 + "cdcdcde " * 30 + "cdcdcdee " * 160), (None, "ABABAB ababab abAbab " * 3), (None, None), (9, ""), (9, " \t"), (9, "ÿ×÷ñññ" * 2)]
    wanted = brute(rows)
    assert any(v[2] and v[4] != v[2] for v in wanted.values()) and max(v[1] for v in wanted.values()) > 4
    assert found(spark, str(tmp_path / "a"), rows) == wanted
    assert found(spark, str(tmp_path / "b"), rows, every=3, letters=4, least=2, ratio=2) == brute(rows, 4, 2, 2, 3)


def test_repeated_letters_make_one_pair(spark, tmp_path):
    rows = [(1, "aaaaaa " * 60 + "aaaaaaa " * 6 + "aaaaaab " * 7 + "baaaaaa " * 5)]
    assert found(spark, str(tmp_path / "a"), rows) == brute(rows)


def test_long_runs(spark, tmp_path, monkeypatch):
    long = "ab" * 2000
    rows = [(1, " ".join([long] * 30 + [long[1:]] * 5 + [long[:900] + "x" + long[901:]] * 6 + [long + "b"] * 5))]
    assert found(spark, str(tmp_path / "a"), rows) == brute(rows)
    words = [long, long[1:], "abcabcabc", "abcabcabd"]
    monkeypatch.setattr(spelling, "LONG", 3)
    hashed = [list(spelling.rotations(w)) for w in words]
    monkeypatch.undo()
    plain = [list(spelling.rotations(w)) for w in words[2:]]
    same = lambda both: {(i, j) for (i, p), (j, q) in itertools.product(enumerate(both[0]), enumerate(both[1])) if p[0] == q[0]}
    assert same(hashed[2:]) == same(plain)


def test_awkward_rows(spark, tmp_path):
    rows = awkward_rows()
    clash = [(*r, "clash", "clash", "clash") for r in rows]
    spark.createDataFrame(clash, SCHEMA + ", word string, n string, id string").write.parquet(str(tmp_path / "d"))
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == brute([r[:2] for r in rows])
    assert found(spark, str(tmp_path / "e"), []) == {}
