"""The operators against brute force, and on awkward tables: nulls, empty and long texts, ties, repeated rows, no rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import json
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from numerant.llm import context_tree, exact_dedup, line_dedup, linking, mixing, near_dedup, pieces, quality_classifier, quality_rules, secret_scan, sharding

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, bucket string, row string"
WORDS = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were all".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + ("" if rng.random() < 0.6 else WORDS[j]) for i, j in rng.integers(0, len(WORDS), (n, 2)))


def awkward_rows():
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 120), "en", "a"), (2, prose(2, 120), "en", "a"), (3, prose(2, 120).upper(), "en", None), (4, None, None, None), (5, "", "en", "a"),
        (6, " \t\n", "en", "b"), (7, long, "en", "b"), (8, long + " more", "en", "b"), (9, "漢字 ñ é \U0001f600\n\nx", "zh", "c"), (10, "a" * 5000, None, "c"),
        (11, prose(3, 80), "en", "a"), (11, prose(3, 80), "en", "a"), (None, prose(4, 60), "en", "a"), (None, None, None, None), (12, "one two", "en", ""),
        (13, "key token = \"" + hashlib.sha1(b"x").hexdigest() + "\" end", "en", "a"), (14, "\n".join([prose(5, 9)] * 4), "en", "c"),
    ]
    return [(k, t, l, s, None, "clash", "clash") for k, t, l, s in rows]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(spark.createDataFrame([], SCHEMA).schema).parquet(path)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


# --- 1: context trees

def brute_context_tree(train: list[list[bytes]], texts: list[list[bytes]], depth: int) -> list[float]:
    """Scores by the definition: weighted probabilities by recursion over all contexts, in plain Python."""
    code = lambda words: b"\n" * depth + b" ".join(words) + b"\n"
    counts = collections.defaultdict(lambda: [0, 0])
    children = collections.defaultdict(set)
    steps = lambda b: [((1 << k) | b >> (8 - k), b >> (7 - k) & 1) for k in range(8)]
    for words in train:
        raw = code(words)
        for i in range(depth, len(raw)):
            for node, bit in steps(raw[i]):
                for d in range(depth + 1):
                    counts[raw[i - d : i], node][bit] += 1
                    if d < depth:
                        children[raw[i - d : i], node].add(raw[i - d - 1 : i])
    own = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    memo: dict = {}

    def weighted(s, node):
        if (s, node) not in memo:
            e = own(*counts.get((s, node), (0, 0)))
            memo[s, node] = e if len(s) == depth else np.logaddexp(e, sum(weighted(c, node) for c in children.get((s, node), ()))) - math.log(2)
        return memo[s, node]

    def one(context, node):
        p = None
        for d in range(depth, -1, -1):
            s = context[depth - d :]
            a, b = counts.get((s, node), (0, 0))
            kt = (b + 0.5) / (a + b + 1)
            w = 1.0 if d == depth else math.exp(own(a, b) - math.log(2) - weighted(s, node))
            p = kt if p is None else w * kt + (1 - w) * p
        return p

    out = []
    for words in texts:
        raw, total = code(words), 0.0
        for i in range(depth, len(raw)):
            for node, bit in steps(raw[i]):
                p = one(raw[i - depth : i], node)
                total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def test_context_tree_is_the_definition(spark, tmp_path):
    rows = [(i, prose(i, 25)) for i in range(12)] + [(20, None), (21, "Ünï  \tTHE\n"), (22, prose(3, 25))]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    held = F.col("doc_id") % 3 == 1
    got = {r.doc_id: r for r in context_tree.context_tree_scores(docs, held, depth=3).collect()}
    token = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    train = [token(t) for i, t in rows if i % 3 != 1]
    wanted = brute_context_tree(train, [token(t) for _, t in rows], 3)
    counts = collections.Counter(w for t in train for w in t)
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    for (i, t), score in zip(rows, wanted):
        assert got[i].score == pytest.approx(score, rel=1e-6)
        assert got[i].base_score == pytest.approx(sum(base(counts[w]) for w in token(t)) + base(len(train)))
        assert (got[i].n_tokens, got[i].n_known) == (len(token(t)) + 1, sum(counts[w] > 0 for w in token(t)) + 1) and got[i].train_tokens == n


def test_context_tree_on_awkward_rows(spark, awkward, empty):
    held = context_tree.fold(F.col("doc_id")) == 1
    found = context_tree.context_tree_scores(awkward, held).collect()
    assert len(found) == 17 and all(r.score < 0 and r.n_tokens >= 1 for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (4, 5, 6)} == {1}
    assert context_tree.context_tree_scores(empty, held).collect() == []
    alone = context_tree.context_tree_scores(awkward.where("doc_id = 12"), F.lit(True)).first()
    assert alone.train_tokens == 0 and alone.score == pytest.approx(8 * len("one two\n") * math.log10(0.5)) and alone.base_score == 0.0


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.9, 8, 100.5, 1e6])
    assert np.allclose(context_tree.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12)


# --- 2: secrets

def test_findings(awkward, empty):
    found = secret_scan.findings(awkward).collect()
    sha = hashlib.sha1(b"x").hexdigest()
    mine = [r for r in found if r.doc_id == 13]
    assert [(r.finding, r.inside, r.before, r.before2, r.after) for r in mine] == [(sha, '"', "=", "token", "end")]
    assert [len(r.finding) for r in found if r.doc_id == 10] == [5000]
    assert secret_scan.findings(empty).collect() == []


@pytest.mark.parametrize("text, expected", [
    ("password=hunter2xyz p@ss.w0rd", ["hunter2xyz"]),
    ("my password: p@ss.w0rd, then", ["p@ss.w0rd"]),
    ("password hunter2xyz. The capital: Paris2", ["hunter2xyz", "Paris2"]),
    ('{"api_key":"a!b#c$d%e", "n": 1}', ["a!b#c$d%e"]),
    ("db_password := 's3cr3t~x' x=1", ["s3cr3t~x"]),
    ("token==abcdefgh pwd=short password=", []),
    ("id 123e4567-e89b-12d3-a456-426614174000 ok", ["123e4567-e89b-12d3-a456-426614174000"]),
    ("auth=" + "A1" * 20 + "/" + "B2" * 20, ["A1" * 20 + "/" + "B2" * 20]),
    ("", []), (None, []),
])
def test_findings_behind_names(spark, text, expected):
    docs = spark.createDataFrame([(1, text, None)], "doc_id bigint, text string, source string")
    assert [r.finding for r in secret_scan.findings(docs).orderBy("at", "part").collect()] == expected


def test_equal_runs_of_a_word_have_their_own_places(spark):
    run = "abcdefgh12345678"
    docs = spark.createDataFrame([(1, f"x.{run};key:{run} y", "s")], "doc_id bigint, text string, source string")
    assert [(r.part, r.finding, r.inside) for r in secret_scan.findings(docs).orderBy("part").collect()] == [(0, run, "x."), (1, run, f"x.{run};key:")]


def brute_features(finding, inside, before, before2, words, logs):
    """The features of one finding that need no labels, from their definitions."""
    codes = [secret_scan.ALPHABET.find(c) + 1 for c in finding.lower()]
    pairs = [a * secret_scan.KINDS + b for a, b in zip(codes, codes[1:])]
    lit = [False] * len(finding)
    for i in range(len(finding)):
        for n in range(4, 21):
            if finding.lower()[i : i + n] in words and i + n <= len(finding):
                lit[i : i + n] = [True] * n
    n, lead = len(finding), " ".join([before2 or "", before or "", inside])
    kinds = sum(
        bool(re.match("[0-9][A-Za-z]|[A-Za-z][0-9]|[a-z][A-Z]", finding[i : i + 2])) for i in range(n - 1)
    )
    return {
        "length": float(n), "transitions": sum(logs[p] for p in pairs) / max(n - 1, 1), "covered": sum(lit) / n,
        "digits": sum(c in "0123456789" for c in finding) / n, "capitals": sum("A" <= c <= "Z" for c in finding) / n, "switches": kinds / n,
        "quoted": float(inside[-1:] in ("\"", "'", "`") and inside != ""), "assigned": float(bool(re.search("[=:][ \"'`]*$", lead))),
        "named": float(bool(re.search(secret_scan.NAMES, lead))),
    }


def planted_findings(count: int):
    """Texts with one secret or one look-alike each, and which it is."""
    rng = np.random.default_rng(3)
    pick = lambda letters, n: "".join(letters[i] for i in rng.integers(0, len(letters), n))
    low, every = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    word = lambda: pick(WORDS, 1) + pick(WORDS, 1)
    uuid = lambda: "-".join(rng.bytes(k).hex() for k in (4, 2, 2, 2, 6))
    kinds = [
        (1, lambda: f'token = "{rng.bytes(20).hex()}"'), (0, lambda: f"commit {rng.bytes(20).hex()}"),
        (1, lambda: "the key AKIA" + pick("ABCDEFGHJKLMNP234567", 16)), (0, lambda: f"request {uuid()}"),
        (1, lambda: f"password={pick(low, 5)}{rng.integers(10, 99)}!{pick(every, 3)}"), (0, lambda: f"sha256: {rng.bytes(32).hex()}"),
        (1, lambda: f"api_key: {pick(every, 32)}"), (0, lambda: "see /" + "/".join([word(), word(), f"{word()}-{rng.integers(1, 99)}"])),
        (1, lambda: f"pwd={pick(low, 4)}{rng.integers(100, 999)}.{pick(every, 4)}"), (0, lambda: f"img base64,{pick(every + '+/', 60)}"),
        (0, lambda: "".join(word() for _ in range(4)) + pick(WORDS, 4)), (0, lambda: f"number {pick('0123456789', 16)}"),
        (0, lambda: f"the secret {word()}{word()}"),
    ]
    for i in range(count):
        label, make = kinds[i % len(kinds)]
        yield i, f"{prose(i, 20)} {make()} then {prose(i + 1, 5)}", "src" if i % 3 else None, label


def test_forest_on_held_out_findings(spark, tmp_path):
    """Secrets and look-alikes of every form, a third held out: precision and recall are 0.95 or more."""
    rows = list(planted_findings(780))
    spark.createDataFrame(rows, "doc_id bigint, text string, source string, truth int").coalesce(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    plain = secret_scan.findings(docs)
    words = secret_scan.dictionary(docs)
    found = secret_scan.with_coverage(plain, words).cache()
    assert found.count() == plain.count()
    truth = found.join(docs.select("doc_id", F.col("truth").alias("label")), "doc_id")
    model = secret_scan.fit(truth.where("doc_id % 3 <> 0"))
    held = secret_scan.judged(truth.where("doc_id % 3 = 0"), model).collect()
    right = sum(r.kept and r.label == 1 for r in held)
    assert {r.doc_id for r in held} >= {k for k, _, _, label in rows if k % 3 == 0 and label}
    assert right >= 0.95 * sum(r.kept for r in held) and right >= 0.95 * sum(r.label for r in held)

    # features against their definitions; the dictionary against a count of words
    seen = collections.Counter(w for _, text, _, _ in rows for w in {m.lower() for m in re.findall(r"(?<![^\s(\[\"'])[^\W\d_]{4,20}(?![^\s)\]\"'.,;:!?])", text.lower())})
    known = {w for w, n in seen.items() if n >= 2}
    assert {r.word for r in words.collect()} == known
    assert len(held) >= 240
    for r in held:
        for name, value in brute_features(r.finding, r.inside, r.before, r.before2, known, model.transitions).items():
            assert r[name] == pytest.approx(value, abs=1e-9), (name, r)

    # what the forms say by themselves agrees with what was planted, and no single feature tells the labels apart
    form = secret_scan.by_form(found).join(docs.select("doc_id", "truth"), "doc_id").collect()
    assert {r.label for r in form} == {0, 1} and sum(r.label == r.truth for r in form) >= 0.98 * len(form)
    assert any(re.search("[0-9]", r.finding) for r in form if r.label == 0)

    assert secret_scan.fit(truth.where("label = 1")) is None
    assert secret_scan.judged(found, None).where("kept").count() == found.count()


def test_words_of_findings_are_not_broadcast(spark):
    texts = spark.range(300).select(F.col("id").alias("number"), F.repeat(F.lit("abcdefghij"), F.col("id").cast("int") % 7 + 5).alias("finding"))
    found = secret_scan.longest_words(texts, spark.createDataFrame([("abcdef",), ("cdefgh",), ("zzzz",)], "word string"))
    assert {(r.at % 10, r.n) for r in found.collect()} == {(0, 6), (2, 6)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_coverage_of_long_findings(spark):
    """Words that overlap count once; a finding of 200,000 letters is covered as a whole."""
    rows = [(1, "x " + "then" * 50_000 + " then when", "s"), (2, "then thenhe when password=THENwhen9thenhenx", "s"), (3, "thenhe", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = secret_scan.with_coverage(secret_scan.findings(docs), secret_scan.dictionary(docs))
    assert {r.doc_id: round(r.covered * len(r.finding)) for r in found.collect()} == {1: 200_000, 2: 14}



# --- 3: near-duplicates

def brute_similarity(a: list[str], b: list[str]) -> float:
    sh = lambda w: [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    x, y = sh(a), sh(b)
    row = [0] * (len(y) + 1)
    for s in x:
        last = 0
        for j, t in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if s == t else max(row[j], row[j - 1])
    m = row[-1]
    return m / (len(x) + len(y) - m) if x or y else 1.0


def edited(words: list[str], seed: int, share: float) -> list[str]:
    rng = np.random.default_rng(seed)
    out = []
    for w in words:
        u = rng.random()
        out += [] if u < share / 3 else [f"new{rng.integers(1e9)}"] if u < 2 * share / 3 else [w, f"put{rng.integers(1e9)}"] if u < share else [w]
    return out


def test_alignment_is_the_definition():
    rng = np.random.default_rng(8)
    for i in range(300):
        a = prose(i, int(rng.integers(1, 60))).split()
        b = edited(a, i, float(rng.choice([0.0, 0.01, 0.03, 0.06, 0.3])))
        h = lambda w: near_dedup.shingles(np.array([zlib.crc32(x.encode()) for x in w], np.int64))
        if b:
            assert near_dedup.aligned(h(a), h(b)) == (brute_similarity(a, b) >= 0.8 - 1e-12), (a, b)


def test_alignment_of_long_and_repeating_texts(monkeypatch):
    """Against the plain dynamic programme on repeating shingles, and in bounded memory on 200,000 words."""
    import tracemalloc

    rng = np.random.default_rng(3)
    for often in (1024, 2):
        monkeypatch.setattr(near_dedup, "OFTEN", often)
        for i in range(200):
            a = rng.choice([1, 2, 3, 4, 5, 6], int(rng.integers(1, 60)), p=[0.5, 0.3, 0.1, 0.05, 0.03, 0.02]).astype(np.uint64)
            b = a.copy()
            b[rng.integers(0, len(a), int(rng.integers(0, 6)))] = 9
            b = np.delete(b, rng.integers(0, len(b), int(rng.integers(0, 3))))
            row = [0] * (len(b) + 1)
            for s in a.tolist():
                last = 0
                for j, t in enumerate(b.tolist(), 1):
                    last, row[j] = row[j], last + 1 if s == t else max(row[j], row[j - 1])
            assert near_dedup.aligned(a, b) == (10 * row[-1] >= 8 * (len(a) + len(b) - row[-1]))
    a = rng.integers(0, 1 << 60, 200_000).astype(np.uint64)
    b = a.copy()
    b[:: 10] = 1
    tracemalloc.start()
    assert near_dedup.aligned(a, b) and not near_dedup.aligned(a, np.where(np.arange(len(a)) % 8, a, 1).astype(np.uint64))
    assert tracemalloc.get_traced_memory()[1] < 80 << 20
    tracemalloc.stop()


def brute_classes(docs: dict) -> dict:
    words = {k: (t or "").lower() for k, t in docs.items()}
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", t) for k, t in words.items()}
    parent = {k: k for k in docs}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(sorted(docs), 2):
        n = sorted((len(words[a]), len(words[b])))
        if words[a] == words[b] or (n[0] >= 0.75 * n[1] and brute_similarity(words[a], words[b]) >= 0.8):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: root(k) for k in docs}


@pytest.mark.parametrize("rest", [64, 1])
def test_near_classes_are_those_of_brute_force(spark, tmp_path, monkeypatch, rest):
    monkeypatch.setattr(near_dedup, "REST", rest)
    rows, n = [], 0
    for base in range(12):
        words = prose(100 + base, 90).split()
        for copy in range(1 + base % 5):
            for share in (0.0, 0.01, 0.02, 0.05)[: 1 + copy]:
                rows.append((n, " ".join(edited(words, n, share))))
                n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "a b"), (n + 3, "A  b"), (n + 4, "a c")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    found = near_dedup.classes(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert {r.key: r.class_id for r in found} == brute_classes(dict(rows))
    assert all(r.kept == (r.key == r.class_id) for r in found)
    assert collections.Counter(r.class_id for r in found) == {r.class_id: r.class_size for r in found}


@pytest.mark.parametrize("rest,block", [(64, 1024), (6, 5)])
def test_near_chains_inside_full_buckets(spark, tmp_path, monkeypatch, rest, block):
    """C is like B alone, and B is like A, which leads the buckets that B and C share; with small blocks they meet by their prefixes."""
    monkeypatch.setattr(near_dedup, "REST", rest)
    monkeypatch.setattr(linking, "BLOCK", block)
    monkeypatch.setattr(linking, "SMALL", min(block, 3) if block < 32 else 32)
    rng = np.random.default_rng(11)
    rows, chains = [], []
    word = lambda: f"w{rng.integers(1 << 40)}"
    for n in range(0, 2000, 10):
        a = [word() for _ in range(100)]
        at = rng.permutation(100)
        b, c = list(a), []
        b[at[0]] = word()
        c = list(b)
        c[at[1]], c[at[2]] = word(), word()
        rows += [(n, " ".join(a)), (n + 1, " ".join(b)), (n + 2, " ".join(c))]
        if brute_similarity(b, c) >= 0.8 > brute_similarity(a, c):
            chains.append(n)
        if n < 40:  # a hot group: copies of A with their last word changed
            rows += [(n + 3 + 10_000 * k, " ".join(a[:-1] + [word()])) for k in range(1, 30)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(1).sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "d"))
    by = {r.key: r.class_id for r in near_dedup.classes(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert len(chains) > 20 and [n for n in chains if not by[n] == by[n + 1] == by[n + 2] == n] == []
    assert all(by[k] == (k - 3) % 10_000 for k in by if k >= 10_000)


def test_near_classes_of_documents(documents):
    docs = {k: t for k, t in texts_of(documents).items() if len(t) < 4000}
    found = near_dedup.classes(documents).collect()
    brute = brute_classes(docs)
    got = {r.key: r.class_id for r in found if r.key in docs}
    together = lambda c: {frozenset(k for k in c if c[k] == v) for v in set(c.values())}
    assert together(got) == together(brute)


def test_near_classes_on_awkward_rows(awkward, empty):
    found = near_dedup.classes(awkward).collect()
    by = {r.key: r.class_id for r in found}
    assert len(found) == 17 and by[2] == 1 and by[3] == 1 and by[8] == 7 and by[5] == by[6] == by[4] == 4
    assert sum(r.kept for r in found) == len({(r.class_id, r.class_size) for r in found})
    assert [r.kept for r in found if r.key == 11].count(True) == 1
    assert near_dedup.classes(empty).collect() == []


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2)) if a != b] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    got = {r.node: r.root for r in linking.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


# --- 4: pieces

@pytest.fixture(scope="module")
def vocab():
    return pieces.vocabulary()


def lattice_of(text, vocab):
    words = pieces.words_of(text)
    known = list(dict.fromkeys(words))
    return [known.index(w) for w in words], pieces.Lattice(known, vocab)


def test_lattice_has_every_segmentation(vocab):
    numbers, lattice = lattice_of("the xñ", vocab)
    known = {p: i for i, p in enumerate(vocab.pieces) if vocab.ordinary[i]}

    def ways(text):
        if not text:
            return [[]]
        return [[known[text[:n]], *rest] for n in range(1, len(text) + 1) if text[:n] in known for rest in ways(text[n:])]

    def paths(node, end):
        if node == end:
            return [[]]
        return [[e, *rest] for e in range(lattice.first[node], lattice.first[node + 1]) for rest in paths(lattice.to[e], end)]

    for i, word in enumerate(["▁the", "▁xñ"]):
        got = paths(lattice.start[i], lattice.end[i])
        assert sorted(lattice.id[p].tolist() for p in got) == sorted(ways(word))
        logs = np.array([vocab.logs[lattice.id[p]].sum() for p in got])
        wanted = np.exp(logs) / np.exp(logs).sum()
        assert np.allclose([math.exp(lattice.log[p].sum()) for p in got], wanted, atol=1e-9)


def test_samples_follow_the_distribution(vocab):
    """First and second samples, and the weights by inclusion, against sampling without replacement by the definition."""
    vocab = pieces.vocabulary(alpha=0.3)
    numbers, lattice = lattice_of("then x", vocab)
    words = [[p for p in _paths(lattice, lattice.start[w], lattice.end[w])] for w in numbers]
    p = {tuple(sum(c, [])): math.exp(lattice.log[sum(c, [])].sum()) for c in itertools.product(*words)}
    n, first, second, weight = 6000, collections.Counter(), collections.Counter(), collections.Counter()
    for found in pieces.sample([numbers] * n, np.arange(n), lattice, 2):
        a, b = (tuple(x[0].tolist()) for x in found)
        assert a != b
        first[a] += 1
        second[b] += 1
        for edges, log, chance in found:
            weight[tuple(edges.tolist())] += math.exp(log) / chance
    for s, share in p.items():
        after = sum(q * share / (1 - q) for t, q in p.items() if t != s)
        assert abs(first[s] / n - share) < 0.025 and abs(second[s] / n - after) < 0.025 and abs(weight[s] / n - share) < 0.05


def _paths(lattice, node, end):
    if node == end:
        return [[]]
    return [[e, *rest] for e in range(lattice.first[node], lattice.first[node + 1]) for rest in _paths(lattice, lattice.to[e], end)]


def test_all_segmentations_if_there_are_few(vocab):
    numbers, lattice = lattice_of("ab", vocab)
    n = len(_paths(lattice, lattice.start[0], lattice.end[0]))
    found = pieces.sample([numbers], np.array([7]), lattice, 50)[0]
    assert len({tuple(f[0].tolist()) for f in found}) == len(found) == n
    assert sum(math.exp(f[1]) for f in found) == pytest.approx(1.0) and all(f[2] == 1.0 for f in found)


def test_pieces_round_trip_on_awkward_rows(awkward, empty, vocab):
    coded = pieces.encoded(awkward, samples=3, vocab=vocab)
    found = coded.collect()
    assert all(r.round_trip for r in found) and coded.columns == [*awkward.columns, *pieces.ADDED]
    assert [(r.sample, list(r.ids), r.inclusion) for r in found if r.doc_id == 4] == [(0, [], 1.0)]
    by = collections.defaultdict(set)
    for r in found:
        by[r.doc_id, r.text].add(tuple(r.ids))
    assert len(by[1, prose(2, 120)]) == 3 and len(by[11, prose(3, 80)]) == 3
    back = pieces.decoded(coded.select("doc_id", F.col("text").alias("was"), "ids"), vocab=vocab)
    assert back.where("coalesce(was, '') <> text").count() == 0 and back.count() == len(found)
    assert pieces.encoded(empty, vocab=vocab).collect() == []
    again = pieces.encoded(awkward.repartition(1), samples=3, vocab=vocab)
    key = lambda rows: sorted((str(r.doc_id), str(r.text)[:50], r.sample, tuple(r.ids), r.log_probability, r.inclusion) for r in rows)
    assert key(again.collect()) == key(found)


def test_ids_are_the_models(vocab):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    text = "  The\tquick brown fox ñ 漢\n\n jumps"
    numbers, lattice = lattice_of(text, vocab)
    for edges, *_ in pieces.sample([numbers], np.array([1]), lattice, 5)[0]:
        assert model.decode(pieces.edge_ids(edges, lattice, vocab).tolist()) == text == vocab.decode(model.encode(text))


# --- 5: quality classifier

def test_classifier_on_held_out_labels(spark):
    found = quality_classifier.op5_quality_classifier(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95 and np.mean([g >= 0.3 for g in good]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_long_texts_score_like_their_parts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where(quality_classifier.fold(F.col("doc_id")) == 0)
    model = quality_classifier._trained(docs, spark, "/root/testdata/sf0.1")
    rows = docs.join(labels, "doc_id").orderBy("doc_id").collect()
    for label in (0, 1):
        parts = [r.text for r in rows if r.quality == label and r.text]
        joined = "\n".join(parts)
        long = joined * -(-4_000_000 // len(joined))
        texts = spark.createDataFrame([(0, long)] + [(1, t) for t in parts], "is_part int, text string")
        found = {r.is_part: r.score for r in quality_classifier.score(texts, model).groupBy("is_part").agg(F.avg("score").alias("score")).collect()}
        assert found[0] >= found[1] - 0.05 if label else found[0] <= found[1] + 0.05


def test_classifier_on_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(i, int(i < 7)) for i in range(1, 15)] + [(1, 0), (99, 1), (2, None)], "doc_id bigint, quality int")
    model = quality_classifier.fit(awkward, labels)
    found = quality_classifier.score(awkward, model).collect()
    assert len(found) == 17 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (4, 5)}) == 1
    assert quality_classifier.score(empty, model).collect() == []
    for some, low, high in ((labels.where("quality = 1"), 0.5, 1), (labels.where("quality = 0"), 0, 0.5), (labels.limit(0), 0.5, 0.5)):
        scores = {r.score for r in quality_classifier.score(awkward, quality_classifier.fit(awkward, some)).collect()}
        assert len(scores) == 1 and low <= scores.pop() <= high


# --- 6: mixing

def brute_targets(sizes: dict, repeats: int = 3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(repeats * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: repeats * sizes[s] if s in full else left * weight[s] / w for s in names}
        over = {s for s in names if s not in full and target[s] > repeats * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 400, None: 90, "": 3}, {"x": 5}, {"a": 1, "b": 1, "c": 1000, "d": 0, "e": 7}])
def test_targets(spark, sizes):
    rows = [(s is None, s or "", n) for s, n in sizes.items()]
    got = mixing.targets(spark.createDataFrame(rows, "no_source boolean, source string, size bigint")).collect()
    wanted = brute_targets(sizes)
    assert {None if r.no_source else r.source: pytest.approx(r.target) for r in got} == wanted


def test_mix_by_replaying_the_schedule(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, prose(i, int(rng.integers(0, 40))), ["a", "b", "c", None][int(rng.integers(0, 4)) if i % 3 else 0]) for i in range(150)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = {r.key: r for r in mixing.mixed(docs, slots=500).collect()}
    size = {i: len(t.split()) for i, t, _ in rows}
    of = {i: s for i, _, s in rows}
    totals = collections.Counter()
    for i in size:
        totals[of[i]] += size[i]
    target = brute_targets(totals)
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    tape = {s: [d for _, d in sorted((hashlib.md5(f"mix-{d}".encode()).hexdigest(), d) for d in size if of[d] == s) for _ in range(size[d])] for s in names}
    total = sum(totals.values())
    block = -(-total // 500)
    used = -(-total // block)
    edges = np.cumsum([0] + [int(target[s] / sum(target.values()) * 2.0**40) for s in names]) >> 8
    order, rank, taken = [], collections.Counter(), collections.Counter()
    for slot in range(used):
        at = int(np.searchsorted(edges, slot * mixing.GOLDEN % 2**32, side="right")) - 1
        order += [names[at]] if at < len(names) else []
    plan = mixing.schedule(mixing.written(mixing.targets(mixing.sizes(docs)), "test"), used).collect()
    assert [None if r.no_source else r.source for r in sorted(plan, key=lambda r: r.slot)] == order
    for s in order + [s for s in names for _ in range(used)]:  # the slots, and then those that targets lack
        for x in range(rank[s] * block, (rank[s] + 1) * block):
            if x < math.floor(target[s] + 0.5):
                taken[tape[s][x % totals[s]]] += 1
        rank[s] += 1
    assert {i: r.taken for i, r in got.items()} == {i: taken[i] for i in size}
    assert all(r.taken <= 3 * r.size and r.target == pytest.approx(target[of[i]]) and r.source_size == totals[of[i]] for i, r in got.items())


@pytest.mark.parametrize("slots", [7, 60, 1 << 20])
def test_closed_schedule_covers_every_target(spark, tmp_path, slots):
    """Also of sources that are far smaller than a block."""
    rng = np.random.default_rng(6)
    rows = [(i, prose(i, int(rng.integers(1, 60))), "big") for i in range(200)]
    rows += [(1000 + i, prose(i, 3 + i % 20), f"s{i // 2}") for i in range(80)] + [(2000, None, "none"), (2001, "a b c", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = mixing.mixed(docs, slots=slots).collect()
    of = {i: s for i, _, s in rows}
    totals, taken = collections.Counter(), collections.Counter()
    for r in got:
        totals[of[r.key]] += r.size
        taken[of[r.key]] += r.taken
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    assert {s: taken[s] for s in totals} == {s: pytest.approx(t, abs=0.5) for s, t in brute_targets(totals).items()}
    total = sum(totals.values())
    words = max(1, -(-total // slots))
    goals = mixing.written(mixing.targets(mixing.sizes(docs)), "test-targets")
    plan = mixing.closed(mixing.schedule(goals, -(-total // words)), goals, words, -(-total // words)).collect()
    ranks = collections.defaultdict(list)
    for r in sorted(plan, key=lambda r: r.slot):
        ranks[None if r.no_source else r.source].append(r.rank)
    assert len({r.slot for r in plan}) == len(plan) and all(v == list(range(len(v))) for v in ranks.values())
    assert {s: len(v) for s, v in ranks.items()} == {s: math.ceil(math.floor(t + 0.5) / words) for s, t in brute_targets(totals).items() if t}


def test_mixing_stage_keeps_small_sources(spark, tmp_path, monkeypatch):
    rows = [(i, prose(i, 100), "big") for i in range(60)] + [(100 + i, prose(i, 10), f"s{i:02}") for i in range(30)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(1).write.parquet(str(tmp_path / "d"))
    monkeypatch.setattr(mixing.mixed, "__defaults__", tuple(20 if d == mixing.SLOTS else d for d in mixing.mixed.__defaults__))
    found = mixing.mixing_stage(spark, spark.read.parquet(str(tmp_path / "d")), "").collect()
    times = collections.Counter(r.source for r in found)
    assert all(times[f"s{i:02}"] == 3 for i in range(30))


def test_mix_on_awkward_rows(spark, awkward, empty):
    found = mixing.mixed(awkward).collect()
    assert len(found) == 17 and all(0 <= r.taken <= 3 * r.size for r in found)
    assert abs(sum(r.taken for r in found) - sum(r.size for r in found)) <= 0.01 * sum(r.size for r in found)
    assert mixing.mixed(empty).collect() == []
    assert mixing.mixing_stage(spark, empty, "").collect() == []


def test_mix_of_blank_texts(spark, tmp_path):
    spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, " \n", None)], "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert {(r.key, r.size, r.target, r.taken) for r in mixing.mixed(docs).collect()} == {(i, 0, 0.0, 0) for i in (1, 2, 3)}
    assert mixing.mixing_stage(spark, docs, "").collect() == []


def test_mix_of_many_sources(spark, tmp_path):
    """More sources than cells, a hundred of a word or two, at few slots."""
    rows = [(i, prose(i, 1 + i % 2), f"t{i:03}") for i in range(100)] + [(1000 + i, prose(i, 200), f"u{i:03}") for i in range(300)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "d"))
    got = mixing.mixed(spark.read.parquet(str(tmp_path / "d")), slots=50).collect()
    totals = collections.Counter()
    for i, t, s in rows:
        totals[s] += len(t.split())
    wanted = brute_targets(totals)
    assert all(r.taken == pytest.approx(wanted[rows[r.key][2] if r.key < 1000 else rows[100 + r.key - 1000][2]], abs=0.5) for r in got)


def test_mixing_stage_on_awkward_rows(spark, awkward):
    found = mixing.mixing_stage(spark, awkward, "").collect()
    assert found and all((r.text or "").split() for r in found) and found[0].asDict().keys() == set(awkward.columns)


# --- 7: sharding

@pytest.mark.parametrize("bucket_bytes", [32 << 20, 20_000])
def test_shards(awkward, documents, empty, bucket_bytes):
    for docs, n in ((documents, 200), (awkward, 17)):
        found = sharding.sharded(sharding.shuffled(docs, bucket_bytes=bucket_bytes)).collect()
        counts = collections.Counter(r.shard for r in found)
        sizes = [counts[s] for s in range(16)]
        assert len(found) == n and max(sizes) - min(sizes) <= 1
        for s in range(16):
            assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
        again = sharding.sharded(sharding.shuffled(docs.repartition(5), bucket_bytes=bucket_bytes)).collect()
        key = lambda rows: sorted((r.shard, r.slot, str(r.doc_id), str(r.text)) for r in rows)
        assert key(again) == key(found)
        assert key(sharding.sharded(sharding.shuffled(docs, seed=1, bucket_bytes=bucket_bytes)).collect()) != key(found)
    assert sharding.sharded(sharding.shuffled(empty)).collect() == []


def test_repeated_rows_do_not_fill_a_bucket(spark, tmp_path):
    rows = [(None, None)] * 3000 + [(1, "same text " * 20)] * 2000 + [(i, prose(i, 5)) for i in range(1000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    records = sharding.shuffled(docs, bucket_bytes=40_000)
    sizes = [r["count"] for r in records.groupBy("bucket").count().collect()]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)
    counts = collections.Counter(r.shard for r in sharding.sharded(records).collect())
    assert sum(counts.values()) == 6000 and max(counts.values()) - min(counts.values()) <= 1


def test_shuffled_order_is_the_definition(documents):
    found = sharding.shuffled(documents, bucket_bytes=100_000).collect()
    marks = {r.doc_id: r.m for r in documents.select("doc_id", F.xxhash64(F.lit(0), F.col("doc_id").cast("string"), F.col("text")).alias("m")).collect()}
    for b in {r.bucket for r in found}:
        mine = sorted((r for r in found if r.bucket == b), key=lambda r: r.position)
        fixed = sorted((r.doc_id for r in mine), key=lambda k: (marks[k], str(k)))
        order = np.random.Generator(np.random.PCG64([0, b])).permutation(len(mine))
        assert [r.doc_id for r in mine] == [fixed[i] for i in order]


# --- 8: lines

def test_line_templates(spark, tmp_path):
    shared = "Page 3 of the yearly report on water"
    rows = [(i, "\n".join([prose(40 + i, 12), f"Page {i} of the yearly report on water", f"user{i} said so once more", "ok", prose(60 + i, 9)])) for i in range(5)]
    rows += [(7, shared), (8, "some other line here"), (9, None), (10, ""), (None, "Page 1 of the yearly report on water\nlast")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2).write.parquet(str(tmp_path / "d"))
    got = {r.key: r for r in line_dedup.deduplicated(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0
    for i in range(1, 5):
        a = rows[i][1].split("\n")
        assert got[i].text == "\n".join([a[0], a[4]]) and got[i].n_dropped == 3 and got[i].n_lines == 5
    assert got[7].text == "" and got[8].text == "some other line here" and got[9].text == got[10].text == "" and got[None].text == "last"


def test_equal_lines_recur_from_the_second_document_on(spark, tmp_path):
    passage = prose(9, 50)
    rows = [(1, f"{prose(90, 9)}\n{passage}\nok then"), (2, passage.replace(" ", "  ") + "\nalone\n\n\nx"), (3, "ok then\nok then\n 1 2 3"), (4, "1 2 3\n1 2 4\nx\n"), (5, "1 2 4 5")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2).write.parquet(str(tmp_path / "d"))
    got = {r.key: (r.text, r.n_dropped) for r in line_dedup.deduplicated(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("alone\n\n\nx", 1), 3: (" 1 2 3", 2), 4: ("1 2 4\n", 2), 5: ("1 2 4 5", 0)}


def test_lines_on_awkward_rows(awkward, empty):
    found = line_dedup.deduplicated(awkward).collect()
    assert len(found) == 17 and {r.key: r.n_dropped for r in found}[14] == 0
    assert line_dedup.deduplicated(empty).collect() == []


# --- 9: quality rules

def brute_base(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_base_counts(documents, awkward):
    for docs in (documents, awkward):
        texts = [r.text or "" for r in docs.collect() if len(r.text or "") < 6000]
        found = quality_rules.judged(docs).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
        got = collections.Counter(tuple(r)[:5] for r in found)
        assert not collections.Counter(map(brute_base, texts)) - got
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in found)


def test_distances_are_the_definition(spark):
    rng = np.random.default_rng(6)
    for _ in range(5):
        p, q = rng.dirichlet(np.ones(6)), np.array([0, *rng.dirichlet(np.ones(5))])
        m = (p + q) / 2
        kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
        df = spark.createDataFrame([(p.tolist(), q.tolist())], "p array<double>, q array<double>")
        assert df.select(quality_rules.js_distance(F.col("p"), F.col("q"))).first()[0] == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2))


def test_common_words_are_exact(documents):
    docs = documents.select(F.col("lang").alias("language"), "text")
    got = {r.language: set(r.words) for r in quality_rules.common_words(docs.repartition(7)).collect()}
    counts = collections.defaultdict(collections.Counter)
    for r in docs.collect():
        counts[r.language].update(re.findall(r"[^\x20\x09-\x0D]+", r.text.lower()))
    assert got == {k: {w for w, n in c.items() if n * quality_rules.RARE >= c.total()} for k, c in counts.items()}


def test_rules_keep_clean_documents(spark):
    rows = quality_rules.op9_quality_rules(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_rules_on_awkward_rows(awkward, empty):
    found = quality_rules.judged(awkward).collect()
    assert len(found) == 17 and not any(r.kept for r in found if r.doc_id in (4, 5, 6, 12))
    assert quality_rules.judged(empty).collect() == []


# --- 10: exact repeats

def test_perfect_hash_is_minimal_and_rejects_others():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    sizes, bits, slot = exact_dedup.perfect_hash(b"".join(keys))
    assert sorted(slot.tolist()) == list(range(3000)) and (exact_dedup.slots(b"".join(keys), sizes, bits) == slot).all()
    others = exact_dedup.slots(b"".join(hashlib.sha256(f"x{i}".encode()).digest() for i in range(1000)), sizes, bits)
    assert others.min() >= -1 and others.max() < 3000
    assert exact_dedup.perfect_hash(b"")[0] == []


@pytest.mark.parametrize("share", ["all", "none", "half"])
def test_exact_groups_are_those_of_brute_force(awkward, empty, monkeypatch, share):
    monkeypatch.setattr(exact_dedup, "PART_KEYS", 2)
    historical = {"all": F.lit(True), "none": F.lit(False), "half": exact_dedup.in_history(F.col("key"))}[share]
    found = exact_dedup.exact_groups(awkward, historical).collect()
    groups = collections.defaultdict(list)
    for r in awkward.collect():
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).digest()].append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    assert len(found) == 17
    for d, members in groups.items():
        mine = [r for r in found if bytes(r.digest) == d]
        best = min(members)
        assert {r.group_size for r in mine} == {len(members)} and {r.keep_id for r in mine} == {None if best[1] else best[2]}
        assert [r.key for r in mine if r.kept] == [None if best[1] else best[2]]
    assert exact_dedup.exact_groups(empty, historical).collect() == []


def test_an_index_part_whose_keys_are_all_null(spark, tmp_path):
    rows = [(None, "a b"), (None, "c"), (None, None), (None, "ab")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    for historical in (F.lit(True), F.lit(False)):
        found = exact_dedup.exact_groups(spark.read.parquet(str(tmp_path / "d")), historical).collect()
        assert sorted((r.group_size, r.keep_id, r.kept) for r in found) == [(1, None, True), (1, None, True), (2, None, False), (2, None, True)]


def test_slots_of_the_index(spark, documents):
    rows = exact_dedup.written(exact_dedup.keyed(documents), "t")
    index, parts = exact_dedup.build(rows, 200)
    held = index.collect()
    assert parts == 1 and len(held) == 1 and len(held[0].digests) == 32 * len(held[0].key) == 32 * rows.select("digest").distinct().count()
    found = exact_dedup.dedup(rows, index, parts)
    assert found.where("not member").count() == 0 and found.agg(F.sum("group_size")).first()[0] == 400
