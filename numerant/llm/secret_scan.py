"""Secret scan with a random forest that removes false positives.

``findings``: every run of 16 or more of ``[A-Za-z0-9+/_-]`` in a text, and every value of six or more characters, of whatever
kind, that is assigned to a telling name (``password=...``, ``"api_key": ...``, ``token = ...``) or follows one (``password ...``);
with its word, place, neighbouring words and path. A value is one finding: runs inside it are not findings of their own.
``dictionary``: the words of 4 to 20 letters found in two or more rows; ``with_coverage``: the share of a finding's characters
that lie in such a word, wherever in the finding it starts. ``features``: length; mean log-probability of its character
transitions under those of ordinary findings; that share; shares of digits and capitals; switches of character kind;
spread of characters; quotes, assignment and telling names beside it; how often findings after the
same word, and in the same path, were secrets. ``fit`` trains a random forest from labelled findings.

Everything is DataFrame and SQL functions and an MLlib forest; no Python runs on executors.

The tables hold no labelled findings, so the query labels those whose form leaves no doubt (``by_form``):
issued key formats, assigned hexadecimal strings and assigned values of letters and digits are secrets; runs of letters in
one case, digits alone, UUIDs, digests behind a word that says so, encoded data behind ``base64,`` and paths are
not. No single feature tells the two apart. A table of reviewed
findings takes its place without any change. The fit reads at most ``most`` findings per label, those
with the smallest hash of key and place; dictionary counts cover all texts; every finding is scored.

Defined results: a null or empty text has no finding; a null path is a path; without labelled findings of both
kinds there is nothing to fit, and each finding gets probability null and is kept, so nothing is lost
for want of labels; repeated rows have findings each; an empty table gives an empty result; other
columns are ignored; U+0001 and U+0002 are left out of texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .common import SPACE, fold, table, text_of, written

RUN = "[A-Za-z0-9+/_-]{16,}"
NAME = "(?:key|token|secret|passw|pwd|auth|api|credential|bearer)"
NAMES = f"(?i){NAME}"
VALUE = "[^\"'`,;]{5,}[^\"'`,;.!?)\\]]"
ASSIGN = "(?::=|=>|=|:)"
#: A value in the word of its name: the name, at most 32 more characters of it, the sign of assignment, a quote.
IN_WORD = f"(?<=(?i:{NAME})[A-Za-z0-9_.-]{{0,32}}[\"'`]?{ASSIGN}[\"'`]?)(?![=>\"'`]){VALUE}"
#: A word whose next word is a value: a telling name with a sign of assignment, or a whole name alone.
TELLS = (
    f"(?i){NAME}[a-z0-9_.-]*[\"'`]?{ASSIGN}[\"'`]?$"
    "|(?i)^(?:[a-z0-9]+[_.-])*(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?|bearer)$"
)
SIGN = f"^{ASSIGN}$"
OPEN, CLOSE = "\u0001", "\u0002"
NEAR = 64  # characters before a finding, in its word, that are looked at
LETTERS = (4, 20)  # of the words of the dictionary
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
KINDS = len(ALPHABET) + 1
FEATURES = (
    "length", "transitions", "covered", "digits", "capitals", "switches", "distinct", "quoted", "assigned", "named",
    "word_rate", "path_rate",
)


def _tells(one: Column, two: Column) -> Column:
    """Whether the word before (``one``), or it and the one before it (``two``), make the next word a value."""
    return F.coalesce(one.rlike(TELLS) | (one.rlike(SIGN) & two.rlike(NAMES)), F.lit(False))


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, at (word), part (finding in the word), finding, inside (its word up to it, NEAR characters at most), before, before2, after, path."""
    words = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.split(F.translate(text_of(text), OPEN + CLOSE, ""), SPACE + "+").alias("words"),
    )
    near = lambda i, by: F.get("words", i + by)
    numbered = F.transform("words", lambda w, i: F.struct(
        w.alias("word"), i.alias("at"), _tells(near(i, -1), near(i, -2)).alias("told"),
    ))
    hits = F.filter(numbered, lambda s: F.when(s["told"], s["word"].rlike(VALUE)).otherwise(s["word"].rlike(RUN) | (s["word"].rlike(f"[=:].{{6}}") & s["word"].rlike(IN_WORD))))
    beside = F.transform(hits, lambda s: F.struct(
        s["word"].alias("word"), s["at"].alias("at"), s["told"].alias("told"),
        *(near(s["at"], by).alias(c) for c, by in (("before", -1), ("before2", -2), ("after", 1))),
    ))
    found = words.select("doc_id", "path", F.explode(beside).alias("s")).select(
        "doc_id", "path", "s.at", "s.before", "s.before2", "s.after",
        # each piece but the first begins with a finding, closed by CLOSE
        F.split(F.when(F.col("s.told"), F.regexp_replace("s.word", VALUE, f"{OPEN}$0{CLOSE}"))
                .otherwise(F.regexp_replace("s.word", f"{IN_WORD}|{RUN}", f"{OPEN}$0{CLOSE}")), OPEN).alias("pieces"),
    )
    each = F.transform(F.sequence(F.lit(1), F.size("pieces") - 1), lambda k: F.struct(
        (k - 1).alias("part"), F.substring_index(F.get("pieces", k), CLOSE, 1).alias("finding"),
        F.right(F.concat(
            F.right(F.translate(F.coalesce(F.get("pieces", k - 2), F.lit("")), CLOSE, ""), F.lit(NEAR)), F.right(F.translate(F.get("pieces", k - 1), CLOSE, ""), F.lit(NEAR)),
        ), F.lit(NEAR)).alias("inside"),
    ))
    found = found.where(F.size("pieces") > 1).select("*", F.explode(each).alias("f"))
    return found.select("doc_id", "path", "at", "f.part", "f.finding", "f.inside", "before", "before2", "after")


def dictionary(docs: DataFrame, text: str = "text", least: int = 2) -> DataFrame:
    """word: the words of LETTERS letters, in lower case, that stand alone in ``least`` rows or more; counted over all texts."""
    lo, hi = LETTERS
    alone = rf"(?<![^\s(\[\"'])\p{{L}}{{{lo},{hi}}}(?![^\s)\]\"'.,;:!?])"
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_of(text)), F.lit(alone), F.lit(0)))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word")


def longest_words(texts: DataFrame, words: DataFrame) -> DataFrame:
    """number, at, n: for each place of a finding where one of ``words`` begins, the length of the longest such word."""
    lo, hi = LETTERS
    from_here = F.regexp_extract_all(F.lower("finding"), F.lit(rf"(?=(\p{{L}}{{0,{hi}}}))"), F.lit(1))
    places = texts.select("number", F.posexplode(from_here).alias("at", "run"))
    starts = places.where(F.length("run") >= lo).select(
        "number", "at", F.explode(F.transform(F.sequence(F.lit(lo), F.length("run")), lambda n: F.left("run", n))).alias("word")
    )
    return starts.hint("merge").join(words, "word").groupBy("number", "at").agg(F.max(F.length("word")).alias("n"))


def with_coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with covered: the share of the characters of a finding that lie in an occurrence of one of ``words``.

    Each place of a distinct finding begins at most 17 words; these meet the dictionary in one shuffled join, under a number of
    the finding. Nothing of the dictionary is held by one task, and the words of the places are never broadcast: Spark's estimate
    of them is that of the findings they come from, hundreds of times less.
    """
    # The number is written, so that both readings have the same one.
    texts = written(found.select("finding").distinct().withColumn("number", F.monotonically_increasing_id()), "secret-texts")
    ends = lambda s, e: F.greatest(s["end"], e["at"] + e["n"])
    united = F.aggregate(
        F.array_sort(F.collect_list(F.struct("at", "n"))), F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda s, e: F.struct(ends(s, e).alias("end"), (s["total"] + ends(s, e) - F.greatest(s["end"], e["at"])).alias("total")),
        lambda s: s["total"],
    )
    inner = longest_words(texts, words).groupBy("number").agg(united.alias("inner"))
    cover = written(texts.hint("merge").join(inner, "number").select(F.sha2("finding", 256).alias("digest"), "inner"), "secret-cover")
    out = found.withColumn("digest", F.sha2("finding", 256)).join(broadcast_if_small(cover), "digest", "left")
    return out.withColumn("covered", F.coalesce(F.col("inner"), F.lit(0)) / F.length("finding")).drop("digest", "inner")


def _codes(finding: Column) -> Column:
    return F.transform(F.split(F.lower(finding), ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c)))


def _pairs(codes: Column) -> Column:
    n = F.size(codes)
    return F.zip_with(F.slice(codes, F.lit(1), n - 1), F.slice(codes, F.lit(2), n - 1), lambda a, b: a * KINDS + b)


def transition_logs(ordinary: DataFrame) -> list[float]:
    """Log-probability of each pair of characters after its first one, learned from ordinary findings."""
    import math

    pairs = ordinary.select(F.explode(_pairs(_codes(F.col("finding")))).alias("pair"))
    counts = {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect()}  # KINDS squared at most
    rows = [sum(counts.get(a * KINDS + b, 0) for b in range(KINDS)) for a in range(KINDS)]
    return [math.log((counts.get(a * KINDS + b, 0) + 0.5) / (rows[a] + 0.5 * KINDS)) for a in range(KINDS) for b in range(KINDS)]


@dataclass(frozen=True)
class SecretModel:
    """What the fit knows: all of bounded size."""

    transitions: list[float]
    rates: DataFrame  # kind ('word' or 'path'), value, rate
    base: float
    forest: RandomForestClassificationModel


def _cleaned(word: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(word, F.lit("")), r"[^A-Za-z=:]", ""))


def features(found: DataFrame, transitions: list[float], rates: DataFrame, base: float) -> DataFrame:
    """``found``, which has its coverage, with all columns of FEATURES."""
    f, n = F.col("finding"), F.length("finding")
    share = lambda pattern: F.regexp_count(f, F.lit(pattern)) / n
    logs = F.array(*map(F.lit, transitions))
    total = F.aggregate(_pairs(_codes(f)), F.lit(0.0), lambda s, p: s + F.element_at(logs, (p + 1).cast("int")))
    before = F.concat_ws(" ", F.coalesce("before2", F.lit("")), F.coalesce("before", F.lit("")), "inside")
    rate = lambda kind: F.broadcast(rates.where(F.col("kind") == kind).select(F.col("value").alias(f"_{kind}"), F.col("rate").alias(f"{kind}_rate")))
    out = found.withColumn("_before", _cleaned(F.col("before")))
    out = out.join(rate("word"), F.col("_before") == F.col("_word"), "left").join(rate("path"), F.col("path") == F.col("_path"), "left")
    return out.withColumns({
        "length": n.cast("double"),
        "transitions": total / F.greatest(n - 1, F.lit(1)),
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "switches": F.regexp_count(f, F.lit("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]")) / n,
        "distinct": F.size(F.array_distinct(F.split(f, ""))) / n,
        "quoted": F.col("inside").rlike("[\"'`]$").cast("double"),
        "assigned": before.rlike("[=:][ \"'`]*$").cast("double"),
        "named": before.rlike(NAMES).cast("double"),
        "word_rate": F.coalesce("word_rate", F.lit(base)),
        "path_rate": F.coalesce("path_rate", F.lit(base)),
    }).drop("_before", "_word", "_path")


def _rates(sample: DataFrame, base: float, pseudo: float = 10.0, least: int = 5) -> DataFrame:
    """Smoothed rates of secrets by the word before and by path, where at least ``least`` findings show it."""
    one = lambda kind, value: sample.select(F.lit(kind).alias("kind"), value.alias("value"), "label")
    each = one("word", _cleaned(F.col("before"))).union(one("path", F.col("path")))
    rate = (F.sum("label") + F.lit(pseudo * base)) / (F.count("*") + F.lit(pseudo))
    return each.groupBy("kind", "value").agg(rate.alias("rate"), F.count("*").alias("n")).where(F.col("n") >= least).drop("n")


def fit(labelled: DataFrame, most: int = 10_000, trees: int = 40, depth: int = 8, seed: int = 7) -> SecretModel | None:
    """The model of labelled findings (label 1: a secret); None without both labels. At most 2 * ``most`` are read."""
    by_hash = (F.xxhash64("doc_id", "at", "part"), "doc_id", "at", "part")
    chosen = [labelled.where(F.col("label") == c).orderBy(*by_hash).limit(most) for c in (0, 1)]
    sample = written(chosen[0].union(chosen[1]), "secret-sample")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    base = counts[1] / sum(counts.values())
    transitions = transition_logs(sample.where("label = 0"))
    rates = written(_rates(sample, base), "secret-rates")  # rows: 2 * 2 * most / least at most
    x = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features(sample, transitions, rates, base))
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return SecretModel(transitions, rates, base, forest.fit(x.select("label", "features")))


def judged(found: DataFrame, model: SecretModel | None, least: float = 0.5) -> DataFrame:
    """``found`` with probability, and kept: whether it is reported as a secret."""
    if model is None:
        return found.withColumns({"probability": F.lit(None).cast("double"), "kept": F.lit(True)})
    x = features(found, model.transitions, model.rates, model.base)
    scored = model.forest.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x))
    p = vector_to_array("probability")[1]
    return scored.withColumn("p", p).drop("probability", "rawPrediction", "prediction", "features").withColumnRenamed("p", "probability").withColumn("kept", F.col("probability") >= least)


def by_form(found: DataFrame) -> DataFrame:
    """The findings whose form leaves no doubt, with label."""
    f = F.col("finding")
    behind = F.concat_ws(" ", F.coalesce("before2", F.lit("")), F.coalesce("before", F.lit("")), "inside")
    assigned, named = behind.rlike("[=:] *[\"'`]?$"), behind.rlike(NAMES)
    digest = behind.rlike(r"(?i)\b(sha-?\d*|md5|digest|hash|checksum|commit|revision|etag|uuid|guid)\W*$")
    issued = f.rlike("^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|[sr]k_live_[A-Za-z0-9]{16,})$")
    hexadecimal = f.rlike("^[0-9a-f]{18,}$") & f.rlike("[0-9]") & f.rlike("[a-f]") & assigned & ~digest
    mixed = assigned & named & ~digest & f.rlike("[0-9]") & f.rlike("[A-Za-z]") & ~f.rlike("[(){}<>\\[\\]]")
    plain = f.rlike(r"^([A-Z]?[a-z]+|[A-Z]+|\d[\d+/_-]*)$") & ~(assigned & named)
    data = behind.rlike("base64,$") | digest
    ids = f.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$") & ~named
    path = f.rlike("^/?[a-z0-9_-]{1,20}(/[a-z0-9_-]{1,20}){2,}$") & ~named
    label = F.when(issued, 1).when(plain | data | ids | path, 0).when(hexadecimal | mixed, 1)
    return found.withColumn("label", label).where("label is not null")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = written(with_coverage(written(findings(docs), "secret-findings"), dictionary(docs)), "secret-covered")
    model = fit(by_form(found.where(fold(F.col("doc_id")) != 0)))
    return judged(found, model).select(
        "doc_id", "at", "part", F.length("finding").alias("length"), F.sha2("finding", 256).alias("finding_sha256"), "probability", "kept"
    )
