"""Quality rules by divergence: how far a document's character classes and common words are from its language.

Three passes, each over all whole texts:

1. ``common_words``: the words of each language, lower case, with at least one in ``RARE`` of its words. A
   word that frequent overall is that frequent in one task at least, so tasks send only those; a second
   aggregation counts the candidates exactly.
2. ``measured``: the counts of the base rule, the histogram of character classes and that of the
   common words (the last bin: all other words) of each document. Written once.
3. ``judged``: the reference of a language is the mean distribution of its documents that pass the
   base rule. Jensen-Shannon distances (base 2, square root) of a document to its reference decide.

A document fails if it fails the base rule, or if it is long enough for its histogram to mean something
(``min_chars`` characters for the classes, ``min_words`` words for the words) and the distance is above
the limit. Limits are parameters, in units that do not depend on the language.

Defined results: a null or empty text has no words and fails the base rule; a null language is a
language of its own; a language of which no document passes the base rule has no reference, and only
the base rule judges it; repeated rows are judged alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_of, written

RARE = 400  # a common word is at least one in so many words of its language, so there are fewer than that
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "other punctuation", "symbol", "mark", "rest")


def _tokens(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def common_words(docs: DataFrame, rare: int = RARE) -> DataFrame:
    """language, words: for each language the lower-case words with at least one in ``rare`` of its words."""

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str | None, Counter] = {}
        totals: Counter = Counter()
        floor: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = _tokens(text.as_py().lower())
                totals[lang] += len(words)
                c = counts.setdefault(lang, Counter())
                c.update(words)
                if len(c) > 200_000:  # lossy counting: no word that is missing was seen more than floor times
                    least = totals[lang] / (2 * rare)
                    counts[lang] = Counter({w: n for w, n in c.items() if n + floor[lang] >= least})
                    floor[lang] = least
        rows = [(lang, w) for lang, c in counts.items() for w, n in c.items() if n >= totals[lang] / (2 * rare)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["language", "word"])

    found = docs.mapInArrow(candidates, "language string, word string").distinct()
    listed = found.groupBy("language").agg(F.sort_array(F.collect_set("word")).alias("words"))
    total = F.max(F.when(F.col("word").isNull(), F.col("n"))).over(Window.partitionBy("language"))
    counted = _counted(docs, listed).withColumn("total", total)  # under 2 * rare + 2 rows for each language
    kept = counted.where(F.col("word").isNotNull() & (F.col("n") * rare >= F.col("total")))
    return kept.groupBy("language").agg(F.sort_array(F.collect_list("word")).alias("words"))


def _lists(listed: DataFrame) -> dict[str | None, list[str]]:
    """To the driver: a list of bounded length for each language."""
    return {r["language"]: r["words"] for r in listed.collect()}


def _counted(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """language, word, n: exact counts of the listed words; the row without a word counts all words."""
    lists = _lists(listed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {lang: frozenset(words) for lang, words in lists.items()}
        counts: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words, mine = _tokens(text.as_py().lower()), wanted.get(lang, frozenset())
                counts[lang, None] += len(words)
                for w in words:
                    if w in mine:
                        counts[lang, w] += 1
        rows = [(*k, n) for k, n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
            names=["language", "word", "n"],
        )

    return docs.mapInArrow(count, "language string, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n"))


def _class_table() -> dict[int, int]:
    """Class of each code point below 256 and of common punctuation; others are asked one by one."""
    import unicodedata

    kinds = {"Ll": 0, "Lu": 1, "Lt": 1, "Nd": 2, "Zs": 3, "Lo": 0, "Lm": 0, "Mn": 8, "Mc": 8}

    def of(ch: str) -> int:
        if ch == "\n":
            return 4
        if ch in "\t\r\x0b\x0c":
            return 3
        if ch in ".,;:!?'\"()-":
            return 5
        if ch in "#*$%&|<>":
            return 7
        kind = unicodedata.category(ch)
        return kinds.get(kind, 6 if kind[0] == "P" else 7 if kind[0] == "S" else 9)

    class Table(dict):
        def __missing__(self, code: int) -> int:
            self[code] = value = 97 + of(chr(code))
            return value

    return Table()


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    symbols = sum(map(text.count, "#*$%&|<>"))
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line and not re.fullmatch(r"[\x20\x09-\x0D]*", line):
            repeated_lines += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    in_repeats = 0
    if len(set(windows)) < len(windows):
        counts, covered = Counter(windows), -1
        for i, w in enumerate(windows):
            if counts[w] > 1:
                in_repeats += min(3, i + 2 - covered)
                covered = i + 2
    return sum(map(len, words)), symbols, repeated_lines, in_repeats


_MEASURED = "doc_id long, language string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars array<long>, commons array<long>"


def measured(docs: DataFrame, lists: dict[str | None, list[str]]) -> DataFrame:
    """doc_id, language and the counts of each document. ``docs``: language, text, doc_id."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _class_table()
        places = {lang: {w: i for i, w in enumerate(words)} for lang, words in lists.items()}
        for batch in batches:
            rows = []
            for lang, text, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py()
                words = _tokens(text)
                coded = text.translate(classes)
                chars = [coded.count(chr(97 + k)) for k in range(10)]
                place = places.get(lang, {})
                commons = [0] * (len(place) + 1)
                for w in words if place else ():
                    commons[place.get(w.lower(), -1)] += 1
                rows.append((key, lang, len(words), *base_counts(text, words), chars, commons))
            types = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = [x.strip().split(" ")[0] for x in _MEASURED.split(",")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return docs.mapInArrow(measure, _MEASURED)


def _shares(counts):
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1)))


def js_distance(p, q):
    """Jensen-Shannon distance of two distributions given as arrays of one length."""
    term = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    parts = F.zip_with(p, q, lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def references(rows: DataFrame) -> DataFrame:
    """language, char_reference, word_reference: mean distributions of the documents that pass the base rule."""
    good = rows.where("not base_failed")
    out = None
    for counts, name in (("chars", "char_reference"), ("commons", "word_reference")):
        each = good.select("language", F.posexplode(_shares(F.col(counts))).alias("i", "x"))
        mean = each.groupBy("language", "i").agg(F.avg("x").alias("x"))
        one = mean.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("a"))
        one = one.select(F.col("language").alias("_l"), F.transform("a", lambda s: s["x"]).alias(name))
        out = one if out is None else out.join(one.withColumnRenamed("_l", "_k"), F.col("_l").eqNullSafe(F.col("_k"))).drop("_k")
    return out


def judged(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", min_chars: int = 200, min_words: int = 50,
    max_char_distance: float = 0.25, max_word_distance: float = 0.42,
) -> DataFrame:
    """Every document with its counts, distances, base_failed and kept."""
    slim = docs.select(F.col(lang).cast("string").alias("language"), text_of(text).alias("text"), F.col(key).cast("long").alias("doc_id"))
    lists = _lists(common_words(slim.select("language", "text")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = written(measured(slim, lists), "quality-counts").withColumn("base_failed", failed)
    with_reference = rows.join(F.broadcast(references(rows)), F.col("language").eqNullSafe(F.col("_l")), "left").drop("_l")
    with_distances = with_reference.withColumns({
        "char_distance": js_distance(_shares(F.col("chars")), F.col("char_reference")),
        "word_distance": js_distance(_shares(F.col("commons")), F.col("word_reference")),
    })
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    odd_chars = (n_chars >= min_chars) & (F.col("char_distance") > max_char_distance)
    odd_words = (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance)
    odd = F.coalesce(odd_chars, F.lit(False)) | F.coalesce(odd_words, F.lit(False))
    return with_distances.withColumn("kept", ~F.col("base_failed") & ~odd)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance",
    )
