"""Line deduplication with a tree of log templates.

A line's words that hold a digit are variable. The tree has a fixed depth: lines are parsed by their number of words,
then by their first ``LEAD`` words. Below, at a leaf, a word is part of the template at its place if at least ``MIN_DOCS``
lines of the leaf have it there; other places are variable fields. If fewer than ``CONSTANT`` of the
places stay, the line is too unlike the others, and its template is its own words.

A template found in at least ``MIN_DOCS`` documents recurs, and so does a line whose own words, digits included, are those of
a line of another document: a template without fields, whatever its length. Its lines are dropped from every document but
the first (smallest key), so that what near copies have in common is kept once.

Everything is counts: lines of leaves with fewer than MIN_DOCS lines have no template with fields and leave the tree at once;
equal lines meet as one row with a number, or as digests of 128 bits; no leaf or template is collected anywhere.

Defined results: a null text is one empty line; blank lines are kept; lines of fewer than ``MIN_WORDS`` words have no template but their
own words; a null key comes last; a document that repeats a line counts once for its template; repeated rows are
separate documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .common import ROW, forget, numbered, slices, table, text_of, written

LEAD = 3
MIN_WORDS = 3
MIN_DOCS = 3
CONSTANT = 0.6
ANY = "<*>"
HAS_DIGIT = re.compile(rb"[0-9]").search


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def masked(line: bytes) -> list[bytes]:
    """The words of a line, those with a digit as variable."""
    words = line.split()  # at ASCII white space
    return [b"<*>" if HAS_DIGIT(w) else w for w in words] if HAS_DIGIT(line) else words


def _slim(docs: DataFrame, key: str, text: str) -> DataFrame:
    return numbered(docs.select(key, text)).select(F.col(ROW).alias("row"), F.col(key).cast("long").alias("key"), text_of(text).alias("text"))


def surveyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One reading of the texts: rows with n, lead, m (lines of a leaf, added up in each task) and rows with row, key, line, words (digest)."""
    from_leaf, from_line = [pa.int32(), pa.string(), pa.int64()], [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["n", "lead", "m", "row", "key", "line", "words"]

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            made = [[k[0] for k in counts], [k[1].decode() for k in counts], list(counts.values())]
            arrays = [pa.array(x, t) for x, t in zip(made, from_leaf)] + [pa.nulls(len(counts), t) for t in from_line]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for row, key_, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    for i, line in enumerate(t.as_py().encode().split(b"\n")):
                        own = line.split()
                        if own:
                            rows.append((row, key_, i, blake2b(b" ".join(own), digest_size=16).digest()))
                        if len(own) >= MIN_WORDS:
                            counts[len(own), b" ".join(masked(line)[:LEAD])] += 1
                    if len(counts) > 200_000:
                        yield flushed()
                arrays = [pa.nulls(len(rows), t) for t in from_leaf] + [pa.array([r[i] for r in rows], t) for i, t in enumerate(from_line)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        yield flushed()

    return _slim(docs, key, text).mapInArrow(survey, "n int, lead string, m long, row long, key long, line int, words binary")


def parsed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row, key, line (its number), n, lead, masked (its words): the way of each line down the tree."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "key", "line", "n", "lead", "masked"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for row, key_, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    for i, line in enumerate(t.as_py().encode().split(b"\n")):
                        words = masked(line)
                        if len(words) >= MIN_WORDS:
                            rows.append((row, key_, i, len(words), b" ".join(words[:LEAD]).decode(), b" ".join(words).decode()))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return _slim(docs, key, text).mapInArrow(parse, "row long, key long, line int, n int, lead string, masked string")


def templates(busy: DataFrame, min_docs: int = MIN_DOCS, constant: float = CONSTANT) -> DataFrame:
    """mark (of a line's masked words), template: for the lines of busy leaves, written before."""
    lines = busy.groupBy("mark").agg(F.first("masked").alias("masked"), F.first("n").alias("n"), F.first("lead").alias("lead"), F.count("*").alias("lines"))
    lines = written(lines, "line-distinct")
    places = lines.select("mark", "n", "lead", "lines", F.posexplode(F.split("masked", " ")).alias("at", "word"))
    common = places.groupBy("n", "lead", "at", "word").agg(F.sum("lines").alias("m")).where(F.col("m") >= min_docs)
    common = written(common.drop("m"), "line-common")  # both sides of the join are exchanged then, so a full leaf can be split
    found = places.join(common.withColumn("stays", F.lit(True)), ["n", "lead", "at", "word"], "left")
    stays = F.col("stays").isNotNull() & (F.col("word") != ANY)
    field = F.struct("at", F.when(stays, F.col("word")).otherwise(ANY).alias("word"))
    merged = found.groupBy("mark").agg(F.sort_array(F.collect_list(field)).alias("fields"), F.avg(stays.cast("int")).alias("share"))
    text = F.concat_ws(" ", F.transform("fields", lambda f: f["word"]))
    return merged.select("mark", F.when(F.col("share") >= constant, F.md5(text)).otherwise(F.col("mark")).alias("template"))


def recurring(lines: DataFrame, mark: str, least: int) -> DataFrame:
    """row, line: the lines whose ``mark`` is in ``least`` documents or more, but for those of the first one. ``lines`` is written."""
    once = lines.groupBy(mark, "row").agg(F.first("key").alias("key"))
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row"))["row"].alias("first_row")
    found = once.groupBy(mark).agg(F.count("*").alias("docs"), first).where(F.col("docs") >= least)
    found = written(found.select(mark, "first_row"), "line-recurring")  # both sides are exchanged then, so a frequent mark's lines can be split
    return lines.join(found, mark).where("row != first_row").select("row", "line")


def dropped(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, constant: float = CONSTANT) -> DataFrame:
    """row, line: the lines to drop."""
    seen = written(surveyed(docs, key, text), "line-survey")
    equal = written(recurring(seen.where("n is null").select("row", "key", "line", "words"), "words", 2), "line-equal")
    leaves = written(seen.where("n is not null").groupBy("n", "lead").agg(F.sum("m").alias("m")).where(F.col("m") >= min_docs).select("n", "lead"), "line-leaves")
    forget(seen)
    busy = parsed(docs, key, text).join(broadcast_if_small(leaves), ["n", "lead"])
    busy = written(busy.withColumn("mark", F.md5("masked")), "line-busy")
    of_line = written(templates(busy, min_docs, constant), "line-templates")
    slim = busy.select("row", "key", "line", "mark").join(of_line, "mark").select("row", "key", "line", "template")
    slim = written(slim, "line-marked")
    forget(busy, of_line, leaves)
    return equal.union(recurring(slim, "template", min_docs)).distinct()


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, constant: float = CONSTANT) -> DataFrame:
    """key, text without recurring lines, n_lines, n_dropped; every document."""
    gone = dropped(docs, key, text, min_docs, constant).groupBy("row").agg(F.collect_list("line").alias("gone"))
    gone = written(gone, "line-dropped").withColumnRenamed("row", ROW)
    base = numbered(docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))).join(gone.hint("shuffle_merge"), ROW, "left")
    base = base.withColumn("lines", lines_of(F.col("text")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.concat_ws("\n", F.transform(stay, lambda i: F.get("lines", i)))
    return base.select(
        "key", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicated(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, t.line, t.i AS line_no
  FROM documents, LATERAL (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i) t
), p AS (
  SELECT doc_id, line, line_no, [CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END FOR w IN regexp_extract_all(line, '[^\x20\x09-\x0D]+')] AS words FROM l
), b AS (
  SELECT *, len(words) AS n, words[1:3] AS head FROM p WHERE len(words) >= 3
), d AS (
  SELECT words, any_value(n) AS n, any_value(head) AS head, count(*) AS lines FROM b GROUP BY words
), e AS (
  SELECT words, n, head, lines, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d
), c AS (
  SELECT n, head, pos, word FROM e GROUP BY ALL HAVING sum(lines) >= 3
), f AS (
  SELECT e.words, e.pos, CASE WHEN c.word IS NOT NULL AND e.word <> '<*>' THEN e.word ELSE '<*>' END AS field
  FROM e LEFT JOIN c ON e.n = c.n AND e.head = c.head AND e.pos = c.pos AND e.word = c.word
), t AS (
  SELECT words, CASE WHEN avg((field <> '<*>')::int) >= 0.6 THEN list(field ORDER BY pos) ELSE words END AS template FROM f GROUP BY words
), m AS (
  SELECT b.doc_id, b.line_no, t.template FROM b JOIN t ON b.words = t.words
), r AS (
  SELECT template, min(doc_id) AS first_doc FROM m GROUP BY template HAVING count(DISTINCT doc_id) >= 3
), o AS (
  SELECT doc_id, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS own FROM l
), q AS (
  SELECT own, min(doc_id) AS first_doc FROM o WHERE len(own) > 0 GROUP BY own HAVING count(DISTINCT doc_id) >= 2
), g AS (
  SELECT m.doc_id, m.line_no FROM m JOIN r ON m.template = r.template WHERE m.doc_id <> r.first_doc
  UNION SELECT o.doc_id, o.line_no FROM o JOIN q ON o.own = q.own WHERE o.doc_id <> q.first_doc
), k AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.line_no) AS n_dropped,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL), '') AS kept
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.line_no = g.line_no GROUP BY l.doc_id
)
SELECT doc_id, n_lines, n_dropped, length(kept) AS kept_chars, md5(kept) AS kept_md5 FROM k
"""
