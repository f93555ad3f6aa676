"""The pipeline: stages in order, columns kept, decisions take effect, awkward tables pass through."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from numerant.llm import near_dedup, pieces, sharding
from numerant.llm.exact_dedup import SPACES
from test_operators import SCHEMA, awkward_rows

SF_DIR = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if name != "sentencepiece":
            assert docs.columns == columns
        if name == "exact_dedup":
            texts = [r.text.translate(dict.fromkeys(map(ord, SPACES))) for r in docs.collect()]
            assert len(set(texts)) == len(texts)
        if name == "minhash_near_dedup":
            assert near_dedup.classes(docs).where("class_size > 1").count() == 0
    assert counts[0] > counts[1] > counts[2] > counts[3] and docs.where("not round_trip").count() == 0


@pytest.mark.parametrize("rows", [awkward_rows(), []])
def test_awkward_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.STAGES[1][1](spark, spark.read.parquet(str(tmp_path / "documents.parquet")), SF_DIR)
    assert found.count() == (12 if rows else 0)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), SF_DIR).columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")


CLASHES = "_row_number _text _key _mark _start _all _times _time _place doc times time row key size digest text_read key_read mark many bucket at score difference word".split()


def test_clashing_columns_stay(spark, tmp_path):
    """Whatever the stages add on the way, columns of the same names pass through."""
    rows = [(*r[:5], *(f"{c}-{i}" for c in CLASHES)) for i, r in enumerate(awkward_rows())]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES)
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, docs, SF_DIR)
        assert found.columns == docs.columns and {tuple(r) for r in found.collect()} <= set(rows)
    assert {r.doc_id for r in corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR).collect()} == {r[0] for r in rows}
    coded = pieces.encoded(docs).collect()
    assert {tuple(r)[: len(docs.columns)] for r in coded} == set(rows)
    kept = sharding.sharded(sharding.shuffled(docs)).collect()
    assert len(kept) == len(rows) and {(r.doc_id, r._mark, r._start, r._all, r.mark) for r in kept} == {(r[0], *(r[5 + CLASHES.index(c)] for c in ("_mark", "_start", "_all", "mark"))) for r in rows}


def test_awkward_rows_are_computed(spark, tmp_path):
    spark.createDataFrame(awkward_rows(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), SF_DIR).collect()
        assert found and {r.doc_id for r in found} <= {r[0] for r in awkward_rows()}
