"""Each stage of the pipeline against a plain version, on awkward rows."""

import numpy as np
import pytest

import corpus_pipeline
from headerflow.llm import bpe, quality

from .data import PLAIN, awkward, frame, tables
from .test_operators import ITEMS, reference_components, reference_substring

ROWS = [*awkward(), (900, "So " + ITEMS[0][1] + " and so on"), (901, "clean words only " * 3)]
LABELS = [(i, int(i % 5 > 0), 0) for i, _ in ROWS]
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("p"), ROWS, LABELS, ITEMS)


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "encoding"]


def test_quality(spark, folder):
    docs = frame(spark, ROWS)
    model = quality.quality_model(spark, docs, folder)
    score = model.score([(t or "").encode() for _, t in ROWS])
    want = {i for (i, _), s in zip(ROWS, score, strict=True) if s >= quality.ACCEPT}
    out = STAGE["quality"](spark, docs, folder)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == want


def test_near_duplicates(spark, folder):
    docs = frame(spark, [*ROWS, ROWS[5], (None, "no id"), (None, None)], extra=True)
    out = STAGE["near_duplicates"](spark, docs, folder)
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
    want = sorted([(False, i) for i, (_, _, kept) in reference_components(ROWS).items() if kept] + [(True, 0)] * 2)
    assert out.columns == docs.columns and got == want


def test_substrings(spark, folder):
    docs = frame(spark, ROWS, extra=True)
    out = STAGE["substrings"](spark, docs, folder)
    gone = {i: n for i, _, n, _ in reference_substring(ROWS)}
    assert out.columns == docs.columns
    for r in out.collect():
        before = dict(ROWS)[r.doc_id]
        if not gone[r.doc_id]:
            assert r.text == before
        else:
            assert len(r.text.split()) == len(before.split()) - gone[r.doc_id] and r.n_chars == len(r.text)


def test_decontamination(spark, folder):
    out = STAGE["decontamination"](spark, frame(spark, ROWS, extra=True), folder)
    assert {i for i, _ in ROWS} - {r.doc_id for r in out.collect()} == {900}


def test_decontamination_of_rows_without_id(spark, folder):
    leak = dict(ROWS)[900]
    rows = [(None, leak), (None, "clean and without id"), (None, None), (900, leak), (900, "clean and of the same id")]
    out = STAGE["decontamination"](spark, frame(spark, rows, extra=True), folder)
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, ""), (0, "clean and without id"), (900, "clean and of the same id")]


def test_encoding(spark, folder):
    got = {r.doc_id: r for r in STAGE["encoding"](spark, frame(spark, ROWS), folder).collect()}
    encoder, _ = bpe.coder(bpe.vocabulary())
    for i, t in ROWS:
        ids = encoder.encode(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids) // 4


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and 900 not in ids and 901 in ids
    assert all(len(np.frombuffer(r.ids, "<u4")) == r.n_tokens for r in rows)


def test_empty(spark, folder):
    docs = spark.createDataFrame([], PLAIN)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []

