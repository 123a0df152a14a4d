"""The pipeline's stages against brute force, each on the rows of its predecessor."""

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpuslens.llm import decontamination as deco
from corpuslens.llm import pii
from tests.llm.test_jaccard import brute as near_classes
from tests.llm.test_pii import brute as base_spans
from tests.llm.test_quality import brute as base_counts


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf), name)
        out.append(docs.collect())
    return out


def test_quality(stages):
    kept = {r.doc_id: r for r in stages[1]}
    assert set(kept) == {r.doc_id for r in stages[0] if not base_counts(r.text)[-1]}
    before = {r.doc_id: r for r in stages[0]}
    for r in stages[1]:
        assert r.text == before[r.doc_id].text and r.lang == before[r.doc_id].lang and r.n_chars == len(r.text)


def test_near_duplicates(stages):
    rows = [(r.doc_id, r.text) for r in stages[1]]
    assert {r.doc_id for r in stages[2]} == {k for k, _, component in near_classes(rows) if k == component}
    assert len(stages[2]) < len(stages[1])


def test_decontamination(spark, sf, stages):
    items = [deco.folded(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages[3]}
    holds = {r.doc_id for r in stages[2] if any(i in deco.folded(r.text) for i in items)}
    assert holds and kept == {r.doc_id for r in stages[2]} - holds


def test_personal_data(stages):
    before = {r.doc_id: r.text for r in stages[3]}
    assert len(stages[4]) == len(before)
    for r in stages[4]:
        text, spans = before[r.doc_id], base_spans(before[r.doc_id])
        if not spans:
            continue
        assert r.text != text and not base_spans(r.text)
        assert all(f"[{k.upper()}]" in r.text for k in {s[3] for s in spans})
    assert any(r.text != before[r.doc_id] for r in stages[4]) and pii.KINDS


def test_tokens(stages):
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    for r, old in zip(sorted(stages[5], key=lambda r: r.doc_id), sorted(stages[4], key=lambda r: r.doc_id), strict=True):
        assert r.round_trip and r.text == old.text
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4


def test_run(spark, sf, stages):
    out = corpus_pipeline.run(spark, sf)
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in stages[5])


def test_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf), name)
        assert docs.count() == 0


def test_nulls_long_texts_repeated_rows_and_clashing_columns(spark, sf):
    words = " ".join(f"wort{i}" for i in range(60))
    long_text = " ".join(f"w{i}x{i % 97}" for i in range(60_000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, words, "a"), (3, words, "a"), (4, words + " tail", None), (None, words.replace("wort", "mot"), "b"),
        (5, long_text, "b"), (6, "too short", "b"),
    ]
    given = [(*r[:2], "en", r[2], None, i, "kept", "x", 7, "y") for i, r in enumerate(rows)]
    docs = spark.createDataFrame(
        given,
        "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, ids INT, decoded STRING, n_tokens STRING, round_trip INT, word STRING",
    )
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf), name)
        assert docs.columns == names, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in out} in ({3, None, 5}, {4, None, 5}) and len(out) == 3
    for r in out:
        assert r.round_trip is True and r.n_tokens == len(r.ids) // 4 > 0
        assert r.given_decoded == "kept" and r.given_ids in range(8) and r.given_round_trip == 7 and r.word == "y"
    assert next(r for r in out if r.doc_id == 5).text == long_text
