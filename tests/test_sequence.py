import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuslens.operators import sequence


@pytest.fixture
def f3(docs):
    return docs([["a", "b", "a"], ["b", "c"]])


@pytest.fixture
def vocab(f3):
    return sequence.build_vocabulary(f3, 2)


def test_vocabulary(vocab):
    assert {r.token: r.id for r in vocab.collect()} == {"<PAD>": 0, "<UNK>": 1, "<s>": 2, "</s>": 3, "a": 4, "b": 5}
    assert sequence.vocabulary_count(vocab).first()[0] == 6


def test_vocabulary_skips_special_words(docs):
    got = sequence.build_vocabulary(docs([["<s>", "x", "<s>", "x"]]), 1)
    assert {r.token: r.id for r in got.collect()}["x"] == 4 and got.count() == 5


def test_pairs_and_truncation(docs, vocab):
    encoded = sequence.encode(docs([["a", "c"], []]), vocab)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    assert ids == {0: [2, 4, 1, 3], 1: [2, 3]}
    full = {r.doc_id: (r.input_ids, r.target_ids) for r in sequence.training_pairs(encoded).collect()}
    assert full[0] == ([2, 4, 1], [4, 1, 3])
    cut = sequence.training_pairs(encoded, 3).filter("doc_id = 0").first()
    assert cut.ids == [2, 4, 3]
    assert sequence.training_pairs(encoded, 1).filter("doc_id = 0").first().input_ids == [0]
    bare = sequence.training_pairs(sequence.encode(docs([["a"], []]), vocab, start=None, end=None)).orderBy("doc_id").collect()
    assert [(r.input_ids, r.target_ids) for r in bare] == [([0], [0]), ([0], [0])]


def test_decode(spark, vocab, docs):
    ids = spark.createDataFrame([(1, [4, 99])], "doc_id LONG, ids ARRAY<INT>")
    assert sequence.decode(ids, vocab).first().text == "a <UNK>"
    known = docs([["a", "b", "b"], []])
    back = sequence.decode(sequence.encode(known, vocab, start=None, end=None), vocab)
    assert {r.doc_id: r.text for r in back.collect()} == {0: "a b b", 1: ""}
    with pytest.raises(ValueError, match="not built"):
        sequence.decode(ids, None)


def test_batches(docs, vocab):
    df = docs([["a"] * k for k in (1, 4, 2, 3, 5)])
    got = sequence.training_batches(df, vocab, batch_size=2).orderBy("batch_id", "slot").collect()
    assert [(r.batch_id, r.slot, r.doc_id) for r in got] == [(0, 0, 0), (0, 1, 1), (1, 0, 2), (1, 1, 3), (2, 0, 4)]
    assert [len(r.input_ids) for r in got] == [5, 5, 4, 4, 6]
    assert got[0].input_ids == [2, 4, 0, 0, 0] and got[0].target_ids == [4, 3, 0, 0, 0] and got[0].label == 1
    assert sequence.batch_count(df, 2).first().batches == 3
    shuffled = sequence.training_batches(df, vocab, batch_size=2, shuffle_seed=1)
    assert sorted(r.doc_id for r in shuffled.collect()) == [0, 1, 2, 3, 4]


def test_collate(docs, vocab):
    def widths(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch_id": [batch.batch_id.iloc[0]], "cells": [sum(map(len, batch.input_ids))]})

    out = sequence.collate(sequence.training_batches(docs([["a"], ["a", "a"]]), vocab, batch_size=8), widths, "batch_id long, cells long")
    assert out.first().cells == 6


def test_perplexity_weightings(spark):
    rows = [(0, 4, 1.0), (0, 5, 2.0), (0, 6, 3.0), (0, 0, 9.0), (1, 7, 4.0)]
    losses = spark.createDataFrame(rows, "batch_id LONG, target INT, loss DOUBLE")
    assert sequence.sequence_perplexity(losses).first()[0] == pytest.approx(math.exp(2.5))
    assert sequence.sequence_perplexity(losses, "padded_batch").first()[0] == pytest.approx(11.023176, abs=1e-6)
    assert sequence.sequence_perplexity(losses, loss=F.col("loss") * 2).first()[0] == pytest.approx(math.exp(5))
    with pytest.raises(ValueError, match="weighting"):
        sequence.sequence_perplexity(losses, "mean")


def test_missing_words(spark, vocab):
    with pytest.raises(ValueError, match="_words"):
        sequence.encode(spark.range(1).withColumnRenamed("id", "doc_id"), vocab)
