"""The closed-form classifier."""

import math

import pytest

from corpuslens.operators import classify

ROWS = [(1, ["a", "a", "b"], "positive"), (2, ["b", "c"], "negative"), (3, [], "positive"), (4, None, "negative"), (5, ["z", None, "a"], "positive")]


@pytest.mark.parametrize("frequent", [0, 1, 50_000])
def test_frequent_tokens_are_added_up_like_the_others(spark, monkeypatch, frequent):
    monkeypatch.setattr(classify, "FREQUENT", frequent)
    df = spark.createDataFrame(ROWS, "doc_id LONG, _words ARRAY<STRING>, sentiment STRING")
    model = classify.train_counts(df.filter("doc_id < 5"))
    got = {r.doc_id: r.probabilities[1] for r in classify.predict_counts(model, df).collect()}
    counts, tokens = {"a": (2, 0), "b": (1, 1), "c": (0, 1)}, (3, 2)
    for number, words, _ in ROWS:
        odds = 0.0  # two documents of each class
        for word in words or []:
            if word is not None:
                p, n = counts.get(word, (0, 0))
                odds += math.log((p + 1) / (tokens[0] + 3)) - math.log((n + 1) / (tokens[1] + 3))
        assert got[number] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_a_documents_frequent_tokens_are_one_row_of_the_lookup(spark, monkeypatch):
    seen, plain = [], classify.lookup

    def watched(facts, *args, **options):
        seen.append(facts.count())
        return plain(facts, *args, **options)

    monkeypatch.setattr(classify, "lookup", watched)
    df = spark.createDataFrame([(i, [f"w{k}" for k in range(50)], "positive") for i in range(4)], "doc_id LONG, _words ARRAY<STRING>, sentiment STRING")
    classify.predict_counts(classify.train_counts(df), df).count()
    assert seen == [4]


def test_training_sends_as_many_gradients_as_there_are_cores(spark, monkeypatch):
    parts, fit = [], classify.Pipeline.fit
    monkeypatch.setattr(classify.Pipeline, "fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df))
    rows = [(i, ["good" if i % 2 else "bad"], "positive" if i % 2 else "negative") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id LONG, _words ARRAY<STRING>, sentiment STRING").repartition(30)
    out = classify.predict(classify.train(df), df).collect()
    assert parts == [spark.sparkContext.defaultParallelism] and all(r.prediction == r.label for r in out)
