"""The selection of grams that can be among the most frequent, and events as arrays."""

import random

import pytest

from corpuslens.operators import ngram, stats
from workload import queries


def corpus(spark, seed, rows=60, letters="abcd"):
    rng = random.Random(seed)
    data = [
        (i, rng.choices(letters, k=rng.randint(0, 30)), rng.choice(["positive", "negative", None])) for i in range(rows)
    ]
    return spark.createDataFrame([*data, (99, None, "positive")], "doc_id LONG, _words ARRAY<STRING>, sentiment STRING")


@pytest.mark.parametrize("buckets, fullest, most", [(1 << 20, 2000, 1000), (16, 2, 1000), (64, 1, 3), (64, 3, 0)])
@pytest.mark.parametrize("ties", ["alphabetical", "first_seen"])
def test_top_grams_of_the_selection_are_those_of_all(spark, monkeypatch, buckets, fullest, most, ties):
    for name, value in (("GRAM_BUCKETS", buckets), ("FULLEST_BUCKETS", fullest), ("MOST_BUCKETS", most)):
        monkeypatch.setattr(stats, name, value)
    df, first = corpus(spark, buckets), ties == "first_seen"
    whole = stats.top_grams(stats.by_scope(stats.gram_table(df, (2, 3, 4), first_seen=first)), 10, ties)
    got = stats.top_ngrams(df, (2, 3, 4), 10, ties=ties)
    assert sorted(got.collect()) == sorted(whole.collect())


def test_few_grams_are_shuffled(spark, monkeypatch):
    """Grams that cannot be among the top ones are counted by bucket only."""
    monkeypatch.setattr(stats, "FULLEST_BUCKETS", 5)
    rng = random.Random(3)
    rows = [(i, ["a", "b", "a", "c"] * 5 + [str(rng.random()) for _ in range(50)], "positive") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id LONG, _words ARRAY<STRING>, sentiment STRING")
    assert stats.gram_table(df, (2, 3)).count() > 2000
    few = stats.frequent_grams(df, (2, 3), 3)
    assert few.count() <= 40
    top = stats.top_grams(stats.by_scope(few), 3).filter("scope = 'overall' AND n = 2").orderBy("rank").collect()
    assert [(r.gram, r.cnt) for r in top] == [(["a", "b"], 100), (["a", "c"], 100), (["b", "a"], 100)]


def test_event_arrays_hold_the_events(spark):
    df = corpus(spark, 7).dropDuplicates(["doc_id"])
    for sizes in ((2,), (1, 3), (2, 3)):
        each = ngram.events(df, sizes, "doc_id").collect()
        arrays = ngram.event_arrays(df, sizes, "doc_id").collect()
        unrolled = [(r.doc_id, r.n, e.context, e.word) for r in arrays for e in r.events]
        assert sorted(map(repr, unrolled)) == sorted(repr(tuple(r)) for r in each)


def test_padded_events_are_not_sorted_by_document(spark, sf):
    """The events of a document are digested where they are: no row per event reaches the aggregation."""
    plan = queries.QUERIES["l01_padded_events"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan
