import pytest
from pyspark.sql import functions as F

from corpuslens.operators import stats
from corpuslens.operators.corpus import tokenise
from corpuslens.plans.report import corpus_report


def rows(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_null_class_counts_in_overall_only(f1):
    got = stats.word_frequency(tokenise(f1)).filter("token = 'ok'")
    assert rows(got, "scope", "cnt") == {("overall", 2)}
    assert rows(stats.class_distribution(f1), "sentiment", "cnt") == {("positive", 2), ("negative", 2)}


def test_length_stats(f1):
    got = {(r.stat, r.scope): r.value for r in stats.length_stats(tokenise(f1)).collect()}
    assert got[("average_word_count", "overall")] == pytest.approx((7 + 2 + 0 + 2 + 3) / 5)
    assert got[("median_word_count", "overall")] == 2
    assert got[("median_word_count", "negative")] == 2.5
    assert {s for _, s in got} == {"overall", "positive", "negative"}


def test_ngrams_of_short_documents(docs):
    table = stats.gram_table(docs([["a", "b", "c"], ["a"], []]), (2,))
    assert {(tuple(r.gram), r.overall) for r in table.collect()} == {(("a", "b"), 1), (("b", "c"), 1)}
    three = stats.gram_table(docs([["a", "b", "c"], ["a"], []]), (1, 2, 3))
    assert {(r.n, " ".join(r.gram), r.positive) for r in three.collect()} == {
        (1, "a", 2), (1, "b", 1), (1, "c", 1), (2, "a b", 1), (2, "b c", 1), (3, "a b c", 1),
    }
    alike = stats.gram_table(docs([["a b", "c"], ["a", "b c"]]), (2,))
    assert {tuple(r.gram) for r in alike.collect()} == {("a b", "c"), ("a", "b c")}


def test_tie_rules(docs):
    df = docs([["z", "y", "x", "x"], ["y", "z"]])
    by_name = stats.top_words(df, 2).filter("scope = 'overall'")
    first = stats.top_words(df, 2, ties="first_seen").filter("scope = 'overall'")
    assert [r.token for r in by_name.orderBy("rank").collect()] == ["x", "y"]
    assert [r.token for r in first.orderBy("rank").collect()] == ["z", "y"]
    with pytest.raises(ValueError, match="ties"):
        stats.top_words(df, ties="random")


def test_first_seen_spans_documents_by_id(spark):
    df = spark.createDataFrame([(9, ["a", "b"], None), (10, ["b", "a"], None)], "doc_id LONG, _words ARRAY<STRING>, sentiment STRING")
    top = stats.top_words(df.repartition(2), 1, ties="first_seen").first()
    assert (top.scope, top.token) == ("overall", "a")


def test_missing_words_column(f1):
    with pytest.raises(ValueError, match="_words"):
        stats.word_frequency(f1)


def test_log_odds_by_hand(spark):
    import math

    terms = spark.createDataFrame([("a", 3, 1), ("b", 1, 3), ("c", 2, 2)], "term STRING, positive LONG, negative LONG")
    got = {r.term: r.z for r in stats.log_odds(terms, alpha=0.5).collect()}
    a0 = 1.5
    z = (math.log(3.5 / (6 + a0 - 3.5)) - math.log(1.5 / (6 + a0 - 1.5))) / math.sqrt(1 / 3.5 + 1 / 1.5)
    assert got["a"] == pytest.approx(z) and got["b"] == pytest.approx(-z) and got["c"] == 0
    picked = stats.significant_words(stats.log_odds(terms, alpha=0.5), 1)
    assert rows(picked, "scope", "term") == {("positive", "a"), ("negative", "b")}


def test_word_cloud(docs):
    words = stats.word_frequency(docs([["film", "film", "plot", "the", "ok"]]))
    got = stats.word_cloud(words)
    assert rows(got, "scope", "token", "weight") == {("positive", "film", 1.0), ("positive", "plot", 0.5)}


def test_term_scatter(spark):
    terms = spark.createDataFrame([("a", 63, 0), ("b", 0, 63), ("c", 7, 63), ("rare", 1, 1)], "term STRING, positive LONG, negative LONG")
    got = {r.term: (round(r.x, 6), round(r.y, 6)) for r in stats.term_scatter(terms).collect()}
    assert got == {"a": (1.0, 0.0), "b": (0.0, 1.0), "c": (0.5, 1.0)}
    alone = stats.term_scatter(terms.filter("term = 'a'")).first()
    assert (alone.x, alone.y) == (0.0, 0.0)


def test_report_holds_every_statistic(f1):
    got = rows(corpus_report(tokenise(f1)), "stat")
    assert got == {
        (s,) for s in (
            "class_distribution", "average_text_length", "median_text_length", "average_word_count", "median_word_count",
            "vocabulary_size", "most_frequent_words", "2_gram_frequency", "3_gram_frequency", "most_significant_words",
            "4_gram_frequency",
        )
    }


def test_unigram_bigram_terms(docs):
    got = stats.term_frequency(docs([["a", "b"], ["a"]]), "unigram+bigram")
    assert rows(got, "term", "positive", "negative") == {("a", 2, 0), ("b", 1, 0), ("a b", 1, 0)}
    with pytest.raises(ValueError, match="terms"):
        stats.term_frequency(docs([["a"]]), "trigram")


def test_hot_token(spark):
    """One word holds over a third of the corpus; the counts stay whole."""
    df = spark.range(200).select(
        F.col("id").alias("doc_id"), F.lit("positive").alias("sentiment"),
        F.concat(F.array_repeat(F.lit("the"), 50), F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: i.cast("string"))).alias("_words"),
    )
    got = {r.gram[0]: r.overall for r in stats.gram_table(df).collect()}
    assert got["the"] == 10_000 and got["17"] == 200 and len(got) == 51
