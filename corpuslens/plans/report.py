"""Whole-corpus report: every statistic as one long table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import stats
from corpuslens.session import materialise

SIZES = (2, 3, 4)


def corpus_report(tokens: DataFrame, k: int = 10, alpha: float = 0.01) -> DataFrame:
    """``(stat, scope, key, value)`` for class balance, lengths, vocabulary, top words,
    top n-grams and the most significant words.

    The tokens are written once and read from there. The table of words is written too and feeds
    everything on words; of longer grams only those that can be among the top ones are counted by gram.
    """
    tokens = materialise(tokens.select("sentiment", "_words", "_word_count", "_char_len"), "report-tokens")
    words = materialise(stats.gram_table(tokens, (1,)), "report-words")
    grams = words.unionByName(stats.frequent_grams(tokens, SIZES, k))
    no_key = F.lit(None).cast("string").alias("key")
    top = stats.top_grams(stats.by_scope(grams), k)
    name = F.when(F.col("n") == 1, "most_frequent_words").otherwise(
        F.concat(F.col("n").cast("string"), F.lit("_gram_frequency"))
    )
    significant = stats.significant_words(stats.log_odds(stats.class_terms(words), alpha), k)
    parts = [
        stats.class_distribution(tokens).select(
            F.lit("class_distribution").alias("stat"), F.col("sentiment").alias("scope"), no_key,
            F.col("cnt").cast("double").alias("value"),
        ),
        stats.length_stats(tokens).select("stat", "scope", no_key, "value"),
        stats.vocabulary_size(words).select(
            F.lit("vocabulary_size").alias("stat"), "scope", no_key, F.col("vocabulary_size").cast("double").alias("value")
        ),
        top.select(name.alias("stat"), "scope", stats.shown("gram").alias("key"), F.col("cnt").cast("double").alias("value")),
        significant.select(
            F.lit("most_significant_words").alias("stat"), "scope", F.col("term").alias("key"), F.col("z").alias("value")
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
