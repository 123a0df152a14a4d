"""Registered queries against their SQL on the smallest tables."""

import pytest

from tests.compare import connect, difference
from workload.oracle import all_sql
from workload.queries import QUERIES

SOME = [
    "s01_review_csv_round_trip", "p01_remove_break_tags", "p03_full_cleaning", "p07_lemmatise_words", "t03_wordpiece_ids", "t05_subword_vocabulary",
    "m02_ratio_split", "m03_selected_test", "j07_weighted_draw", "a02_mean_text_length", "a06_word_frequency_all_documents",
    "a08_top_words_first_seen", "a09_top_ngrams", "a12_significant_words", "a14_term_scatter", "a15_corpus_report",
    "l05_laplace_probability", "l07_perplexity_laplace", "v01_vocabulary", "v06_padded_batches", "v09_padded_batch_perplexity",
    "s01_review_csv_in_splits", "s02_bucketed_corpus_join", "p07_lemmatise_by_rules", "t03_merge_ids", "t04_unigram_expectation",
    "t05_learned_merges", "t07_merge_distribution", "c01_regression_optimum", "s07_regression_persistence",
    "e05_metrics_per_split", "g02_pairwise_agreement", "k04_resolved_responses", "u02_custom_collate",
]


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", SOME)
def test_same_rows_as_sql(spark, sf, db, name):
    assert difference(QUERIES[name](spark, sf), db.execute(all_sql()[name])) is None


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == ["scope", "rank", "token", "cnt"] and out.count() == 30
