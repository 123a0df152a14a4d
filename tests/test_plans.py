"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import agreement, ngram, sampling, sequence, stats
from corpuslens.operators.corpus import tokenise
from corpuslens.sources.tables import reviews
from workload import queries as q

NATIVE = [
    "p03_full_cleaning", "t02_word_punct_tokens", "t03_wordpiece_ids", "a05_median_word_count", "a08_top_words", "a09_top_ngrams",
    "a11_log_odds", "a14_term_scatter", "l02_ngram_counts", "l05_laplace_probability", "v02_encoded_documents", "g02_pairwise_agreement",
    "k04_resolved_responses", "e05_metrics_per_split", "m02_ratio_split",
]


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_pair_products(spark, sf, name):
    text = plan(q.QUERIES[name](spark, sf))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_scan_reads_two_columns(spark, sf):
    text = plan(tokenise(reviews(spark, sf)).select("doc_id", "_words"))
    assert "struct<doc_id:bigint,text:string>" in text and "PushedFilters: [IsNotNull(doc_id)]" in text


def test_cleaning_is_evaluated_once(spark, sf):
    text = plan(stats.gram_table(tokenise(reviews(spark, sf)), (1, 2)))
    assert text.count("<br") == 1 and text.count("split(") == 1
    assert not re.search(r"Condition : .*size\(", text)


def test_gram_counts_shuffle_once_after_a_partial_count(spark, sf):
    text = plan(stats.gram_table(tokenise(reviews(spark, sf)), (1, 2, 3)))
    assert "partial_count(1)" in text
    assert len(re.findall(r"Arguments: hashpartitioning\(n#", text)) == 1


def test_top_k_is_limited_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(q.a08_top_words(spark, sf))


def test_sample_moves_no_text(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    text = plan(sampling.sample_reviews(df, 50))
    assert "Exchange" not in text and "Sort" not in text


def test_agreement_is_one_aggregation(spark, sf):
    text = plan(agreement.pairwise_agreement(q.rated(spark, sf)))
    assert text.count("Keys: []") == 2  # partial and final


def test_no_window_over_everything(spark, sf):
    """Windows without a partition run over counts per bucket only, never over rows."""
    vocab = sequence.build_vocabulary(tokenise(reviews(spark, sf)), 5)
    ranked = sampling.epoch_order(reviews(spark, sf).select("doc_id"), 42, 0)
    for df in (vocab, ranked):
        for window in re.findall(r"Window\n.*?Arguments: .*", plan(df)):
            assert "_part" in window or "partition" not in window


def test_registered_names_match():
    from workload.oracle import BODIES

    assert set(BODIES) <= set(q.QUERIES)


def test_perplexity_joins_have_unique_keys(spark, sf):
    df = tokenise(reviews(spark, sf))
    model = ngram.fit(df, (2,))
    for table, keys in ((model.counts, ["n", "context", "word"]), (model.totals, ["n", "context"])):
        assert table.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty()


def test_bucketed_tables_meet_without_an_exchange(spark, sf):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = q.s02_bucketed_corpus_join(spark, sf)
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert joined.count() == spark.read.parquet(f"{sf}/labels.parquet").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("name", ["v02_encoded_documents", "v07_decoded_documents", "l05_laplace_probability", "j07_weighted_draw"])
def test_every_input_is_cleaned_once_for_what_it_feeds(spark, sf, monkeypatch, name):
    """Of all plans that a query runs, tables written on the way included, one cleans texts for the model and one what is looked up."""
    from pyspark.sql import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet

    def spied(self, path, *args, **kwargs):
        plans.append(plan(self._df))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    plans.append(plan(q.QUERIES[name](spark, sf)))
    cleaned = sum(text.count("<br") for text in plans)
    assert cleaned <= 2 and all(text.count("<br") <= 1 for text in plans)


def test_a_step_of_few_sentences_moves_no_draw_table(spark, sf):
    model = ngram.fit(tokenise(reviews(spark, sf)), (2,))
    table = ngram.draw_table(model, 2)
    state = q.materialise(table.contexts.limit(50).withColumn("sent_id", F.monotonically_increasing_id()), "few-sentences")
    text = plan(ngram._step(table, state, F.lit(0.5)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "hashpartitioning" not in text
