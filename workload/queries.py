"""Registered queries: every operator run over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions import labels, text
from corpuslens.functions.seeded import order_key, uniform
from corpuslens.operators import (
    agreement,
    classify,
    judge,
    merges,
    metrics,
    ngram,
    sampling,
    sequence,
    stats,
    subword,
    unigram,
    wordforms,
)
from corpuslens.operators.corpus import length_summary, load_corpus, tokenise
from corpuslens.operators.lookup import lookup, salt_of
from corpuslens.plans.evaluation import evaluate_classifier
from corpuslens.plans.language_models import compare_sizes, sample_sentences
from corpuslens.plans.report import corpus_report
from corpuslens.schema import EVALUATION
from corpuslens.session import fresh_path, materialise
from corpuslens.sources import files
from corpuslens.schema import require_columns
from corpuslens.sources import tables
from corpuslens.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIN_FREQ = 5
BATCH = 32
MAX_LENGTH = 128
SAMPLE = 100
ROLES = ("user", "assistant", "system")
# Words of the tables, and what stands in for them where cleaning is checked.
FORMS = (
    ("the", "won't"), ("of", "it's"), ("and", "they've<br />"), ("in", "gonna"), ("to", "dog's"), ("a", "I’m"), ("on", "y'all can't"),
    ("que", "we'd"), ("de", "o'clock<br>"), ("der", "aren't"), ("die", "she'll"), ("le", "lemme let's"),
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def joined(c: Column | str) -> Column:
    return F.concat_ws(",", F.transform(c, lambda x: x.cast("string")))


def shown(df: DataFrame) -> DataFrame:
    """Contexts as text, for results that are compared with SQL."""
    return df.withColumn("context", F.array_join("context", " "))


# ---- inputs shared by the queries ----------------------------------------------

# The driver's tables are single files, so the text is dealt to all cores, in shares of bounded size.


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return tables.reviews(spark, sf, tables.parts_of(spark, sf, "documents"))


def reviews_all(spark: SparkSession, sf: str) -> DataFrame:
    return tables.reviews_all(spark, sf, tables.parts_of(spark, sf, "documents"))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return tables.turns(spark, sf, tables.parts_of(spark, sf, "conversations"))


def with_forms(c: Column) -> Column:
    """Text with contractions, slang and tags in place of frequent words, which the tables lack."""
    for word, form in FORMS:
        c = F.replace(c, F.lit(f" {word} "), F.lit(f" {form} "))
    return c


def words(spark: SparkSession, sf: str) -> DataFrame:
    return tokenise(reviews(spark, sf))


def split_words(spark: SparkSession, sf: str) -> DataFrame:
    return tokenise(sampling.assign_split(reviews(spark, sf)))


def in_split(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)


def fitted(spark: SparkSession, sf: str, laplace: bool = True) -> tuple[ngram.NGramModel, DataFrame]:
    """Model of the train split, and the test split."""
    df = split_words(spark, sf)
    return ngram.fit(in_split(df, "train"), (2, 3), laplace=laplace), in_split(df, "test")


def digit(salt: str, place: int = 1) -> Column:
    return F.substring(order_key(salt, F.col("doc_id")), place, 1)


def rated(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with stand-in raters derived from the label table."""
    toxic = table(spark, sf, "labels").select("doc_id", "toxic")
    gold = F.col("sentiment")
    opposite = F.when(gold == "positive", "negative").otherwise("positive")
    return reviews(spark, sf).join(toxic, "doc_id").select(
        "doc_id",
        "review",
        gold.alias("gold_label"),
        F.when(F.col("toxic") == 1, "negative").otherwise("positive").alias("model_prediction"),
        F.when(digit("judge") < "c", gold).otherwise(opposite).alias("llm_judge"),
        F.when(digit("human") < "4", gold).alias("human_rating"),
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with split, label, prediction and a two-class score."""
    toxic = table(spark, sf, "labels").select("doc_id", "toxic")
    df = sampling.select_test(sampling.assign_split(reviews(spark, sf)), SAMPLE // 4)
    p = F.round(uniform("score", F.col("doc_id")), 9) * 0.98 + 0.01
    return df.join(toxic, "doc_id").select(
        "doc_id",
        "review",
        "split",
        "selected",
        labels.encode_label(F.col("sentiment")).alias("label"),
        (1 - F.col("toxic")).alias("prediction"),
        F.array(1 - p, p).alias("probabilities"),
    )


def with_loss(df: DataFrame) -> DataFrame:
    return df.withColumn("loss", labels.cross_entropy(F.col("probabilities"), F.col("label")))


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Judge answers of several wordings, some of them the review itself."""
    d = digit("answer")
    return reviews(spark, sf).select(
        "doc_id",
        F.when(d < "3", "Positive.")
        .when(d < "6", "NEGATIVE!")
        .when(d == "6", "neg, then positive")
        .when(d == "7", "pos")
        .when(d == "8", " Posh negative")
        .when(d == "9", "")
        .otherwise(F.col("review"))
        .alias("answer"),
    )


def response_log(spark: SparkSession, sf: str) -> DataFrame:
    """Up to four logged attempts per review; an attempt follows only a rate limit."""
    attempts = F.explode(F.sequence(F.lit(1), F.lit(4))).alias("attempt")
    code = F.substring(F.col("h"), F.col("attempt"), F.lit(1))
    reached = F.forall(
        F.sequence(F.lit(0), F.col("attempt") - 1), lambda i: (i == 0) | F.substring(F.col("h"), i, F.lit(1)).between("8", "c")
    )
    status = F.when(code < "8", 200).when(code < "d", 429).when(code == "d", 500).when(code == "e", 402)
    content = F.concat(F.initcap("llm_judge"), F.lit("."))
    body = F.concat(F.lit('{"choices":[{"message":{"content":"'), content, F.lit('"}}]}'))
    base = rated(spark, sf).select("doc_id", "llm_judge", order_key("log", F.col("doc_id")).alias("h"))
    return (
        base.select("*", attempts)
        .filter(reached)
        .select("doc_id", "attempt", status.alias("status"), F.when(status == 200, body).alias("body"))
    )


def vocabulary(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vocabulary of the train split, and the whole split corpus."""
    df = split_words(spark, sf)
    return sequence.build_vocabulary(in_split(df, "train"), MIN_FREQ), df


def lemmas_of(df: DataFrame) -> DataFrame:
    """Stand-in lemma table: a word ending in s reads as the word without it, if the corpus has that word."""
    found = wordforms.distinct_words(df)
    plain = found.select(F.col("token").alias("lemma"))
    plural = found.filter(F.col("token").endswith("s")).select(
        F.col("token").alias("form"), F.expr("substring(token, 1, char_length(token) - 1)").alias("lemma")
    )
    return plural.join(plain, "lemma", "left_semi").select("form", "lemma")


# ---- sources and sinks ---------------------------------------------------------


@query
def s01_review_csv_round_trip(spark, sf):
    path = fresh_path(spark, "reviews-csv")
    files.write_reviews(reviews(spark, sf), path)
    return files.read_reviews(spark, path)


@query
def s01_review_csv_in_splits(spark, sf):
    """The same round trip, read line by line and put together by the parity of quotes."""
    path = fresh_path(spark, "reviews-csv")
    files.write_reviews(reviews(spark, sf), path)
    return files.read_reviews(spark, path, in_splits=True)


@query
def s02_save_processed_corpus(spark, sf):
    path = fresh_path(spark, "processed")
    files.save_corpus(words(spark, sf), path, words_as_text=True)
    return spark.read.parquet(path)


def _bucketed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Processed reviews and a gold label for each, in tables of equal buckets."""
    df = words(spark, sf).select("doc_id", "review", "sentiment", "_char_len", "_word_count", "_words")
    corpus = files.save_bucketed(df, fresh_path(spark, "bucketed-corpus"), 8)
    gold = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return corpus, files.save_bucketed(gold, fresh_path(spark, "bucketed-labels"), 8)


@query
def s02_bucketed_corpus_join(spark, sf):
    """Words and labels of a document met in their buckets, then counted by document; no exchange."""
    corpus, gold = _bucketed(spark, sf)
    joined = corpus.join(gold, "doc_id").groupBy("doc_id", "quality", "toxic").agg(F.sum("_word_count").alias("n"))
    return joined.select("doc_id", "quality", "toxic", "n")


@query
def s03_load_processed_corpus(spark, sf):
    path = fresh_path(spark, "processed")
    files.save_corpus(words(spark, sf), path, words_as_text=True)
    return files.load_corpus(spark, path).select("doc_id", big(F.size("_words")).alias("n"), joined("_words").alias("words"))


@query
def s04_annotation_sheet(spark, sf):
    path = fresh_path(spark, "sheet")
    files.write_annotation_sheet(rated(spark, sf), path)
    return files.read_csv(spark, path, EVALUATION).select("doc_id", "review", "model_prediction", "gold_label")


@query
def s05_rated_annotation_source(spark, sf):
    path = fresh_path(spark, "sheet")
    df = rated(spark, sf)
    files.write_annotation_sheet(df, path)
    blank = df.withColumn("human_rating", F.lit(None).cast("string"))
    merged = files.merge_ratings(blank, files.read_annotation_sheet(spark, path))
    return merged.select("doc_id", "human_rating", "llm_judge")


@query
def s06_selected_subsample(spark, sf):
    path = fresh_path(spark, "selected")
    files.write_selected(sampling.select_test(sampling.assign_split(reviews(spark, sf)), SAMPLE // 4), path)
    return files.read_reviews(spark, path)


@query
def s07_ngram_model_persistence(spark, sf):
    model, test = fitted(spark, sf)
    path = fresh_path(spark, "model")
    files.save_ngram_model(model, path)
    out = ngram.perplexity(files.load_ngram_model(spark, path), test)
    return out.select("n", "events", F.round("perplexity", 4).alias("perplexity"))


@query
def s07_unsmoothed_model_persistence(spark, sf):
    """A model without smoothing must come back as one."""
    df = words(spark, sf)
    path = fresh_path(spark, "model")
    model = ngram.fit(df, (2, 3), laplace=False)
    files.save_ngram_model(model, path)
    # the text is the one that taught the model, and its events are counted already
    out = ngram.perplexity(files.load_ngram_model(spark, path), df, scored=model)
    return out.select("n", "events", F.round("perplexity", 4).alias("perplexity"))


@query
def s07_count_classifier_persistence(spark, sf):
    df = split_words(spark, sf)
    path = fresh_path(spark, "classifier")
    files.save_count_classifier(classify.train_counts(in_split(df, "train")), path)
    out = classify.predict_counts(files.load_count_classifier(spark, path), df)
    return out.select("doc_id", "prediction", r6(F.get("probabilities", F.lit(1))).alias("score"))


@query
def s07_classifier_persistence(spark, sf):
    df = split_words(spark, sf)
    path = fresh_path(spark, "classifier")
    files.save_classifier(classify.train(in_split(df, "train")), path)
    return classify.predict(files.load_classifier(path), df).select("doc_id", "prediction")


# ---- cleaning ------------------------------------------------------------------


@query
def p01_remove_break_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.remove_breaks(F.col("html")).alias("html"))


@query
def p02_lowercase(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.lowercase(F.col("text")).alias("text"))


@query
def p03_expand_contractions(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.expand_contractions(F.lower(with_forms(F.col("text")))).alias("text"))


@query
def p03_full_cleaning(spark, sf):
    fed = with_forms(F.col("review"))
    return reviews(spark, sf).select("doc_id", text.clean(fed, stop_words=text.wordlists.STOP_WORDS).alias("review"))


@query
def p04_remove_stop_words(spark, sf):
    return reviews(spark, sf).select("doc_id", text.remove_stop_words(F.lower("review")).alias("review"))


@query
def p05_strip_punctuation(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip_punctuation(F.lower("text")).alias("text"))


@query
def p06_stem_words(spark, sf):
    return wordforms.stem(words(spark, sf)).select("doc_id", "review", "_word_count")


@query
def p07_lemmatise_words(spark, sf):
    df = words(spark, sf)
    return wordforms.lemmatise(df, lemmas_of(df)).select("doc_id", "review", big("_word_count").alias("n"))


@query
def p07_lemmatise_by_rules(spark, sf):
    """Every word in the shortest known form that a noun, verb or adjective ending leaves."""
    df = wordforms.lemmatise(words(spark, sf), parts=("noun", "verb", "adjective"))
    return df.select("doc_id", "review", big("_word_count").alias("n"))


@query
def p08_char_length(spark, sf):
    return words(spark, sf).select("doc_id", big("_char_len").alias("char_len"))


@query
def p09_word_count(spark, sf):
    return words(spark, sf).select("doc_id", big("_word_count").alias("word_count"))


@query
def p10_encode_labels(spark, sf):
    return reviews_all(spark, sf).select("doc_id", labels.encode_label(F.col("sentiment")).alias("label"))


@query
def p11_decode_labels(spark, sf):
    df = table(spark, sf, "labels")
    return df.select("doc_id", labels.decode_label(F.col("quality")).alias("quality"), labels.decode_label(F.col("toxic")).alias("toxic"))


@query
def p12_class_filter(spark, sf):
    return reviews(spark, sf).filter("sentiment = 'positive'")


@query
def p13_required_columns(spark, sf):
    """Rows that have a value, for each column that the review schema demands; absent ones end with an error."""
    df = reviews_all(spark, sf)
    require_columns(df, "doc_id", "review", "sentiment")
    try:
        require_columns(df, "doc_id", "_words", "_rating")
        absent = ""
    except ValueError as error:
        absent = str(error).split(";")[0]
    counts = [F.struct(F.lit(c).alias("name"), F.count(c).alias("rows")) for c in ("doc_id", "review", "sentiment")]
    return df.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).select("c.*", F.lit(absent).alias("absent"))


@query
def p14_text_preview(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.preview(F.col("text")).alias("preview"))


@query
def p15_drop_null_tokens(spark, sf):
    blanked = F.transform("_words", lambda w: F.when(F.char_length(w) > 2, w))
    return words(spark, sf).select("doc_id", joined(text.drop_nulls(blanked)).alias("words"))


# ---- tokenisers ----------------------------------------------------------------


@query
def t01_word_tokens(spark, sf):
    return words(spark, sf).select("doc_id", big("_word_count").alias("n"), joined("_words").alias("words"))


@query
def t01_treebank_tokens(spark, sf):
    df = tokenise(turns(spark, sf).withColumn("review", with_forms(F.col("review"))), treebank=True)
    return df.select("conv_id", "turn", big("_word_count").alias("n"), joined("_words").alias("words"))


@query
def t02_word_punct_tokens(spark, sf):
    df = tokenise(reviews(spark, sf), tokenizer="bpe")
    return df.select("doc_id", big("_word_count").alias("n"), F.array_join("_words", " ").alias("words"))


def _pieces(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Piece table and distinct words of a corpus."""
    counted = materialise(wordforms.distinct_words(df), "words")
    return subword.learn_pieces(df, words=counted), counted


def _scored_pieces(pieces: DataFrame) -> DataFrame:
    # rounded, so that both engines add the same numbers
    return subword.with_log_probability(pieces).withColumn("logp", F.round("logp", 9))


def _wordpiece(spark: SparkSession, sf: str, max_length: int | None) -> DataFrame:
    df = words(spark, sf)
    pieces, counted = _pieces(df)
    encoded = subword.encode(df, pieces, max_length=max_length, words=counted)
    return encoded.select(
        "doc_id", big("_word_count").alias("n"), joined("_input_ids").alias("ids"), big(F.aggregate(
            "_attention_mask", F.lit(0), lambda a, x: a + x)).alias("mask_sum")
    )


@query
def t03_wordpiece_ids(spark, sf):
    return _wordpiece(spark, sf, 320)


@query
def t03_wordpiece_ids_whole(spark, sf):
    return _wordpiece(spark, sf, None)


def _unigram(spark: SparkSession, sf: str, max_length: int | None) -> DataFrame:
    df = words(spark, sf)
    learned, counted = _pieces(df)
    encoded = subword.encode(df, _scored_pieces(learned), kind="unigram", max_length=max_length, words=counted)
    return encoded.select("doc_id", big("_word_count").alias("n"), joined("_input_ids").alias("ids"))


@query
def t04_unigram_ids(spark, sf):
    return _unigram(spark, sf, 320)


@query
def t04_unigram_ids_whole(spark, sf):
    return _unigram(spark, sf, None)


@query
def t04_unigram_expectation(spark, sf):
    """How often covers of the corpus are expected to hold each piece, the step that training repeats."""
    pieces, counted = _pieces(words(spark, sf))
    table_ = {r.piece: (r.id, r.logp) for r in _scored_pieces(pieces).collect()}  # as many as the vocabulary asks for
    return unigram.expected_counts(counted, table_).select("id", F.round("expected", 3).alias("expected"))


@query
def t04_trained_unigram_ids(spark, sf):
    """Whole documents under pieces fitted by two rounds for each pruning, from 30,000 to 10,000."""
    df = words(spark, sf)
    learned, counted = _pieces(df)
    trained = unigram.train_unigram(counted, learned, 10_000)
    encoded = subword.encode(df, trained.pieces, kind="unigram", max_length=None, words=counted)
    return encoded.select("doc_id", big("_word_count").alias("n"), joined("_input_ids").alias("ids"))


@query
def t05_subword_vocabulary(spark, sf):
    return _pieces(words(spark, sf))[0].select("piece", "id", "cnt")


@query
def t05_merged_words(spark, sf):
    """Every distinct word in the pieces that the learned merges leave."""
    merged, _ = subword.merge_table(materialise(wordforms.distinct_words(words(spark, sf)), "words"))
    return merged.select("token", F.array_join("pieces", " ").alias("pieces"), "cnt")


def _learned(spark: SparkSession, sf: str, size: int) -> tuple[DataFrame, DataFrame, list]:
    """Tokenised reviews, their distinct words, and the merges these teach."""
    df = words(spark, sf)
    counted = materialise(wordforms.distinct_words(df), "words")
    return df, counted, merges.learn_merges(counted, size)


@query
def t05_learned_merges(spark, sf):
    """The first merges of the corpus, one after the other."""
    _, _, found = _learned(spark, sf, 100)
    rows = [(rank, *merge) for rank, merge in enumerate(found)]
    return spark.createDataFrame(rows, "rank INT, left_piece STRING, right_piece STRING, cnt BIGINT")


@query
def t05_merge_vocabulary(spark, sf):
    _, counted, found = _learned(spark, sf, 100)
    return merges.merge_pieces(counted, found)


@query
def t03_merge_ids(spark, sf):
    """Whole documents as ids of the pieces that learned merges make."""
    df, counted, found = _learned(spark, sf, 100)
    pieces = merges.merge_pieces(counted, found)
    encoded = subword.encode(df, pieces, kind="bpe", merges=found, max_length=None, words=counted)
    return encoded.select("doc_id", big("_word_count").alias("n"), joined("_input_ids").alias("ids"))


def _merge_lengths(spark: SparkSession, sf: str, size: int) -> DataFrame:
    df, counted, found = _learned(spark, sf, size)
    table_ = materialise(merges.segment(counted, found), "merge-segments")
    return subword.lengths(df, table_).select(F.lit("learned_bpe").alias("tokenizer"), "length")


@query
def t06_merge_coverage(spark, sf):
    """Share of documents within each length under the first merges of the corpus."""
    out = subword.length_coverage(_merge_lengths(spark, sf, 100))
    return out.select("tokenizer", "threshold", r6("percent").alias("percent"))


@query
def t07_merge_distribution(spark, sf):
    out = subword.length_distribution(_merge_lengths(spark, sf, 100))
    return out.select("tokenizer", *[r6(c).alias(c) for c in ("median", "p95", "p99")])


@query
def t06_learned_bpe_coverage(spark, sf):
    """Share of documents within each length under 30,000 merges, or all that the corpus allows."""
    out = subword.length_coverage(_merge_lengths(spark, sf, 30_000))
    return out.select("tokenizer", "threshold", r6("percent").alias("percent"))


def _token_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """``(tokenizer, length)`` of whole documents under five tokenisers."""
    counts = F.array(
        F.struct(F.lit("word").alias("tokenizer"), F.size(text.word_tokens(F.col("review"))).alias("length")),
        F.struct(F.lit("word_punct").alias("tokenizer"), F.size(text.word_punct_tokens(F.col("review"))).alias("length")),
    )
    out = reviews(spark, sf).select(F.explode(counts).alias("c")).select("c.*")
    df = words(spark, sf)
    pieces, counted = _pieces(df)
    tables = {
        "wordpiece": materialise(subword.greedy_table(counted, pieces), "wordpiece-table"),
        "unigram": materialise(subword.unigram_table(counted, _scored_pieces(pieces)), "unigram-table"),
        "bpe": subword.merge_table(counted)[0],
    }
    for name, tokens in tables.items():
        out = out.unionByName(subword.lengths(df, tokens).select(F.lit(name).alias("tokenizer"), "length"))
    return materialise(out, "token-lengths")


@query
def t06_length_coverage(spark, sf):
    return subword.length_coverage(_token_lengths(spark, sf)).select("tokenizer", "threshold", r6("percent").alias("percent"))


@query
def t07_length_distribution(spark, sf):
    out = subword.length_distribution(_token_lengths(spark, sf))
    return out.select("tokenizer", *[r6(c).alias(c) for c in ("median", "p95", "p99")])


@query
def t08_length_summary(spark, sf):
    return length_summary(words(spark, sf)).select("samples", r6("avg_len").alias("avg_len"), "max_len")


# ---- sampling and splitting ----------------------------------------------------


@query
def m01_seeded_sample(spark, sf):
    return sampling.sample_reviews(reviews(spark, sf), SAMPLE)


@query
def m01_load_sampled_corpus(spark, sf):
    df = load_corpus(reviews(spark, sf), sample_size=SAMPLE)
    return df.select("doc_id", "sentiment", big("_word_count").alias("word_count"))


@query
def m02_ratio_split(spark, sf):
    return sampling.assign_split(reviews(spark, sf)).select("doc_id", "split")


@query
def m02_hash_split(spark, sf):
    return sampling.assign_split(reviews(spark, sf), mode="hash").select("doc_id", "split")


@query
def m03_selected_test(spark, sf):
    df = sampling.select_test(sampling.assign_split(reviews(spark, sf)), SAMPLE // 4)
    return df.select("doc_id", "split", "selected")


@query
def m04_materialised_splits(spark, sf):
    df = reviews(spark, sf)
    keys = sampling.assign_split(df).select("doc_id", "split")
    parts = [
        sampling.take_split(df, in_split(keys, s)).withColumn("split", F.lit(s)) for s in ("train", "val", "test")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def m05_selected_outside_test(spark, sf):
    """Of the selected rows none is outside of the test split; of a sample of all rows most are."""
    df = sampling.select_test(sampling.assign_split(reviews(spark, sf)), SAMPLE // 4)
    test = in_split(df, "test")
    sampling.assert_subset(df.filter("selected"), test)
    checked = {"selected": df.filter("selected"), "sampled": sampling.sample_reviews(df, SAMPLE)}
    parts = [
        sampling.not_contained(rows, test).agg(F.lit(name).alias("subset"), F.count(F.lit(1)).alias("missing"))
        for name, rows in checked.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def m06_epoch_shuffle(spark, sf):
    return sampling.epoch_order(reviews(spark, sf).select("doc_id"), 42, 3).select("doc_id", "position")


# ---- joins ---------------------------------------------------------------------


@query
def j01_token_to_id(spark, sf):
    """Tokens of the conversations looked up in the review vocabulary."""
    vocab, _ = vocabulary(spark, sf)
    tokens = tokenise(turns(spark, sf)).select(F.explode_outer("_words").alias("token")).filter("token IS NOT NULL")
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return lookup(counted, vocab, ["token"], spread=salt_of("token")).select(
        "token", "n", F.coalesce("id", F.lit(sequence.UNK_ID)).alias("id")
    )


@query
def j02_id_to_token(spark, sf):
    """Every n_chars value read as an id; most are beyond the vocabulary."""
    vocab, _ = vocabulary(spark, sf)
    ids = table(spark, sf, "documents").select("doc_id", F.array(F.lit(2), F.col("n_chars").cast("int")).alias("ids"))
    return sequence.decode(ids, vocab)


@query
def j03_event_lookup(spark, sf):
    model, test = fitted(spark, sf)
    wanted = ngram.event_counts(test, model.sizes).select("n", "context", "word")
    return shown(ngram.probabilities(model, wanted)).select("n", "context", "word", big("cnt").alias("cnt"), big("total").alias("total"))


@query
def j05_split_membership(spark, sf):
    keys = in_split(sampling.assign_split(reviews(spark, sf)), "train")
    return sampling.not_contained(reviews_all(spark, sf).select("doc_id", "sentiment"), keys)


@query
def j06_ratings_to_predictions(spark, sf):
    df = rated(spark, sf)
    human = df.filter("human_rating IS NOT NULL").select("doc_id", "human_rating")
    return judge.attach_ratings(df.drop("human_rating"), human, "human_rating").select(
        "doc_id", "model_prediction", "human_rating"
    )


@query
def j07_weighted_draw(spark, sf):
    """One draw per review, from the successors of its first word."""
    df = words(spark, sf)
    model = ngram.fit(df, (2,))
    # generated and then filtered: a condition on the words themselves would be evaluated below the projection once more
    first = df.select("doc_id", F.explode_outer(F.slice("_words", 1, 1)).alias("first")).filter("first IS NOT NULL")
    states = first.select(F.col("doc_id").alias("sent_id"), F.lit(2).alias("n"), F.array("first").alias("context"))
    return shown(ngram.draw(ngram.draw_table(model, 2), states, uniform("draw", F.col("sent_id")))).select("sent_id", "context", "word")


# ---- statistics ----------------------------------------------------------------


@query
def a01_class_distribution(spark, sf):
    return stats.class_distribution(reviews_all(spark, sf))


def _lengths(spark: SparkSession, sf: str, stat: str) -> DataFrame:
    # all documents: those without a label count in the overall row only
    out = stats.length_stats(tokenise(reviews_all(spark, sf)))
    return out.filter(F.col("stat") == stat).select("scope", r6("value").alias("value"))


@query
def a02_mean_text_length(spark, sf):
    return _lengths(spark, sf, "average_text_length")


@query
def a03_median_text_length(spark, sf):
    return _lengths(spark, sf, "median_text_length")


@query
def a04_mean_word_count(spark, sf):
    return _lengths(spark, sf, "average_word_count")


@query
def a05_median_word_count(spark, sf):
    return _lengths(spark, sf, "median_word_count")


@query
def a06_word_frequency(spark, sf):
    return stats.word_frequency(words(spark, sf))


@query
def a06_word_frequency_all_documents(spark, sf):
    return stats.word_frequency(tokenise(reviews_all(spark, sf)))


@query
def a06_word_frequency_by_role(spark, sf):
    return stats.word_frequency(tokenise(turns(spark, sf)), ROLES)


@query
def a07_vocabulary_size(spark, sf):
    return stats.vocabulary_size(stats.gram_table(words(spark, sf)))


@query
def a07_approximate_vocabulary_size(spark, sf):
    """Whether sketches of the vocabulary come within five of their standard errors of the exact sizes."""
    df = split_words(spark, sf)
    sketched = stats.approximate_vocabulary_size(df, 0.01).withColumnRenamed("vocabulary_size", "sketched")
    exact = stats.vocabulary_size(stats.gram_table(df))
    near = F.abs(F.col("sketched") - F.col("vocabulary_size")) <= 0.05 * F.col("vocabulary_size")
    return exact.join(sketched, "scope").select("scope", big("vocabulary_size").alias("vocabulary_size"), near.alias("near"))


@query
def a08_top_words(spark, sf):
    return stats.top_words(words(spark, sf))


@query
def a08_top_words_first_seen(spark, sf):
    return stats.top_words(words(spark, sf), ties="first_seen")


@query
def a09_top_ngrams(spark, sf):
    return stats.top_ngrams(words(spark, sf)).withColumn("gram", stats.shown("gram"))


@query
def a09_top_ngrams_first_seen(spark, sf):
    return stats.top_ngrams(words(spark, sf), ties="first_seen").withColumn("gram", stats.shown("gram"))


@query
def a10_term_class_frequency(spark, sf):
    return stats.term_frequency(words(spark, sf), "unigram+bigram")


@query
def a11_log_odds(spark, sf):
    return stats.log_odds(stats.term_frequency(words(spark, sf))).select("term", "positive", "negative", r6("z").alias("z"))


@query
def a12_significant_words(spark, sf):
    out = stats.significant_words(stats.log_odds(stats.term_frequency(words(spark, sf))))
    return out.select("scope", "term", r6("z").alias("z"))


@query
def a13_word_cloud(spark, sf):
    out = stats.word_cloud(stats.word_frequency(words(spark, sf)))
    return out.select("scope", "token", "cnt", r6("weight").alias("weight"))


@query
def a14_term_scatter(spark, sf):
    out = stats.term_scatter(stats.term_frequency(words(spark, sf)))
    return out.select("term", "positive", "negative", r6("x").alias("x"), r6("y").alias("y"))


@query
def a15_corpus_report(spark, sf):
    return corpus_report(words(spark, sf)).select("stat", "scope", "key", r6("value").alias("value"))


@query
def a16_vocabulary_report(spark, sf):
    vocab, _ = vocabulary(spark, sf)
    return sequence.vocabulary_count(vocab)


# ---- n-gram models -------------------------------------------------------------


@query
def l01_padded_events(spark, sf):
    """Events per document and size, with a digest of the contexts."""
    found = ngram.event_arrays(words(spark, sf), (2, 3), "doc_id")
    shown_contexts = F.transform("events", lambda e: F.array_join(e["context"], " "))
    read = found.select("doc_id", "n", shown_contexts.alias("contexts"), F.col("events")["word"].alias("words"))
    length = F.aggregate("contexts", F.lit(0).cast("bigint"), lambda done, c: done + F.char_length(c))
    digests = read.select(
        "doc_id", "n", big(F.size("contexts")).alias("events"), length.alias("context_chars"),
        F.array_min("contexts").alias("first_context"), F.array_max("words").alias("last_word"),
    )
    # a row per document and size by now; a doc_id that comes twice is one document
    return digests.groupBy("doc_id", "n").agg(
        F.sum("events").alias("events"),
        F.sum("context_chars").alias("context_chars"),
        F.min("first_context").alias("first_context"),
        F.max("last_word").alias("last_word"),
    )


@query
def l02_ngram_counts(spark, sf):
    return shown(ngram.event_counts(in_split(split_words(spark, sf), "train"), (2, 3)))


@query
def l02_custom_token_ngrams(spark, sf):
    """N-grams over sentences as tokens, which hold blanks."""
    df = tokenise(reviews(spark, sf), tokenizer="bpe", custom=lambda c: F.array_remove(F.split(c, r"\.\s*"), ""))
    counted = ngram.event_counts(df, (2, 3))
    # the sides are kept apart by a mark that no text holds
    return counted.withColumn("context", F.array_join("context", "\x01"))


@query
def l03_context_counts(spark, sf):
    return shown(ngram.context_totals(ngram.event_counts(in_split(split_words(spark, sf), "train"), (2, 3))))


@query
def l04_event_vocabulary(spark, sf):
    return ngram.event_vocabulary(ngram.event_counts(in_split(split_words(spark, sf), "train"), (2, 3)))


@query
def l05_laplace_probability(spark, sf):
    model, test = fitted(spark, sf)
    wanted = ngram.event_counts(test, model.sizes).select("n", "context", "word")
    return shown(ngram.probabilities(model, wanted)).select("n", "context", "word", F.round("p", 12).alias("p"))


@query
def l06_unsmoothed_probability(spark, sf):
    model, test = fitted(spark, sf, laplace=False)
    wanted = ngram.event_counts(test, model.sizes).select("n", "context", "word")
    return shown(ngram.probabilities(model, wanted)).select("n", "context", "word", F.round("p", 12).alias("p"))


@query
def l07_perplexity_laplace(spark, sf):
    model, test = fitted(spark, sf)
    return ngram.perplexity(model, test).select("n", "events", F.round("perplexity", 4).alias("perplexity"))


@query
def l07_perplexity_unsmoothed_train(spark, sf):
    """Scored on its own training text, where nothing is impossible."""
    df = words(spark, sf)
    model = ngram.fit(df, (2, 3), laplace=False)
    out = ngram.perplexity(model, df, scored=model.counts)  # its events are counted already
    return out.select("n", "events", F.round("perplexity", 4).alias("perplexity"))


@query
def l08_generated_sentences(spark, sf):
    model, test = fitted(spark, sf)
    return sample_sentences(model, test.select(F.col("doc_id").alias("sent_id")))


@query
def l08_started_sentences(spark, sf):
    """Sentences that go on from a given word, the first one of each training document."""
    df = in_split(split_words(spark, sf), "train").filter("_word_count > 0")
    seeds = df.select(F.col("doc_id").alias("sent_id"), F.get("_words", F.lit(0)).alias("start"))
    return ngram.generate(ngram.fit(df, (2,)), seeds, 2, max_length=20, start_col="start").select("sent_id", "sentence")


@query
def l09_compare_sizes(spark, sf):
    df = sampling.assign_split(tokenise(turns(spark, sf)).withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn")))
    _, out = compare_sizes(df, (1, 2, 3))
    return out.select("n", "events", F.round("perplexity", 4).alias("perplexity"))


@query
def l10_successors(spark, sf):
    model, test = fitted(spark, sf)
    contexts = ngram.event_counts(test, (2,)).select("n", "context").distinct()
    return shown(ngram.successors(model, contexts, 3)).select("n", "context", "rank", "word", "cnt")


# ---- vocabulary and sequences --------------------------------------------------


@query
def v01_vocabulary(spark, sf):
    vocab, _ = vocabulary(spark, sf)
    return vocab.select("token", "id")


@query
def v02_encoded_documents(spark, sf):
    vocab, df = vocabulary(spark, sf)
    return sequence.encode(df, vocab, start=None, end=None).select("doc_id", joined("ids").alias("ids"))


@query
def v03_boundary_tokens(spark, sf):
    return words(spark, sf).select("doc_id", joined(sequence.with_boundaries(F.col("_words"))).alias("words"))


@query
def v04_truncate_keep_last(spark, sf):
    bounded = sequence.truncate_keep_last(sequence.with_boundaries(F.col("_words")), MAX_LENGTH)
    return words(spark, sf).select("doc_id", joined(bounded).alias("words"))


@query
def v05_input_target_pairs(spark, sf):
    vocab, df = vocabulary(spark, sf)
    pairs = sequence.training_pairs(sequence.encode(df, vocab))
    return pairs.select("doc_id", joined("input_ids").alias("input_ids"), joined("target_ids").alias("target_ids"))


@query
def v06_padded_batches(spark, sf):
    vocab, df = vocabulary(spark, sf)
    out = sequence.training_batches(df, vocab, batch_size=BATCH)
    return out.select(
        "batch_id", "slot", "doc_id", "label", joined("input_ids").alias("input_ids"), joined("target_ids").alias("target_ids")
    )


@query
def v06_shuffled_batches(spark, sf):
    vocab, df = vocabulary(spark, sf)
    out = sequence.training_batches(df, vocab, batch_size=BATCH, shuffle_seed=42, epoch=1)
    return out.select("batch_id", "slot", "doc_id", "label", big(F.size("input_ids")).alias("width"))


@query
def v07_decoded_documents(spark, sf):
    vocab, df = vocabulary(spark, sf)
    return sequence.decode(sequence.encode(df, vocab), vocab)


@query
def v08_batch_count(spark, sf):
    df = sampling.assign_split(reviews(spark, sf))
    parts = [
        sequence.batch_count(in_split(df, name), BATCH).withColumn("split", F.lit(name)) for name in ("train", "val", "test")
    ]
    return reduce(DataFrame.unionByName, parts)


def _cell_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of the test batches with the unigram loss of their target."""
    vocab, df = vocabulary(spark, sf)
    cells = (
        sequence.training_batches(in_split(df, "test"), vocab, batch_size=BATCH)
        .select("batch_id", "doc_id", F.posexplode("target_ids").alias("pos", "target"))
    )
    totals = vocab.agg(F.sum(F.col("cnt") + 1).alias("mass")).scalar()
    known = vocab.select(F.col("id").alias("target"), "cnt")
    found = lookup(cells, known, ["target"], spread=salt_of("doc_id", "pos"))
    return found.withColumn("mass", totals).select(
        "batch_id", "target", (F.ln("mass") - F.ln(F.col("cnt") + 1)).alias("loss")
    )


@query
def v09_token_perplexity(spark, sf):
    return sequence.sequence_perplexity(_cell_losses(spark, sf)).select(r6("perplexity").alias("perplexity"))


@query
def v09_padded_batch_perplexity(spark, sf):
    return sequence.sequence_perplexity(_cell_losses(spark, sf), "padded_batch").select(r6("perplexity").alias("perplexity"))


@query
def v10_temperature_distribution(spark, sf):
    model, _ = fitted(spark, sf)
    return shown(ngram.sharpened(model, 0.8)).select("n", "context", "word", F.round("q", 9).alias("q"))


@query
def v10_temperature_sentences(spark, sf):
    model, test = fitted(spark, sf)
    seeds = test.select(F.col("doc_id").alias("sent_id"))
    return ngram.generate(model, seeds, 2, temperature=0.8).select("sent_id", "sentence")


# ---- classification ------------------------------------------------------------


@query
def c01_train_classifier(spark, sf):
    df = split_words(spark, sf)
    model = classify.train(in_split(df, "train"))
    return metrics.evaluate(classify.predict(model, df), ["split"])


@query
def c01_train_count_classifier(spark, sf):
    df = split_words(spark, sf)
    scored = classify.predict_counts(classify.train_counts(in_split(df, "train")), df)
    out = metrics.evaluate(scored, ["split"], with_loss=False)
    return out.select("split", "samples", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"))


def _tokenisations(spark: SparkSession, sf: str) -> DataFrame:
    """Split reviews with one token column per tokeniser, whole texts."""
    base = sampling.assign_split(reviews(spark, sf))
    df = tokenise(base).withColumn("_punct", text.word_punct_tokens(F.col("review")))
    df = materialise(df.select("doc_id", "sentiment", "split", "_words", "_punct"), "tokens", "zstd")
    pieces, counted = _pieces(df)
    out = df
    for name, kind, table_ in (("_pieces", "wordpiece", pieces), ("_unigrams", "unigram", _scored_pieces(pieces))):
        kept = [c for c in out.columns if c != "doc_id"]
        encoded = subword.encode(out, table_, kind=kind, max_length=None, words=counted, keep=kept)
        out = encoded.select("doc_id", *kept, F.col("_input_ids").cast("array<string>").alias(name))
    return materialise(out, "tokenisations", "zstd")


TOKENISATIONS = {"word": "_words", "word_punct": "_punct", "wordpiece": "_pieces", "unigram": "_unigrams"}


@query
def c02_train_per_tokenisation(spark, sf):
    df = _tokenisations(spark, sf)
    _, out = classify.compare_tokenisations(in_split(df, "train"), df, TOKENISATIONS)
    return out


@query
def c02_count_per_tokenisation(spark, sf):
    df = _tokenisations(spark, sf)
    out = classify.compare_count_tokenisations(in_split(df, "train"), df, TOKENISATIONS)
    return out.select("tokenizer", "split", "samples", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"))


@query
def c03_batch_predict(spark, sf):
    df = split_words(spark, sf)
    model = classify.train(in_split(df, "train"))
    return classify.predict(model, df).select("doc_id", "label", "prediction")


# The optimum of a regression on two kinds of words is a point that SQL can find by itself.
MARKERS = {"articles": ("the", "of"), "links": ("and", "to")}
OPTIMUM = {"iterations": 200, "tolerance": 1e-12}


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    """Split reviews with the marker words among their words, one column per set."""
    df = split_words(spark, sf)
    kept = [F.expr(f"filter(_words, w -> w IN {pair})").alias(name) for name, pair in MARKERS.items()]
    return materialise(df.select("doc_id", "sentiment", "split", *kept), "marked")


def _regression_scores(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "label", "prediction", F.round(F.get("probabilities", F.lit(1)), 3).alias("score"))


@query
def c01_regression_optimum(spark, sf):
    df = _marked(spark, sf)
    out = metrics.evaluate(classify.predict(classify.train(in_split(df, "train"), "articles", **OPTIMUM), df), ["split"])
    return out.select("split", "samples", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"), F.round("perplexity", 3).alias("perplexity"))


@query
def c02_regression_per_token_column(spark, sf):
    df = _marked(spark, sf)
    _, out = classify.compare_tokenisations(in_split(df, "train"), df, {name: name for name in MARKERS}, **OPTIMUM)
    return out.select(
        "tokenizer", "split", "samples", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"), F.round("perplexity", 3).alias("perplexity")
    )


@query
def c03_regression_predict(spark, sf):
    df = _marked(spark, sf)
    return _regression_scores(classify.predict(classify.train(in_split(df, "train"), "articles", **OPTIMUM), df))


@query
def s07_regression_persistence(spark, sf):
    df = _marked(spark, sf)
    path = fresh_path(spark, "regression")
    files.save_classifier(classify.train(in_split(df, "train"), "links", **OPTIMUM), path)
    return _regression_scores(classify.predict(files.load_classifier(path), df))


@query
def c03_count_predict(spark, sf):
    df = split_words(spark, sf)
    out = classify.predict_counts(classify.train_counts(in_split(df, "train")), df)
    return out.select("doc_id", "label", "prediction", r6(F.get("probabilities", F.lit(1))).alias("score"))


def _vowel_share_model():
    """Stand-in external model: share of vowels as the positive score."""

    def score(batch: pd.Series) -> list[list[float]]:
        share = batch.str.count("[aeiou]") / batch.str.len().clip(lower=1)
        return [[1.0 - s, s] for s in share]

    return score


@query
def c03_external_predict(spark, sf):
    out = classify.score_external(reviews(spark, sf), _vowel_share_model)
    return out.select("doc_id", "prediction", r6(F.get("probabilities", F.lit(1))).alias("score"))


@query
def c04_argmax(spark, sf):
    return scored(spark, sf).select("doc_id", labels.argmax(F.col("probabilities")).alias("prediction"))


@query
def c05_example_loss(spark, sf):
    return with_loss(scored(spark, sf)).select("doc_id", r6("loss").alias("loss"))


# ---- metrics and agreement -----------------------------------------------------


@query
def e01_accuracy(spark, sf):
    return scored(spark, sf).agg(r6(metrics.accuracy()).alias("accuracy"))


@query
def e02_f1(spark, sf):
    return scored(spark, sf).agg(r6(metrics.binary_f1()).alias("f1"))


@query
def e03_confusion_matrix(spark, sf):
    return metrics.confusion(scored(spark, sf))


@query
def e04_classifier_perplexity(spark, sf):
    return with_loss(scored(spark, sf)).agg(r6(metrics.classifier_perplexity()).alias("perplexity"))


@query
def e05_metrics_per_split(spark, sf):
    out = metrics.evaluate(with_loss(scored(spark, sf)), ["split"])
    return out.select("split", "samples", *[r6(c).alias(c) for c in ("accuracy", "f1", "perplexity")])


@query
def e05_confusion_per_split(spark, sf):
    return evaluate_classifier(with_loss(scored(spark, sf))).split_confusion


@query
def e06_evaluation_frame(spark, sf):
    return metrics.evaluation_frame(scored(spark, sf))


@query
def e07_subsample_metrics(spark, sf):
    out = evaluate_classifier(with_loss(scored(spark, sf))).subsample_metrics
    return out.select("split", "samples", r6("accuracy").alias("accuracy"), r6("f1").alias("f1"))


def _full_evaluation(spark: SparkSession, sf: str):
    """The whole evaluation with human ratings and the judge's resolved responses."""
    human = rated(spark, sf).filter("human_rating IS NOT NULL").select("doc_id", "human_rating")
    verdicts = judge.resolve_responses(response_log(spark, sf)).select("doc_id", "llm_judge")
    return evaluate_classifier(with_loss(scored(spark, sf)), human, verdicts)


@query
def e07_evaluation_frame_with_ratings(spark, sf):
    return _full_evaluation(spark, sf).frame


@query
def e07_evaluation_agreement(spark, sf):
    out = _full_evaluation(spark, sf).agreement
    return out.select("pair", "agree", "total", r6("percent").alias("percent"))


@query
def e07_evaluation_both_wrong(spark, sf):
    return _full_evaluation(spark, sf).both_wrong.select("doc_id", "gold_label", "model_prediction", "llm_judge")


@query
def e07_evaluation_agree_but_wrong(spark, sf):
    return _full_evaluation(spark, sf).agree_but_wrong.select("doc_id", "gold_label", "model_prediction", "llm_judge")


def blank_rated(spark: SparkSession, sf: str) -> DataFrame:
    """Rated reviews; some judge labels and ratings are blank, in several ways."""
    d = digit("blank")
    blank = F.when(d < "2", "").when(d < "4", " ").when(d < "6", "\t\n")
    df = rated(spark, sf)
    return df.withColumns({
        "llm_judge": F.when(d < "6", blank).otherwise(F.col("llm_judge")),
        "human_rating": F.when(d < "6", blank).otherwise(F.lit(None)).cast("string"),
    })


@query
def g01_blank_ratings(spark, sf):
    """Blank ratings are none: the human has rated nothing here."""
    return agreement.rating_availability(blank_rated(spark, sf))


@query
def g02_agreement_with_blanks(spark, sf):
    out = agreement.pairwise_agreement(blank_rated(spark, sf), denominator="rated")
    return out.select("pair", "agree", "total", r6("percent").alias("percent"))


@query
def g03_both_wrong_with_blanks(spark, sf):
    return agreement.both_wrong(blank_rated(spark, sf)).select("doc_id", "gold_label", "model_prediction", "llm_judge")


@query
def g04_agree_but_wrong_with_blanks(spark, sf):
    return agreement.agree_but_wrong(blank_rated(spark, sf)).select("doc_id", "gold_label", "model_prediction", "llm_judge")


@query
def g01_rating_availability(spark, sf):
    return agreement.rating_availability(rated(spark, sf))


@query
def g02_pairwise_agreement(spark, sf):
    return agreement.pairwise_agreement(rated(spark, sf)).select("pair", "agree", "total", r6("percent").alias("percent"))


@query
def g02_agreement_of_rated(spark, sf):
    out = agreement.pairwise_agreement(rated(spark, sf), denominator="rated")
    return out.select("pair", "agree", "total", r6("percent").alias("percent"))


@query
def g03_both_wrong(spark, sf):
    return agreement.both_wrong(rated(spark, sf)).select("doc_id", "gold_label", "model_prediction", "llm_judge")


@query
def g03_both_wrong_examples(spark, sf):
    return agreement.examples(agreement.both_wrong(rated(spark, sf)))


@query
def g04_agree_but_wrong(spark, sf):
    return agreement.agree_but_wrong(rated(spark, sf)).select("doc_id", "gold_label", "model_prediction", "llm_judge")


# ---- judge labels --------------------------------------------------------------


@query
def k01_prompts(spark, sf):
    return judge.prompts(reviews(spark, sf))


@query
def k02_parsed_answers(spark, sf):
    return answers(spark, sf).select("doc_id", labels.parse_answer(F.col("answer")).alias("label"))


@query
def k03_answers_in_bodies(spark, sf):
    return response_log(spark, sf).select("doc_id", "attempt", labels.answer_in(F.col("body")).alias("answer"))


@query
def k04_resolved_responses(spark, sf):
    return judge.resolve_responses(response_log(spark, sf))


@query
def k05_attached_judgments(spark, sf):
    df = rated(spark, sf)
    verdicts = judge.resolve_responses(response_log(spark, sf))
    return judge.judge(df, "openrouter", judgments=verdicts).select("doc_id", "gold_label", "llm_judge")


# ---- extension points ----------------------------------------------------------


@query
def u01_custom_tokenizer(spark, sf):
    """Sentences as tokens, through the tokeniser hook."""
    df = tokenise(reviews(spark, sf), tokenizer="bpe", custom=lambda c: F.array_remove(F.split(c, r"\.\s*"), ""))
    return df.select("doc_id", big("_word_count").alias("n"))


def _batch_shape(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({
        "batch_id": [batch["batch_id"].iloc[0]],
        "rows": [len(batch)],
        "width": [len(batch["input_ids"].iloc[0])],
    })


@query
def u02_custom_collate(spark, sf):
    vocab, df = vocabulary(spark, sf)
    out = sequence.training_batches(df, vocab, batch_size=BATCH)
    return sequence.collate(out, _batch_shape, "batch_id bigint, rows bigint, width bigint")


def _long_is_positive(batch: pd.Series) -> pd.Series:
    return batch.str.len().gt(1000).map({True: "positive", False: "negative"})


@query
def u03_custom_judge(spark, sf):
    return judge.judge(rated(spark, sf), judge_fn=_long_is_positive).select("doc_id", "llm_judge")


@query
def u04_custom_loss(spark, sf):
    """Squared loss in place of cross entropy."""
    out = sequence.sequence_perplexity(_cell_losses(spark, sf), loss=F.col("loss") * F.col("loss") / 100)
    return out.select(r6("perplexity").alias("perplexity"))


@query
def u04_raw_logit_loss(spark, sf):
    """Loss from unnormalised scores, and from the log probabilities they stand for."""
    df = scored(spark, sf)
    logs = F.transform("probabilities", lambda p: F.ln(p))
    logits = F.transform(logs, lambda x: x + F.pmod("doc_id", F.lit(7)))
    return df.select(
        "doc_id", r6(labels.token_loss(logits, F.col("label"))).alias("loss"),
        r6(labels.token_loss(logs, F.col("label"), "log_probabilities")).alias("same"),
    )
