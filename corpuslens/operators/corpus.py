"""From raw reviews to the tokenised frame every other operator starts from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import text
from corpuslens.operators.sampling import sample_reviews
from corpuslens.schema import require_columns


def tokenise(
    reviews: DataFrame,
    *,
    stop_words: Iterable[str] | None = None,
    tokenizer: str = "word",
    custom: text.Tokenizer | None = None,
    contractions: bool = True,
    treebank: bool = False,
) -> DataFrame:
    """Clean ``review`` and add ``_words``, ``_word_count`` and ``_char_len``."""
    require_columns(reviews, "review")
    cut = text.tokenizer(tokenizer, custom)
    if tokenizer == "word" and custom is None:
        cut = lambda c: text.word_tokens(c, treebank)
    cleaned = text.clean_lowered(
        F.col("review"), stop_words=stop_words, contractions=contractions, punctuation=tokenizer != "word"
    )
    return (
        # lower-casing is a step of its own: the next one refers to its result three times
        reviews.withColumn("review", text.lowercase(text.remove_breaks(F.col("review"))))
        .withColumn("review", cleaned)
        .withColumn("_words", cut(F.col("review")))
        .withColumn("_word_count", F.size("_words"))
        .withColumn("_char_len", F.char_length("review"))
    )


def load_corpus(
    reviews: DataFrame, *, sample_size: int | None = 50_000, seed: int = 42, **options: object
) -> DataFrame:
    """Sample first, then do the text work on the sample only."""
    if sample_size is not None:
        reviews = sample_reviews(reviews, sample_size, seed)
    return tokenise(reviews, **options)


def length_summary(df: DataFrame, words_col: str = "_words") -> DataFrame:
    """Number of samples, mean and maximum token length."""
    return df.agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg(F.size(words_col)).alias("avg_len"),
        F.max(F.size(words_col)).cast("bigint").alias("max_len"),
    )
