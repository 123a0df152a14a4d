"""Train, compare and sample n-gram models on a split corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from corpuslens.operators import ngram


def compare_sizes(tokens: DataFrame, sizes: Sequence[int] = (2, 3), laplace: bool = True) -> tuple[ngram.NGramModel, DataFrame]:
    """Model fitted on the train split and its test perplexity per size."""
    model = ngram.fit(tokens.filter("split = 'train'"), sizes, laplace=laplace)
    return model, ngram.perplexity(model, tokens.filter("split = 'test'"))


def sample_sentences(model: ngram.NGramModel, seeds: DataFrame, max_length: int = 20) -> DataFrame:
    """``(n, sent_id, sentence)`` for every seed row and every size of the model."""
    return ngram.generate(model, seeds, model.sizes, max_length=max_length).select("n", "sent_id", "sentence")
