"""Sentiment classifiers on token arrays: training and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from math import ceil

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.labels import argmax, cross_entropy, encode_label
from corpuslens.operators.lookup import lookup, salt_of
from corpuslens.operators.metrics import evaluate
from corpuslens.schema import CLASSES, require_columns
from corpuslens.session import materialise, stored_bytes

FREQUENT = 50_000  # tokens whose odds every task has
TRAIN_BYTES = 128 << 20  # of stored text: a training task's share


def train(
    df: DataFrame,
    tokens_col: str = "_words",
    *,
    features: int = 1 << 18,
    iterations: int = 20,
    regularisation: float = 0.01,
    tolerance: float = 1e-6,
) -> PipelineModel:
    """Two-class logistic regression on hashed, idf-weighted token counts.

    ``features`` bounds the model and what the executors send each iteration,
    whatever the size of the vocabulary. Every task sends its gradient each iteration, so
    there are no more tasks than cores or shares of ``TRAIN_BYTES``. The regularised loss has
    one optimum; enough ``iterations`` and a small ``tolerance`` reach it.
    """
    require_columns(df, tokens_col, "sentiment")
    labelled = df.select(tokens_col, encode_label(F.col("sentiment")).cast("double").alias("label")).filter(
        "label IS NOT NULL"
    )
    stages = [
        HashingTF(inputCol=tokens_col, outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(maxIter=iterations, regParam=regularisation, tol=tolerance, aggregationDepth=3),
    ]
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, ceil(stored_bytes(df) / TRAIN_BYTES))
    return Pipeline(stages=stages).fit(labelled.coalesce(tasks))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``label``, ``probabilities``, ``prediction`` and the per-row ``loss``."""
    scored = model.transform(df.withColumn("label", encode_label(F.col("sentiment"))))
    return (
        scored.drop("prediction")
        .withColumn("probabilities", vector_to_array("probability"))
        .drop("tf", "features", "rawPrediction", "probability")
        .withColumn("prediction", argmax(F.col("probabilities")))
        .withColumn("loss", cross_entropy(F.col("probabilities"), F.col("label")))
    )


def score_external(df: DataFrame, load_model: Callable[[], Callable[[pd.Series], list]], text_col: str = "review") -> DataFrame:
    """Add ``probabilities`` from an external model, loaded once per task; only the text goes to Python.

    ``load_model()`` returns a function from a batch of texts to class scores.
    """

    @F.pandas_udf("array<double>")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for part in parts:
            yield pd.Series(list(model(part)))

    scored = df.withColumn("probabilities", score(F.col(text_col)))
    return scored.withColumn("prediction", argmax(F.col("probabilities")))


def compare_tokenisations(
    train_df: DataFrame, eval_df: DataFrame, columns: Mapping[str, str], **options: object
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """One model per token column, and ``(tokenizer, split, samples, accuracy, f1, perplexity)``."""
    models = {name: train(train_df, col, **options) for name, col in columns.items()}
    tables = [
        evaluate(predict(models[name], eval_df), ["split"]).withColumn("tokenizer", F.lit(name)) for name in columns
    ]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return models, out


# ---- closed-form classifier ----------------------------------------------------


@dataclass(frozen=True)
class CountModel:
    """Smoothed token counts by class: a multinomial model with an exact solution.

    ``tokens(token, positive, negative)``; ``totals`` is one row of documents and tokens
    per class and the number of different tokens.
    """

    tokens: DataFrame
    totals: DataFrame
    smoothing: float = 1.0


def train_counts(df: DataFrame, tokens_col: str = "_words", smoothing: float = 1.0) -> CountModel:
    """Count tokens by class in one pass; rows without a class are left out."""
    require_columns(df, tokens_col, "sentiment")
    known = df.filter(F.col("sentiment").isin(*CLASSES))
    # outer, and NULL tokens dropped after it: plain explode would infer a filter that evaluates the tokens again
    exploded = known.select("sentiment", F.explode_outer(tokens_col).alias("token")).filter("token IS NOT NULL")
    by_class = [F.count_if(F.col("sentiment") == c).alias(c) for c in CLASSES]
    tokens = materialise(exploded.groupBy("token").agg(*by_class), "class-tokens")
    documents = known.agg(*[F.count_if(F.col("sentiment") == c).alias(f"{c}_documents") for c in CLASSES])
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_tokens") for c in CLASSES]
    totals = documents.crossJoin(tokens.agg(*sums, F.count(F.lit(1)).alias("vocabulary")))  # one row each
    return CountModel(tokens, materialise(totals, "class-totals"), smoothing)


def predict_counts(model: CountModel, df: DataFrame, tokens_col: str = "_words", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, label, probabilities, prediction, loss, *others)`` without the token column.

    A token adds the log odds of its smoothed counts; one that training has not seen
    counts as zero in both classes. The ``FREQUENT`` tokens of the training text are broadcast
    and added up where the document is; only the others are counted per document and looked up.
    """
    t = model.totals.first()  # one row
    a = model.smoothing
    room = [t[f"{c}_tokens"] + a * max(t.vocabulary, 1) for c in CLASSES]
    odds = F.ln((F.coalesce("positive", F.lit(0)) + a) / room[0]) - F.ln((F.coalesce("negative", F.lit(0)) + a) / room[1])
    prior = F.ln(F.lit((t.positive_documents + a) / (t.negative_documents + a)))
    exploded = df.select(id_col, F.explode_outer(tokens_col).alias("token")).filter("token IS NOT NULL")
    heavy = model.tokens.orderBy(F.desc(reduce(Column.__add__, [F.col(c) for c in CLASSES])), "token").limit(FREQUENT)
    known = exploded.join(F.broadcast(heavy.select("token", odds.alias("_known"))), "token", "left")
    # a document's frequent words are one row
    counted = known.groupBy(id_col, F.when(F.col("_known").isNull(), F.col("token")).alias("token")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_known").alias("_sum")
    )
    found = lookup(counted, model.tokens, ["token"], spread=salt_of(id_col))
    part = F.when(F.col("token").isNull(), F.col("_sum")).otherwise(F.col("n") * odds)
    scores = found.groupBy(id_col).agg(F.sum(part).alias("_odds"))
    others = [c for c in df.columns if c not in (id_col, tokens_col)]
    joined = df.select(id_col, *others).join(scores, id_col, "left")
    positive = 1 / (1 + F.exp(-(prior + F.coalesce("_odds", F.lit(0.0)))))
    return (
        joined.withColumn("label", encode_label(F.col("sentiment")))
        .withColumn("probabilities", F.array(1 - positive, positive))
        .withColumn("prediction", argmax(F.col("probabilities")))
        .withColumn("loss", cross_entropy(F.col("probabilities"), F.col("label")))
        .drop("_odds")
    )


def compare_count_tokenisations(train_df: DataFrame, eval_df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``(tokenizer, split, samples, accuracy, f1)`` of one count model per token column."""
    out = None
    for name, col in columns.items():
        scored = predict_counts(train_counts(train_df, col), eval_df.select("doc_id", "sentiment", "split", col), col)
        table = evaluate(scored, ["split"], with_loss=False).withColumn("tokenizer", F.lit(name))
        out = table if out is None else out.unionByName(table)
    return out
