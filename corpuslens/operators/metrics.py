"""Metrics of predicted against gold labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.labels import decode_label
from corpuslens.schema import LABEL_IDS


def accuracy(prediction: str = "prediction", label: str = "label") -> Column:
    return F.avg((F.col(prediction) == F.col(label)).cast("double"))


def binary_f1(prediction: str = "prediction", label: str = "label") -> Column:
    """F1 of class 1; 0 when nothing is or should be positive."""
    p, g = F.col(prediction), F.col(label)
    tp = F.count_if((p == 1) & (g == 1))
    wrong = F.count_if((p == 1) & (g == 0)) + F.count_if((p == 0) & (g == 1))
    return F.coalesce(F.try_divide((2 * tp).cast("double"), 2 * tp + wrong), F.lit(0.0))


def classifier_perplexity(loss: str = "loss") -> Column:
    return F.exp(F.avg(loss))


def evaluate(df: DataFrame, by: Sequence[str] = (), with_loss: bool = True) -> DataFrame:
    """Accuracy, F1 and perplexity of every group in one aggregation."""
    values = [F.count(F.lit(1)).alias("samples"), accuracy().alias("accuracy"), binary_f1().alias("f1")]
    if with_loss:
        values.append(classifier_perplexity().alias("perplexity"))
    return df.groupBy(*by).agg(*values)


def confusion(df: DataFrame, by: Sequence[str] = (), prediction: str = "prediction", label: str = "label") -> DataFrame:
    """``(*by, label, prediction, cnt)`` with all four cells, zeros included."""
    classes = sorted(LABEL_IDS.values())
    cells = [(g, p) for g in classes for p in classes]
    counts = df.groupBy(*by).agg(
        *[F.count_if((F.col(label) == g) & (F.col(prediction) == p)).alias(f"c{g}{p}") for g, p in cells]
    )
    long = F.explode(F.array(*[
        F.struct(F.lit(g).alias("label"), F.lit(p).alias("prediction"), F.col(f"c{g}{p}").alias("cnt")) for g, p in cells
    ]))
    return counts.select(*by, long.alias("c")).select(*by, "c.label", "c.prediction", "c.cnt")


def evaluation_frame(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Readable labels plus empty columns for the human and the judge."""
    return df.select(
        "doc_id",
        "review",
        decode_label(F.col(prediction)).alias("model_prediction"),
        decode_label(F.col(label)).alias("gold_label"),
        F.lit(None).cast("string").alias("human_rating"),
        F.lit(None).cast("string").alias("llm_judge"),
    )
