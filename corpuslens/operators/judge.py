"""Judge labels: prompts, logged responses and their attachment to predictions.

Calling a judge service is up to the caller; the tables around the call are here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.labels import answer_in, parse_answer

# Known judges, retry rule, request template.
JUDGES = ("openrouter", "gemini")
MAX_ATTEMPTS = 3
WAIT_STEP_S = 5
TEMPLATE = (
    "Decide whether the review below is positive or negative.\n"
    "Review:\n{review}\n"
    "Reply with one lower-case word, positive or negative."
)


def prompts(df: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``(doc_id, prompt)`` request table."""
    head, tail = template.split("{review}")
    return df.select("doc_id", F.concat(F.lit(head), F.col("review"), F.lit(tail)).alias("prompt"))


def resolve_responses(log: DataFrame) -> DataFrame:
    """Label per document from a log ``(doc_id, attempt, status, body)``.

    The last of at most three attempts decides: an answered request is parsed, a
    rate limit, error or timeout (NULL status) ends as negative and is flagged
    ``defaulted``. ``next_wait_s`` is the pause before a retry that is still due.
    """
    last = (
        log.filter(F.col("attempt") <= MAX_ATTEMPTS)
        .groupBy("doc_id")
        .agg(
            F.max("attempt").alias("attempt"),
            F.max_by("status", "attempt").alias("status"),
            F.max_by("body", "attempt").alias("body"),
        )
    )
    answer = answer_in(F.col("body"))
    answered = F.coalesce(F.col("status") == 200, F.lit(False)) & answer.isNotNull()
    retry_due = F.coalesce(F.col("status") == 429, F.lit(False)) & (F.col("attempt") < MAX_ATTEMPTS)
    return last.select(
        "doc_id",
        F.when(answered, parse_answer(answer)).otherwise("negative").alias("llm_judge"),
        (~answered).alias("defaulted"),
        F.when(retry_due, (F.col("attempt") * WAIT_STEP_S).cast("int")).alias("next_wait_s"),
    )


def attach_ratings(df: DataFrame, ratings: DataFrame, column: str) -> DataFrame:
    """Replace or add ``column`` from ``ratings(doc_id, column)``; unrated rows get NULL."""
    return df.drop(column).join(ratings.select("doc_id", column), "doc_id", "left")


def judge(
    df: DataFrame,
    model_type: str = "gemini",
    *,
    judgments: DataFrame | None = None,
    judge_fn: Callable[[pd.Series], pd.Series] | None = None,
) -> DataFrame:
    """Add ``llm_judge`` from a judgment table or from a function of review batches."""
    if model_type not in JUDGES:
        raise ValueError(f"model_type must be one of {', '.join(JUDGES)}, got {model_type!r}")
    if (judgments is None) == (judge_fn is None):
        raise ValueError("give either judgments or judge_fn")
    if judgments is not None:
        return attach_ratings(df, judgments, "llm_judge")

    @F.pandas_udf("string")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield judge_fn(part)

    return df.drop("llm_judge").withColumn("llm_judge", rate(F.col("review")))
