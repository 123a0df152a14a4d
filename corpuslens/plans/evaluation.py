"""Evaluation of a classifier: split metrics, subsample, ratings, agreement."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import agreement, judge, metrics


@dataclass(frozen=True)
class Evaluation:
    split_metrics: DataFrame
    split_confusion: DataFrame
    subsample_metrics: DataFrame
    frame: DataFrame
    agreement: DataFrame
    both_wrong: DataFrame
    agree_but_wrong: DataFrame


def evaluate_classifier(
    scored: DataFrame, human: DataFrame | None = None, judgments: DataFrame | None = None
) -> Evaluation:
    """``scored`` has split, selected, review, label, prediction and loss.

    ``human`` and ``judgments`` are rating tables ``(doc_id, human_rating | llm_judge)``;
    the analysis of agreement covers the selected rows.
    """
    chosen = scored.filter("selected")
    frame = metrics.evaluation_frame(chosen)
    if human is not None:
        frame = judge.attach_ratings(frame, human, "human_rating")
    if judgments is not None:
        frame = judge.attach_ratings(frame, judgments, "llm_judge")
    return Evaluation(
        split_metrics=metrics.evaluate(scored, ["split"]),
        split_confusion=metrics.confusion(scored, ["split"]),
        subsample_metrics=metrics.evaluate(chosen.withColumn("split", F.lit("selected")), ["split"], with_loss=False),
        frame=frame,
        agreement=agreement.pairwise_agreement(frame),
        both_wrong=agreement.both_wrong(frame),
        agree_but_wrong=agreement.agree_but_wrong(frame),
    )
