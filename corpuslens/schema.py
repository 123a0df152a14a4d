"""Column names, table schemas and schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Label encoding and the special tokens with their ids.
LABEL_IDS = {"negative": 0, "positive": 1}
CLASSES = ("positive", "negative")
OVERALL = "overall"
PAD, UNK, BOS, EOS = "<PAD>", "<UNK>", "<s>", "</s>"
SPECIAL_IDS = {PAD: 0, UNK: 1, BOS: 2, EOS: 3}

REVIEWS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("review", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])

EVALUATION = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("review", T.StringType()),
    T.StructField("model_prediction", T.StringType()),
    T.StructField("gold_label", T.StringType()),
    T.StructField("human_rating", T.StringType()),
    T.StructField("llm_judge", T.StringType()),
])


def require_columns(df: DataFrame, *names: str, hint: str = "") -> None:
    """Raise ``ValueError`` before any job runs if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {', '.join(missing)}; found {', '.join(df.columns)}. {hint}".strip())
