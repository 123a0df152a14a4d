"""Labels, scores and judge answers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.schema import LABEL_IDS


def encode_label(c: Column) -> Column:
    """``negative``/``positive`` to 0/1; any other value gives NULL."""
    out = F.lit(None).cast("int")
    for name, code in LABEL_IDS.items():
        out = F.when(c == name, F.lit(code)).otherwise(out)
    return out


def decode_label(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, code in LABEL_IDS.items():
        out = F.when(c == code, F.lit(name)).otherwise(out)
    return out


def argmax(scores: Column) -> Column:
    """Zero-based index of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(probabilities: Column, gold: Column) -> Column:
    """Loss of the gold class; a probability of zero gives infinity, not NULL."""
    p = F.get(probabilities, gold)
    return F.when(p == 0, F.lit(float("inf"))).otherwise(-F.ln(p))


def parse_answer(answer: Column) -> Column:
    """Judge answer to label: a named class wins, then a first word containing ``pos``."""
    text = F.lower(F.trim(answer))
    first = F.coalesce(F.get(F.filter(F.split(text, r"\s+"), lambda w: w != ""), F.lit(0)), F.lit(""))
    return (
        F.when(F.contains(text, F.lit("positive")), "positive")
        .when(F.contains(text, F.lit("negative")), "negative")
        .when(F.contains(first, F.lit("pos")), "positive")
        .otherwise("negative")
    )


def answer_in(body: Column) -> Column:
    """Answer text inside the JSON body of a chat completion."""
    return F.get_json_object(body, "$.choices[0].message.content")


def token_loss(scores: Column, target: Column, given: str = "logits") -> Column:
    """Cross entropy of the target's score (an array of one score per class, zero-based target).

    ``given`` says what the scores are. Raw logits are normalised here. Scores that are
    given as log probabilities but do not add up to one end the job: taken as they are,
    they would be a wrong loss.
    """
    if given not in ("logits", "log_probabilities"):
        raise ValueError(f"given must be 'logits' or 'log_probabilities', got {given!r}")
    top = F.array_max(scores)
    mass = F.ln(F.aggregate(scores, F.lit(0.0), lambda total, x: total + F.exp(x - top))) + top
    own = F.get(scores, target)
    if given == "logits":
        return mass - own
    wrong = F.raise_error(F.lit("the scores are no log probabilities: use given='logits' for raw logits"))
    return F.when(F.abs(mass) <= 1e-6, -own).otherwise(wrong.cast("double"))
