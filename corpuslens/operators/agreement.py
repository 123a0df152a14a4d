"""Agreement between the model, the gold labels, the judge and human raters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import blank_to_null, preview

# Report name and columns of every rater pair.
PAIRS = (
    ("model_gold", "model_prediction", "gold_label"),
    ("llm_gold", "llm_judge", "gold_label"),
    ("model_llm", "model_prediction", "llm_judge"),
    ("human_gold", "human_rating", "gold_label"),
    ("human_model", "human_rating", "model_prediction"),
    ("human_llm", "human_rating", "llm_judge"),
)
RATERS = ("human_rating", "llm_judge")


def _has_rating(name: str) -> Column:
    return F.coalesce(F.max(blank_to_null(F.col(name)).isNotNull()), F.lit(False))


def rating_availability(df: DataFrame) -> DataFrame:
    """``(rater, available)``: is there any rating that is neither NULL nor blank?"""
    present = [r for r in RATERS if r in df.columns]
    return df.agg(*[_has_rating(r).alias(r) for r in present]).unpivot([], present, "rater", "available")


def pairwise_agreement(df: DataFrame, denominator: str = "all") -> DataFrame:
    """``(pair, agree, total, percent)``; a blank agrees with nothing.

    Pairs with a rater who rated nothing are left out. ``denominator="rated"``
    divides by the rows both raters rated instead of all rows.
    """
    if denominator not in ("all", "rated"):
        raise ValueError(f"denominator must be 'all' or 'rated', got {denominator!r}")
    pairs = [p for p in PAIRS if p[1] in df.columns and p[2] in df.columns]
    names = sorted({c for _, a, b in pairs for c in (a, b)})
    clean = df.select(*[blank_to_null(F.col(c)).alias(c) for c in names])
    counts = []
    for pair, a, b in pairs:
        counts.append(F.count_if(F.col(a) == F.col(b)).alias(f"{pair}_agree"))
        counts.append(F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"{pair}_rated"))
    counts += [F.count(c).alias(f"{c}_any") for c in names]
    totals = clean.agg(F.count(F.lit(1)).alias("rows"), *counts)
    entries = [
        F.struct(
            F.lit(pair).alias("pair"),
            F.col(f"{pair}_agree").alias("agree"),
            F.col("rows" if denominator == "all" else f"{pair}_rated").alias("total"),
            ((F.col(f"{a}_any") > 0) & (F.col(f"{b}_any") > 0)).alias("available"),
        )
        for pair, a, b in pairs
    ]
    percent = F.coalesce(F.try_divide(F.col("e.agree") * 100.0, F.col("e.total")), F.lit(0.0))
    return (
        totals.select(F.explode(F.array(*entries)).alias("e"))
        .filter("e.available")
        .select("e.pair", "e.agree", "e.total", percent.alias("percent"))
    )


def _raters_clean(df: DataFrame) -> DataFrame:
    return df.withColumns({c: blank_to_null(F.col(c)) for c in ("model_prediction", "llm_judge", "gold_label")})


def both_wrong(df: DataFrame) -> DataFrame:
    """Model and judge both differ from gold; a missing label differs."""
    differs = [~F.col(c).eqNullSafe(F.col("gold_label")) for c in ("model_prediction", "llm_judge")]
    return _raters_clean(df).filter(differs[0] & differs[1])


def agree_but_wrong(df: DataFrame) -> DataFrame:
    """Model and judge agree with each other and differ from gold."""
    same = F.col("model_prediction") == F.col("llm_judge")
    return _raters_clean(df).filter(same & ~F.col("model_prediction").eqNullSafe(F.col("gold_label")))


def examples(cases: DataFrame, k: int = 3) -> DataFrame:
    """The first ``k`` cases with a short preview of the text."""
    return cases.orderBy("doc_id").limit(k).select(
        "doc_id", preview(F.col("review")).alias("preview"), "gold_label", "model_prediction", "llm_judge"
    )
