"""Rewriting words through a table of forms: stems, lemmas.

The work per word is done once per distinct word; the corpus then looks it up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.functions import wordlists
from corpuslens.functions.stem import porter
from corpuslens.operators.lookup import lookup, salt_of
from corpuslens.session import materialise


def distinct_words(df: DataFrame, words_col: str = "_words") -> DataFrame:
    """``(token, cnt)``."""
    return (
        df.select(F.explode_outer(words_col).alias("token"))
        .filter("token IS NOT NULL")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


@F.pandas_udf(T.StringType())
def porter_stem(words: pd.Series) -> pd.Series:
    return words.map(porter)


def stem_table(df: DataFrame, words_col: str = "_words") -> DataFrame:
    """``(token, form, cnt)`` with the Porter stem of every distinct word."""
    words = distinct_words(df, words_col)
    return materialise(words.select("token", porter_stem("token").alias("form"), "cnt"), "stems")


def lemma_table(df: DataFrame, lemmas: DataFrame, words_col: str = "_words") -> DataFrame:
    """``(token, form, cnt)`` of every word of the corpus; ``form`` is NULL if ``lemmas(form, lemma)`` has none."""
    pairs = lemmas.select(F.col("form").alias("token"), F.col("lemma").alias("form"))
    words = distinct_words(df, words_col)
    return materialise(words.join(pairs, "token", "left").select("token", "form", "cnt"), "lemmas")


def lemmas_by_rules(
    words: DataFrame,
    parts: Sequence[str] = ("noun",),
    lexicon: DataFrame | None = None,
    endings: Mapping[str, Sequence[tuple[str, str]]] = wordlists.DETACHED_ENDINGS,
    irregular: Mapping[str, Mapping[str, str]] = wordlists.IRREGULAR_LEMMAS,
) -> DataFrame:
    """``(form, lemma)`` of the distinct words ``(token, ...)`` that have another form as their lemma.

    An irregular form has the lemma of the table, the first part of speech that lists it. Of
    the others, each ending that fits is detached, and the candidates are looked up in
    ``lexicon(token)``, by default the words themselves: the lemma is the shortest candidate found,
    of equally short ones that of the first rule. A word of the ending alone is no inflected form.
    """
    known = (words if lexicon is None else lexicon).select(F.col("token").alias("lemma")).distinct()
    exceptions: dict[str, str] = {}
    for part in parts:
        exceptions = dict(irregular.get(part, {})) | exceptions
    rules = [rule for part in parts for rule in endings[part]]
    token, length = F.col("token"), F.char_length("token")
    listed = F.lit(None).cast("string")
    for form, lemma in exceptions.items():
        listed = F.when(token == form, lemma).otherwise(listed)
    candidates = [
        F.when(
            F.endswith(token, F.lit(old)) & (length > len(old)),
            F.struct(F.lit(place).alias("rule"), F.concat(F.substring(token, F.lit(1), length - len(old)), F.lit(new)).alias("lemma")),
        )
        for place, (old, new) in enumerate(rules)
    ]
    split = materialise(
        words.select("token", listed.alias("listed"), F.filter(F.array(*candidates), lambda c: c.isNotNull()).alias("tried")),
        "lemma-candidates",
    )
    tried = split.filter("listed IS NULL").select("token", F.explode("tried").alias("c")).select("token", "c.*")
    found = tried.join(known, "lemma").groupBy("token").agg(
        F.min(F.struct(F.char_length("lemma").alias("size"), "rule", "lemma")).alias("best")
    )
    regular = found.select(F.col("token").alias("form"), F.col("best.lemma").alias("lemma"))
    return regular.unionByName(split.filter("listed IS NOT NULL").select(F.col("token").alias("form"), F.col("listed").alias("lemma")))


def rewrite(df: DataFrame, forms: DataFrame, words_col: str = "_words", id_col: str = "doc_id") -> DataFrame:
    """Replace each word by its form, if it has one, and rebuild text and lengths."""
    exploded = df.select(id_col, F.posexplode_outer(words_col).alias("pos", "token"))
    table, counts = forms.select("token", "form"), forms.select("token", "cnt")
    found = lookup(exploded, table, ["token"], spread=salt_of(id_col, "pos"), counts=counts)
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("form", "token").alias("w")))
    rebuilt = (
        found.groupBy(id_col)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(id_col, F.transform("entries", lambda e: e["w"]).alias(words_col))
    )
    text = F.array_join(words_col, " ")
    others = [c for c in df.columns if c not in (words_col, "review", "_word_count", "_char_len")]
    return (
        df.select(*others)
        .join(rebuilt, id_col)
        .withColumn("review", text)
        .withColumn("_word_count", F.size(words_col))
        .withColumn("_char_len", F.char_length("review"))
    )


def stem(df: DataFrame, words_col: str = "_words") -> DataFrame:
    return rewrite(df, stem_table(df, words_col), words_col)


def lemmatise(
    df: DataFrame, lemmas: DataFrame | None = None, words_col: str = "_words", parts: Sequence[str] = ("noun",)
) -> DataFrame:
    """Replace words by their lemma in ``lemmas(form, lemma)``, or by the rules for ``parts`` of speech."""
    if lemmas is None:
        words = materialise(distinct_words(df, words_col), "lemma-words")
        table = words.join(lemmas_by_rules(words, parts).select(F.col("form").alias("token"), F.col("lemma").alias("form")), "token", "left")
        return rewrite(df, materialise(table.select("token", "form", "cnt"), "lemmas"), words_col)
    return rewrite(df, lemma_table(df, lemmas, words_col), words_col)
