"""Vocabularies and padded id sequences for next-word training."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.labels import encode_label
from corpuslens.operators.lookup import translate
from corpuslens.operators.ordering import dense_rank_rows, seeded_rank
from corpuslens.operators.stats import at_position
from corpuslens.schema import BOS, EOS, PAD, SPECIAL_IDS, UNK, require_columns
from corpuslens.session import materialise

NEEDS_WORDS = "Sequences need word tokens: run operators.corpus.tokenise first."
PAD_ID = SPECIAL_IDS[PAD]
UNK_ID = SPECIAL_IDS[UNK]


def build_vocabulary(df: DataFrame, min_freq: int = 10, words_col: str = "_words", id_col: str = "doc_id") -> DataFrame:
    """``(token, id, cnt)``: the special tokens, then every token with at least
    ``min_freq`` occurrences, numbered in the order the corpus first shows them.
    """
    require_columns(df, words_col, id_col, hint=NEEDS_WORDS)
    exploded = df.select(id_col, F.posexplode_outer(words_col).alias("pos", "token")).filter("token IS NOT NULL")
    candidates = (
        exploded.groupBy("token")
        .agg(F.count(F.lit(1)).alias("cnt"), F.min(at_position(id_col, "pos")).alias("first"))
        .filter((F.col("cnt") >= min_freq) & ~F.col("token").isin(list(SPECIAL_IDS)))
    )
    ranked = dense_rank_rows(candidates, "first")
    specials = df.sparkSession.createDataFrame(
        [(t, i, 0) for t, i in SPECIAL_IDS.items()], "token STRING, id INT, cnt BIGINT"
    )
    numbered = ranked.select("token", (F.col("rank") + len(SPECIAL_IDS)).cast("int").alias("id"), "cnt")
    return materialise(specials.unionByName(numbered), "vocabulary")


def vocabulary_count(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.agg(F.count(F.lit(1)).alias("vocabulary_size"))


def with_boundaries(words: Column, start: str | None = BOS, end: str | None = EOS) -> Column:
    """Optional start and end token around a word array."""
    parts = [F.array(F.lit(start))] if start else []
    parts.append(F.coalesce(words, F.array().cast("array<string>")))
    parts += [F.array(F.lit(end))] if end else []
    return F.concat(*parts)


def truncate_keep_last(ids: Column, max_length: int | None) -> Column:
    """Cut to ``max_length`` but keep the last id, which is the end token."""
    if max_length is None:
        return ids
    cut = F.concat(F.slice(ids, 1, max_length - 1), F.slice(ids, -1, 1)) if max_length > 1 else F.slice(ids, -1, 1)
    return F.when(F.size(ids) > max_length, cut).otherwise(ids)


def input_of(ids: Column) -> Column:
    """All ids but the last; a single pad if there is nothing to predict."""
    return F.when(F.size(ids) > 1, F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(1)))).otherwise(
        F.array(F.lit(PAD_ID))
    )


def target_of(ids: Column) -> Column:
    """All ids but the first; a single pad if there is nothing to predict."""
    return F.when(F.size(ids) > 1, F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(1)))).otherwise(
        F.array(F.lit(PAD_ID))
    )


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    *,
    start: str | None = BOS,
    end: str | None = EOS,
    words_col: str = "_words",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(doc_id, ids)``; unknown words become the unknown id, empty documents stay."""
    require_columns(df, words_col, id_col, hint=NEEDS_WORDS)
    bounded = df.select(id_col, with_boundaries(F.col(words_col), start, end).alias("words"))
    table = vocabulary.select(F.col("token").alias("key"), F.col("id").alias("value"))
    return translate(bounded, table, array="words", out="ids", default=F.lit(UNK_ID), id_col=id_col)


def decode(df: DataFrame, vocabulary: DataFrame, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, text)``; unknown ids read as the unknown token."""
    if vocabulary is None:
        raise ValueError("vocabulary not built: call build_vocabulary first")
    table = vocabulary.select(F.col("id").alias("key"), F.col("token").alias("value"))
    words = translate(df, table, array=ids_col, out="words", default=F.lit(UNK), id_col=id_col)
    return words.select(id_col, F.array_join("words", " ").alias("text"))


def training_pairs(encoded: DataFrame, max_length: int | None = None) -> DataFrame:
    """Truncate ``ids`` and add ``input_ids`` and ``target_ids``."""
    ids = encoded.withColumn("ids", truncate_keep_last(F.col("ids"), max_length))
    return ids.withColumn("input_ids", input_of(F.col("ids"))).withColumn("target_ids", target_of(F.col("ids")))


def batches(
    pairs: DataFrame,
    batch_size: int = 32,
    *,
    shuffle_seed: int | None = None,
    epoch: int = 0,
    id_col: str = "doc_id",
) -> DataFrame:
    """Number the rows into batches and pad each to the longest row of its batch.

    Adds ``batch_id`` and ``slot``. Only ids and lengths are ranked; the sequences
    move once, to meet their batch number and width.
    """
    lengths = pairs.select(id_col, F.size("input_ids").alias("length"))
    if shuffle_seed is None:
        ranked = dense_rank_rows(lengths, id_col)
    else:
        ranked = seeded_rank(lengths, f"{shuffle_seed}:{epoch}", id_col)
    placed = ranked.select(
        id_col, "length",
        F.floor(F.col("rank") / batch_size).cast("bigint").alias("batch_id"),
        F.pmod("rank", F.lit(batch_size)).cast("int").alias("slot"),
    )
    widths = placed.groupBy("batch_id").agg(F.max("length").alias("width"))
    placed = placed.join(widths, "batch_id").drop("length")

    def padded(name: str) -> Column:
        return F.concat(name, F.array_repeat(F.lit(PAD_ID), F.col("width") - F.size(name))).alias(name)

    others = [c for c in pairs.columns if c not in (id_col, "input_ids", "target_ids", "ids")]
    return pairs.join(placed, id_col).select(
        "batch_id", "slot", id_col, padded("input_ids"), padded("target_ids"), *others
    )


def batch_count(df: DataFrame, batch_size: int = 32) -> DataFrame:
    return df.agg(F.ceil(F.count(F.lit(1)) / F.lit(batch_size)).cast("bigint").alias("batches"))


def training_batches(
    df: DataFrame,
    vocabulary: DataFrame,
    *,
    batch_size: int = 32,
    shuffle_seed: int | None = None,
    epoch: int = 0,
    start: str | None = BOS,
    end: str | None = EOS,
    max_length: int | None = None,
) -> DataFrame:
    """Tokenised reviews to padded batches with the encoded label."""
    if vocabulary is None:
        raise ValueError("vocabulary not built: call build_vocabulary first")
    pairs = training_pairs(encode(df, vocabulary, start=start, end=end), max_length)
    labels = df.select("doc_id", encode_label(F.col("sentiment")).alias("label"))
    # written once: the widths and the padding both read it
    pairs = materialise(pairs.join(labels, "doc_id"), "training-pairs")
    return batches(pairs, batch_size, shuffle_seed=shuffle_seed, epoch=epoch)


def collate(batched: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Hand each batch to ``fn(pandas.DataFrame) -> pandas.DataFrame``, for tensor export."""
    return batched.groupBy("batch_id").applyInPandas(fn, schema)


def sequence_perplexity(losses: DataFrame, weighting: str = "token", loss: Column | None = None) -> DataFrame:
    """Perplexity from ``(batch_id, target, loss)``, one row per cell; pads do not count as loss.

    ``token`` averages over real tokens. ``padded_batch`` weights the mean loss of
    each batch by all its cells, pads included. ``loss`` replaces the loss column
    by any expression.
    """
    real = F.col("target") != PAD_ID
    value = F.col("loss") if loss is None else loss
    if weighting == "token":
        mean = F.avg(F.when(real, value))
        return losses.agg(F.coalesce(F.exp(mean), F.lit(1.0)).alias("perplexity"))
    if weighting != "padded_batch":
        raise ValueError(f"weighting must be 'token' or 'padded_batch', got {weighting!r}")
    per_batch = losses.groupBy("batch_id").agg(
        F.avg(F.when(real, value)).alias("mean_loss"), F.count(F.lit(1)).alias("cells")
    )
    weighted = F.sum(F.col("mean_loss") * F.col("cells")) / F.sum("cells")
    return per_batch.agg(F.coalesce(F.exp(weighted), F.lit(1.0)).alias("perplexity"))
