"""Training-data pipeline: five stages over ``documents``, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept;
all but the last return the columns of ``documents``. The last adds ``ids`` (packed
little-endian 32-bit), ``n_tokens`` and ``round_trip``, whether the ids decode to the text.

Defined cases: a null or empty text has no words and goes with the first stage; repeated rows
are exact copies, of which the second stage keeps one; very long texts are read whole; an empty
table stays empty through all stages; further columns come along unchanged, and one that has
the name of a column that the last stage adds comes along as ``given_`` and its name. The tables
that stages write on the way are deleted once the next stage's table is there.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import bpe, decontamination, jaccard, pii, quality
from corpuslens.llm.settings import small_batches
from corpuslens.session import ensure_folder, materialise, release, ship_code, written
from corpuslens.sources.tables import table

HERE = os.path.dirname(os.path.abspath(__file__))
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _ready(spark: SparkSession) -> None:
    ensure_folder(spark)
    small_batches(spark)
    ship_code(spark, HERE, "corpuslens")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are too common on their host."""
    _ready(spark)
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _ready(spark)
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    _ready(spark)
    items = spark.read.schema("item_id BIGINT, text STRING").parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.remove(docs, items)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    _ready(spark)
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, decoded again to see that nothing is lost."""
    _ready(spark)
    docs = docs.withColumnsRenamed({c: f"given_{c}" for c in ("ids", "decoded", "n_tokens", "round_trip") if c in docs.columns})
    coded = bpe.round_trip(docs, TOKENIZER)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.withColumn("n_tokens", bpe.n_ids()).withColumn("round_trip", same).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Sketches, edit distances, a trained classifier and merges cannot be written in SQL; tests hold
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs, begun = table(spark, sf_dir, "documents"), written(spark)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark, begun, keep=f"stage-{name}-")
    return docs
