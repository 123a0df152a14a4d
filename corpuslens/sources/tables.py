"""Reading the corpus tables and binding them to the review schema."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions.labels import decode_label

# Stated schemas spare the footer-reading job of schema inference.
SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


PART_BYTES = 32 << 20  # of a stored table: what one task works on must not grow with the input


def parts_of(spark: SparkSession, folder: str, name: str) -> int:
    """Tasks to deal a table's rows to: every core, and more where a task's share would pass ``PART_BYTES``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
    stored = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return max(spark.sparkContext.defaultParallelism, ceil(stored / PART_BYTES))


def _spread(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    return df if parts is None else df.repartition(parts, *keys)


def _labelled(spark: SparkSession, folder: str, how: str, parts: int | None) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", F.col("text").alias("review"))
    labels = table(spark, folder, "labels").select("doc_id", decode_label(F.col("quality")).alias("sentiment"))
    return _spread(documents.join(labels, "doc_id", how), parts, "doc_id")


def reviews(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """Labelled documents as ``(doc_id, review, sentiment)``.

    ``parts`` deals the rows anew, for a table of fewer files than there are cores.
    """
    return _labelled(spark, folder, "inner", parts)


def reviews_all(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """All documents; unlabelled ones have a NULL sentiment."""
    return _labelled(spark, folder, "left", parts)


def turns(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """Conversation turns as a second corpus; the class is the role."""
    scan = table(spark, folder, "conversations")
    df = scan.select("conv_id", "turn", F.col("text").alias("review"), F.col("role").alias("sentiment"))
    return _spread(df, parts, "conv_id", "turn")
