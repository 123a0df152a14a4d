"""Reading and writing reviews, processed corpora, annotation sheets and models."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.functions.text import blank_to_null, words_of
from corpuslens.operators.classify import CountModel
from corpuslens.operators.ngram import DEALT, Dealt, NGramModel, part_of_context, read_counts, read_dealt, write_dealt
from corpuslens.schema import EVALUATION, REVIEWS, require_columns
from corpuslens.session import materialise

# Texts hold commas, quotes and line breaks: inner quotes are doubled, outer blanks
# kept. A quoted empty field is an empty text, an unquoted one is NULL.
CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # a NULL mark no text holds: with the default, an empty text would read as NULL too
    return spark.read.schema(schema).options(**CSV, multiLine=True, nullValue="\u0000").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**CSV).csv(path)


def read_csv_in_splits(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_csv``, but a large file with line breaks inside of quotes is read by many tasks.

    Lines are read split by split. A record begins at a line that an even number of quotes
    precedes in its file. Each split's quotes and beginnings are counted, one row a split, and
    summed over the splits before it; with that every line knows its record. Records are put
    together split by split; only the parts of those that a cut runs through are brought
    together by a second shuffle.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),  # follows the lines of a split
    )
    lines = lines.withColumn("quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))))
    split, inside = ["file", "split"], Window.partitionBy("file", "split").orderBy("at")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = lines.withColumn("before", before)
    # Of either parity at the split's start: how many records begin in it.
    begins = [F.count_if(F.pmod("before", F.lit(2)) == parity).cast("long").alias(f"begin_{parity}") for parity in (0, 1)]
    splits = counted.groupBy(*split).agg(F.sum("quotes").alias("quotes"), *begins)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2))
    splits = splits.withColumn("odd", odd)
    begun = F.when(F.col("odd") == 0, F.col("begin_0")).otherwise(F.col("begin_1"))
    splits = splits.withColumn("begun", begun).select(
        *split, "odd", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("ahead"),
        F.lead("odd", 1, 0).over(Window.partitionBy("file").orderBy("split")).alias("next_odd"),
    )
    splits = materialise(splits, "csv-splits")
    known = counted.join(F.broadcast(splits), split)  # a row per split of the files
    begin = F.pmod(F.col("before") + F.col("odd"), F.lit(2)) == 0
    upto = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = known.withColumn("record", F.col("ahead") + F.sum(begin.cast("long")).over(upto))
    parts = placed.groupBy(*split, "record").agg(
        F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"),
        F.first("odd").alias("odd"), F.first("ahead").alias("ahead"), F.first("next_odd").alias("next_odd"),
    )
    last = F.col("record") == F.max("record").over(Window.partitionBy(*split))
    parts = parts.select(
        *split, "record", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"),
        ((F.col("record") == F.col("ahead")) | (last & (F.col("next_odd") == 1))).alias("cut"),
    )
    stitched = parts.filter("cut").groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "text"))), lambda x: x["text"]), "\n").alias("text")
    )
    records = parts.filter("NOT cut").select("file", "record", "text").unionByName(stitched)
    text = F.regexp_replace("text", "\r$", "")
    options = {k: str(v) for k, v in {**CSV, "header": False, "nullValue": "\u0000"}.items()}
    names = schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    parsed = records.filter("record > 1").withColumn("text", text).filter("text <> ''")  # the first one is the header
    return parsed.select(F.from_csv("text", names, options).alias("r")).select("r.*")


def read_reviews(spark: SparkSession, path: str, schema: T.StructType = REVIEWS, *, in_splits: bool = False) -> DataFrame:
    """Review CSV; ``in_splits`` reads large files by many tasks although quoted line breaks may stand at any place."""
    return read_csv_in_splits(spark, path, schema) if in_splits else read_csv(spark, path, schema)


def write_reviews(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_csv(df.select(REVIEWS.fieldNames()), path, mode)


def save_corpus(df: DataFrame, path: str, *, words_as_text: bool = False, mode: str = "overwrite") -> None:
    """Processed corpus as Parquet; ``words_as_text`` stores ``_words_str`` instead of the array."""
    if df is None:
        raise ValueError("no data to save")
    require_columns(df, "review", "sentiment", "_char_len", "_word_count")
    keep = [c for c in ("doc_id", "review", "sentiment", "_char_len", "_word_count") if c in df.columns]
    out = df.select(*keep, *(["_words"] if "_words" in df.columns else []))
    if words_as_text and "_words" in df.columns:
        out = out.withColumn("_words_str", F.array_join("_words", " ")).drop("_words")
    out.write.mode(mode).parquet(path)


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Processed corpus back from Parquet; text-form words become an array again."""
    df = spark.read.parquet(path)
    if "_words_str" in df.columns:
        df = df.withColumn("_words", words_of(F.col("_words_str"))).drop("_words_str")
    return df


def save_bucketed(df: DataFrame, path: str, buckets: int, key: str = "doc_id") -> DataFrame:
    """Save a table cut into ``buckets`` by the hash of ``key``, sorted by it, and read it back.

    Tables with the same number of buckets meet by ``key`` without an exchange: documents, labels,
    ratings and encodings can be joined, and grouped by ``key``, while texts stay where they are.
    Rows are dealt to one task a bucket first, so that a bucket is one file.
    """
    name = _bucket_table()
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay
    return load_bucketed(df.sparkSession, path, df.schema, buckets, key)


def load_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int, key: str = "doc_id") -> DataFrame:
    """A table that ``save_bucketed`` wrote, also by another application."""
    name = _bucket_table()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _bucket_table() -> str:
    return f"bucketed_{uuid.uuid4().hex}"


def write_annotation_sheet(df: DataFrame, path: str) -> None:
    """Evaluation frame for raters. An existing sheet is never overwritten."""
    write_csv(df.select(EVALUATION.fieldNames()), path)


def read_annotation_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Rated sheet with blank ratings as NULL."""
    sheet = read_csv(spark, path, EVALUATION)
    return sheet.withColumns({c: blank_to_null(F.col(c)) for c in ("human_rating", "llm_judge")})


def merge_ratings(frame: DataFrame, sheet: DataFrame, column: str = "human_rating") -> DataFrame:
    """Ratings of a sheet on the current frame; unrated rows keep what they have."""
    rated = sheet.filter(F.col(column).isNotNull()).select("doc_id", F.col(column).alias("_rated"))
    joined = frame.join(rated, "doc_id", "left")
    return joined.withColumn(column, F.coalesce("_rated", column)).drop("_rated")


def write_selected(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The selected test rows as a review CSV."""
    write_reviews(df.filter("selected"), path, mode)


def save_classifier(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_count_classifier(model: CountModel, path: str) -> None:
    model.tokens.write.mode("overwrite").parquet(f"{path}/tokens")
    totals = model.totals.withColumn("smoothing", F.lit(model.smoothing))
    totals.write.mode("overwrite").parquet(f"{path}/totals")


def load_count_classifier(spark: SparkSession, path: str) -> CountModel:
    totals = spark.read.parquet(f"{path}/totals")
    return CountModel(spark.read.parquet(f"{path}/tokens"), totals.drop("smoothing"), totals.first().smoothing)


MODEL_SETTINGS = "sizes ARRAY<INT>, laplace BOOLEAN, buckets INT"


def save_ngram_model(model: NGramModel, path: str) -> None:
    """Count tables in a folder per size, so loading one size reads only its folder, and how they are smoothed.

    The counts keep their buckets. Totals that nobody asked for yet are added up into the model's files only.
    """
    spark, rows, dealt = model.counts.sparkSession, model.counts, model.dealt
    if dealt is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.withColumn("part", part_of_context()).repartition(buckets, *DEALT)
    else:
        buckets, rows = dealt.buckets, read_dealt(spark, dealt)
    write_dealt(rows, f"{path}/counts", model.sizes, buckets)
    model.summed().write.mode("overwrite").option("compression", "zstd").partitionBy("n").parquet(f"{path}/totals")
    settings = spark.createDataFrame([(list(model.sizes), model.laplace, buckets)], MODEL_SETTINGS)
    settings.write.mode("overwrite").parquet(f"{path}/settings")


def load_ngram_model(spark: SparkSession, path: str) -> NGramModel:
    totals = spark.read.schema("context ARRAY<STRING>, total BIGINT, n INT").parquet(f"{path}/totals")
    settings = spark.read.schema(MODEL_SETTINGS).parquet(f"{path}/settings").first()  # one row
    sizes = tuple(settings.sizes)
    dealt = settings.buckets and Dealt(f"{path}/counts", sizes, settings.buckets)  # older models have no buckets
    return NGramModel(read_counts(spark, f"{path}/counts"), sizes, settings.laplace, totals, dealt)
