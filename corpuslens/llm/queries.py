"""Registered queries of this subpackage, one per operator, and the SQL that checks some of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import (
    alignment, bpe, conversations, decontamination, jaccard, licenses, lm, mixing, pii, quality, sharding, site_style, warc,
)
from corpuslens.llm.settings import small_batches
from corpuslens.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


@query
def op2_warc_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "stored_bytes", "verified"
    )


SQL["op2_warc_round_trip"] = """
WITH p AS (
    SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), l AS (
    SELECT html, max(page_id) AS largest FROM p WHERE n >= 1000 GROUP BY html
)
SELECT p.page_id,
       CAST(n AS BIGINT) AS payload_bytes,
       sha1(p.html) AS payload_digest,
       CASE WHEN p.page_id <> l.largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> l.largest THEN l.largest END AS refers_to,
       p.url,
       CAST(CASE WHEN p.page_id <> l.largest THEN 0 ELSE n END AS BIGINT) AS stored_bytes,
       TRUE AS verified
FROM p LEFT JOIN l ON p.html = l.html
"""


@query
def op3_hypergeometric_shards(spark: SparkSession, sf: str) -> DataFrame:
    items = sharding.document_items(documents(spark, sf))
    dealt = sharding.shuffle(items, "doc_id", "text_crc32", "size")
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op7_cross_document_lines(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf), "source", "doc_id")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )


@query
def op9_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.round_trip(documents(spark, sf).select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        bpe.n_ids().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op8_ngram_jaccard_classes(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.classes(documents(spark, sf).select("doc_id", "text"))


SQL["op8_ngram_jaccard_classes"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
    FROM w
), n AS (
    SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
    SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)
), r AS (
    SELECT doc_id AS a, doc_id AS b FROM n
    UNION
    SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT doc_id, n AS n_shingles, min(b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY ALL
"""


@query
def op1_weak_supervision_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.report(documents(spark, sf).select("doc_id", "text"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, pii.KINDS),
        F.sha2(F.encode(pii.span_list("base"), "UTF-8"), 256).alias("base_sha256"),
        pii.span_list("spans").alias("spans"),
    )


@query
def op5_license_windows(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf))


@query
def op6_pigeonhole_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    items = spark.read.schema("item_id BIGINT, text STRING").parquet(f"{sf}/benchmark.parquet")
    return decontamination.leaks(documents(spark, sf), items)


@query
def op4_site_style_text(spark: SparkSession, sf: str) -> DataFrame:
    texts = site_style.main_text(table(spark, sf, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op10_log_bilinear_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm.scores(documents(spark, sf))


@query
def op11_pair_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment(documents(spark, sf), *paths).withColumnRenamed("id", "doc_id")


@query
def op12_entropy_balanced_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "rate")


@query
def op13_suffix_automaton_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.report(table(spark, sf, "conversations"))
