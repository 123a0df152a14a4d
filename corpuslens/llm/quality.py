"""Quality rules on whole documents, with the frequency of lines across the documents of a host.

A line is normalised (lower case, digits as 0, one space for white space) and hashed.
For each host the distinct documents that hold a line are counted; a line above the
limit of its host is removed from its documents, and a document that loses most of its
words is rejected. Documents are told apart by the 64-bit hash of their whole text: exact
copies count once, so a copied document is not taken for a text of common lines; texts that
differ count each, however much they share.

Defined cases: a null or empty text has no words and fails the base rules; documents of
a null host form one host; repeated rows are copies; further columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.settings import frugal
from corpuslens.llm.words import hash_words, rows_of, slices, utf8, windows
from corpuslens.session import materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LEAST_DOCS = 3  # a line in this many documents of a host is never removed
MAX_SHARE = 0.02  # of the documents of a host
MIN_LEFT = 0.3  # of a document's words, after the removal of lines

_DIGITS = re.compile(r"[0-9]+")
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")
_SPACES = " \t\n\v\f\r"

FACTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<struct<hash: long, words: long>>"
)


def normal_line(line: str) -> str:
    return _DIGITS.sub("0", " ".join(line.lower().split()))


def line_hashes(lines: list[str]) -> np.ndarray:
    """Hash of each line's bytes as they are, without its division into words."""
    joined = pa.array([x.replace(" ", "_") for x in lines], pa.large_string())
    hashes, offsets = hash_words(*utf8(joined), lower=False)
    out = np.zeros(len(lines), np.uint64)
    full = np.diff(offsets) > 0
    out[full] = hashes[offsets[:-1][full]]
    return out.view(np.int64)


def repeated_words(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row: words inside three-word windows that occur twice or more."""
    n = len(offsets) - 1
    counts = np.zeros(n, np.int64)
    threes = windows(hashes, 3)
    for i in range(n):
        lo, hi = offsets[i], offsets[i + 1]
        if hi - lo < 3:
            continue
        own = threes[lo : hi - 2]
        order = np.argsort(own, kind="stable")
        same = own[order][1:] == own[order][:-1]
        if same.any():
            twice = np.zeros(len(own) + 2, bool)
            twice[:-2][order[1:][same]] = True
            twice[:-2][order[:-1][same]] = True
            starts = np.flatnonzero(twice[:-2])
            covered = np.zeros(hi - lo, bool)
            for k in range(3):
                covered[starts + k] = True
            counts[i] = covered.sum()
    return counts


def _measure(texts: pa.Array) -> dict[str, pa.Array]:
    hashes, offsets = hash_words(*utf8(texts), lower=False)
    repeats = repeated_words(hashes, offsets)
    chars, symbols, dups, lines, numbers = [], [], [], [], []
    at = [0]
    for text in texts.to_pylist():
        text = text or ""
        chars.append(len(text) - sum(text.count(c) for c in _SPACES))
        symbols.append(len(text) - len(text.translate(_SYMBOLS)))
        seen: set[str] = set()
        again = 0
        own: dict[str, int] = {}
        for line in text.split("\n"):
            n = len(line.encode().split())
            if n:
                again += line in seen
                seen.add(line)
                key = normal_line(line)
                own[key] = own.get(key, 0) + n
        dups.append(again)
        lines.extend(own)
        numbers.extend(own.values())
        at.append(len(lines))
    found = pa.StructArray.from_arrays(
        [pa.array(line_hashes(lines)), pa.array(numbers, pa.int64())], names=["hash", "words"]
    )
    return {
        "n_words": pa.array(np.diff(offsets)),
        "word_chars": pa.array(chars, pa.int64()),
        "n_symbols": pa.array(symbols, pa.int64()),
        "n_dup_lines": pa.array(dups, pa.int64()),
        "n_repeat_words": pa.array(repeats),
        "lines": pa.ListArray.from_arrays(pa.array(at, pa.int32()), found),
    }


def measure(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns, the hash of each text, its base counts and its distinct normalised lines."""
    kept = [*carry, "text_hash"]
    given = docs.select(*carry, F.xxhash64("text").alias("text_hash"), F.col("text").alias("_q_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "_q_text"), FACTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_q_text"):
                made = _measure(batch.column("_q_text"))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *made.values()], names=[*kept, *made]
                )

    return given.mapInArrow(frugal(run), schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def common_lines(measured: DataFrame, host: str, least_docs: int = LEAST_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """``(host, hash)`` of the lines above their host's limit.

    Rows are ``(host, line, text hash)``; duplicates go before the shuffle, then text hashes are
    counted per line, so a line that a third of all documents hold is spread by text first.
    """
    texts = measured.select(F.col(host).alias("host"), "text_hash").distinct()
    limits = texts.groupBy("host").agg(
        F.greatest(F.lit(least_docs), F.floor(F.count("*") * max_share)).alias("limit")
    )
    pairs = measured.select(F.col(host).alias("host"), "text_hash", F.explode("lines.hash").alias("hash")).distinct()
    counted = pairs.groupBy("host", "hash").agg(F.count("*").alias("docs")).filter(F.col("docs") > least_docs)
    same = counted.host.eqNullSafe(limits.host)
    return counted.join(limits, same).filter("docs > limit").select(counted.host.alias("host"), "hash")


def judge(docs: DataFrame, host: str = "source", *carry: str, **limits: float) -> DataFrame:
    """Verdict on each document: base counts, ``removed_words``, ``base_failed`` and ``kept``."""
    return _judge(materialise(measure(docs, host, *carry), "quality"), host, **limits)


def _packed(common: DataFrame) -> DataFrame:
    """One row per host: its common lines. Each stands in over 2 % of the host's documents."""
    return common.groupBy("host").agg(F.collect_set("hash").alias("_q_common"))


def _with_common(df: DataFrame, common: DataFrame, host: str, salts: int = 16) -> DataFrame:
    """Attach the host's common lines; a host is split into ``salts`` join keys."""
    packed = _packed(common).withColumn("_q_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = df.withColumn("_q_salt", F.pmod(F.hash("text_hash"), F.lit(salts)).cast("int"))
    joined = spread.join(packed, spread[host].eqNullSafe(packed.host) & (spread["_q_salt"] == packed["_q_salt"]), "left")
    return joined.select(*df.columns, F.coalesce("_q_common", F.array().cast("array<bigint>")).alias("_q_common"))


def _judge(measured: DataFrame, host: str, **limits: float) -> DataFrame:
    common = common_lines(measured, host, **limits)
    seen = _with_common(measured, common, host)
    removed = F.aggregate(
        F.filter("lines", lambda x: F.array_contains(F.col("_q_common"), x["hash"])),
        F.lit(0).cast("long"),
        lambda total, x: total + x["words"],
    )
    kept = ~F.col("base_failed") & (F.col("n_words") - F.col("removed_words") >= MIN_LEFT * F.col("n_words"))
    return (
        seen.withColumn("removed_words", removed)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", kept)
        .drop("lines", "_q_common", "text_hash")
    )


def clean(docs: DataFrame, host: str = "source", **limits: float) -> DataFrame:
    """Documents that are kept, without the lines above the limit of their host.

    ``docs`` is read twice: the second pass drops lines with the hosts' common lines at hand.
    """
    measured = materialise(measure(docs, host).drop("n_symbols", "word_chars", "n_dup_lines"), "quality")
    columns = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    salts = 16
    packed = _packed(common_lines(measured, host, **limits)).withColumnRenamed("host", "_q_host").withColumn(
        "_q_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    packed = materialise(packed, "common-lines")  # its size is known then, and Spark broadcasts it if small
    spread = docs.withColumn("_q_salt", F.pmod(F.xxhash64("text"), F.lit(salts)).cast("int"))
    joined = spread.join(packed, spread[host].eqNullSafe(packed["_q_host"]) & (spread["_q_salt"] == packed["_q_salt"]), "left")
    given = joined.select(*[spread[c] for c in columns], "_q_common")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                yield _cleaned(batch, columns)

    return given.mapInArrow(frugal(run), schema)


def _cleaned(batch: pa.RecordBatch, columns: list[str]) -> pa.RecordBatch:
    hashes, offsets = hash_words(*utf8(batch.column("text")), lower=False)
    repeats = repeated_words(hashes, offsets)
    n_words = np.diff(offsets)
    keep = (n_words >= MIN_WORDS) & (100 * repeats <= MAX_REPEAT_PERCENT * n_words)
    texts = batch.column("text").to_pylist()
    for i, common in enumerate(batch.column("_q_common").to_pylist()):
        if not keep[i] or not common:
            continue
        lines = texts[i].split("\n")
        bad = np.isin(line_hashes([normal_line(x) for x in lines]), common)
        bad &= np.array([bool(x.encode().split()) for x in lines])
        if bad.any():
            gone = sum(len(x.encode().split()) for x, b in zip(lines, bad) if b)
            keep[i] = n_words[i] - gone >= MIN_LEFT * n_words[i]
            texts[i] = "\n".join(x for x, b in zip(lines, bad) if not b)
    made = [pa.array(texts, batch.column(c).type) if c == "text" else batch.column(c) for c in columns]
    if "n_chars" in columns:
        at = columns.index("n_chars")
        sizes = [None if t is None else len(t) for t in texts]
        same = batch.column("n_chars").to_pylist()
        old = batch.column("text").to_pylist()
        made[at] = pa.array(
            [s if t == o else n for s, n, t, o in zip(same, sizes, texts, old)], batch.column("n_chars").type
        )
    return pa.RecordBatch.from_arrays(made, names=columns).filter(pa.array(keep))
