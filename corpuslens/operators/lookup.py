"""Left lookup of a dictionary table that stays even when a few keys dominate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.session import materialise

HOT_ROWS = 1_000
CHUNK = 1_024  # elements that share a dictionary
DRAWERS = 16  # of a dictionary: a map is searched entry by entry


def lookup(
    facts: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    *,
    spread: Column,
    hot_rows: int = HOT_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``facts LEFT JOIN table USING (keys)``; ``table`` has unique keys.

    The ``hot_rows`` heaviest keys of the facts are broadcast with what the table holds
    for them, if anything. A row they resolve, or one with a NULL key, carries the salt
    ``spread`` (> 0) through the shuffle, so no key that remains exceeds the share of the
    ``hot_rows``-th heaviest one. ``counts(keys, cnt)`` passes in how often the keys occur;
    without it the facts are written once, and counted and joined from there, so that what
    they are made of is computed once.
    """
    keys = list(keys)
    values = [c for c in table.columns if c not in keys]
    if counts is None:
        facts = materialise(facts, "facts")
        counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    heavy = counts.orderBy(F.desc("cnt"), *keys).limit(hot_rows).select(*keys)
    packed = heavy.join(table, keys, "left").select(*keys, F.struct(*values).alias("_hot"), F.lit(True).alias("_seen"))
    marked = facts.join(F.broadcast(packed), keys, "left")
    settled = reduce(Column.__or__, [F.col(k).isNull() for k in keys], F.col("_seen").isNotNull())
    marked = marked.withColumn("_salt", F.when(settled, spread).otherwise(0))
    cold = table.select(*keys, F.struct(*values).alias("_cold"), F.lit(0).alias("_salt"))
    joined = marked.join(cold, [*keys, "_salt"], "left")
    found = F.when(F.col("_seen"), F.col("_hot")).otherwise(F.col("_cold"))
    return joined.select(*facts.columns, *[found.getField(v).alias(v) for v in values])


def salt_of(*cols: str, parts: int = 4096) -> Column:
    """Salt in ``1..parts`` from columns that identify a row."""
    return F.pmod(F.hash(*cols), F.lit(parts)) + 1


def _drawer(key: Column) -> Column:
    return F.pmod(F.hash(key), F.lit(DRAWERS))


def translate(
    rows: DataFrame, table: DataFrame, *, array: str, out: str, default: Column, id_col: str = "doc_id", counts: DataFrame | None = None
) -> DataFrame:
    """``(id_col, out)``: the elements of ``array`` replaced by what ``table(key, value)`` holds for them.

    The arrays are written once, cut into chunks of ``CHUNK`` elements. Only the distinct elements
    of a chunk meet the table; the chunk is then rebuilt from its own small dictionary, which keeps
    positions out of the shuffle and the work linear in the length of an array. The dictionary lies
    in drawers by the hash of the key, so that few entries are searched per element. Elements that the
    table lacks, and NULL ones, become ``default``; empty and NULL arrays stay as empty ones.
    ``counts(key, cnt)`` may pass in how often the keys occur.
    """
    whole = F.coalesce(F.col(array), F.array().cast(rows.schema[array].dataType))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_a") - 1, F.lit(0)), F.lit(CHUNK))
    cut = rows.select(id_col, whole.alias("_a")).select(
        id_col, F.posexplode(F.transform(starts, lambda s: F.slice("_a", s + 1, CHUNK))).alias("chunk", "part")
    )
    chunks = materialise(cut, "chunks")
    facts = chunks.select(id_col, "chunk", F.explode(F.array_distinct("part")).alias("key")).filter("key IS NOT NULL")
    if counts is None:
        counts = facts.groupBy("key").agg(F.count(F.lit(1)).alias("cnt"))
    found = lookup(facts, table.select("key", "value"), ["key"], spread=salt_of(id_col, "chunk"), counts=counts)
    pairs = found.filter("value IS NOT NULL").groupBy(id_col, "chunk").agg(
        F.collect_list(F.struct(_drawer(F.col("key")).alias("drawer"), "key", "value")).alias("pairs")
    )

    def drawer(number: Column) -> Column:
        held = F.filter("pairs", lambda p: p["drawer"] == number)
        return F.map_from_entries(F.transform(held, lambda p: F.struct(p["key"], p["value"])))

    known = pairs.select(id_col, "chunk", F.transform(F.array(*[F.lit(k) for k in range(DRAWERS)]), drawer).alias("known"))
    at = lambda w: F.try_element_at(F.get("known", _drawer(w)), w)
    values = F.transform("part", lambda w: F.coalesce(at(w), default)).alias("values")
    rebuilt = chunks.join(known, [id_col, "chunk"], "left").select(id_col, F.struct("chunk", values).alias("entry"))
    gathered = rebuilt.groupBy(id_col).agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    return gathered.select(id_col, F.flatten(F.transform("entries", lambda e: e["values"])).alias(out))
