"""Which rows can be among given keys at all, so that a join need not move the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BITS = 15  # places of one bitmap of Spark's bitmap functions
MOST_BITS = 27  # 16 MB in all; with more keys it only spares less
BITS_PER_KEY = 32  # 3 % of the other rows are taken for a key


def parted(rows: DataFrame, on: Sequence[Column], keys: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` that are surely not among ``keys``, and the rest, which an exact join must settle.

    The expressions ``on`` of a row stand for the columns ``names`` of ``keys``, of the same types; nulls
    are equal. The keys become one bit each of bitmaps that are broadcast.
    """
    bits = max(PART_BITS, min(MOST_BITS, (BITS_PER_KEY * keys.count()).bit_length()))

    def place(columns: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(1 << bits))

    at = place([F.col(n) for n in names])
    maps = keys.groupBy(F.shiftright(at, PART_BITS).alias("_n_part")).agg(
        F.bitmap_construct_agg(at % (1 << PART_BITS)).alias("_n_bits")
    )
    placed = rows.withColumn("_n_at", place(on))
    found = placed.join(F.broadcast(maps), F.shiftright("_n_at", PART_BITS) == F.col("_n_part"), "left")
    inside = F.col("_n_at") % (1 << PART_BITS)
    byte = F.conv(F.hex(F.substring("_n_bits", (F.floor(inside / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (inside % 8).cast("int")) % 2
    maybe = F.coalesce(bit == 1, F.lit(False))
    return found.filter(~maybe).select(*rows.columns), found.filter(maybe).select(*rows.columns)
