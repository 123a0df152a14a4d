"""Seeded order statistics and dense ranks without a single-partition window."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.seeded import order_key
from corpuslens.session import materialise

PREFIX_DIGITS = 3  # 4,096 equally likely md5 buckets a level
KEY_DIGITS = 32
BUCKET_ROWS = 1 << 20  # ids that one task sorts
ROW_BITS = 33  # row part of monotonically_increasing_id


def seeded_cuts(
    df: DataFrame, salt: str, ranks: Callable[[int], Mapping[str, int]], id_col: str = "doc_id"
) -> dict[str, tuple[str, int]]:
    """The ``(key, id)`` pair at each named zero-based rank of the seeded order.

    ``ranks`` gets the number of rows and names the ranks wanted; a rank past the
    end has no entry. Only ids are read. The driver receives one count per md5
    bucket (at most 4,096 for each cut and level) and one row per cut. A bucket that
    holds a cut is divided again until it has no more than ``BUCKET_ROWS`` ids; only
    such buckets are sorted.
    """
    keyed = df.select(F.col(id_col).alias("id"), order_key(salt, F.col(id_col)).alias("key"))

    def counted(digits: int, inside: list[str]) -> list[tuple[str, int]]:
        rows = keyed.filter(F.substring("key", 1, digits - PREFIX_DIGITS).isin(inside)) if inside else keyed
        found = rows.groupBy(F.substring("key", 1, digits).alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))
        return sorted((r.bucket, r.cnt) for r in found.collect())

    def placed(counts: list[tuple[str, int]], rank: int) -> tuple[str, int, int] | None:
        """Bucket that holds the zero-based rank, the rank within it, and its size."""
        for (bucket, cnt), end in zip(counts, accumulate(cnt for _, cnt in counts)):
            if 0 <= rank < end:
                return bucket, rank - (end - cnt), cnt
        return None

    digits, counts = PREFIX_DIGITS, counted(PREFIX_DIGITS, [])
    total = sum(cnt for _, cnt in counts)
    spots = {name: spot for name, rank in ranks(total).items() if (spot := placed(counts, rank))}
    if not spots:
        return {}
    while max(cnt for _, _, cnt in spots.values()) > BUCKET_ROWS and digits < KEY_DIGITS - PREFIX_DIGITS:
        digits += PREFIX_DIGITS
        finer = counted(digits, sorted({bucket for bucket, _, _ in spots.values()}))
        spots = {
            name: placed([c for c in finer if c[0].startswith(bucket)], rank) for name, (bucket, rank, _) in spots.items()
        }
    keyed = keyed.withColumn("bucket", F.substring("key", 1, digits))
    wanted = {name: (bucket, rank + 1) for name, (bucket, rank, _) in spots.items()}
    within = Window.partitionBy("bucket").orderBy("key", "id")
    places = sorted(set(wanted.values()))
    is_cut = F.lit(False)
    for bucket, place in places:
        is_cut = is_cut | ((F.col("bucket") == bucket) & (F.col("place") == place))
    found = (
        keyed.filter(F.col("bucket").isin(sorted({b for b, _ in places})))
        .withColumn("place", F.row_number().over(within))
        .filter(is_cut)
        .collect()
    )
    by_place = {(r.bucket, r.place): (r.key, r.id) for r in found}
    return {name: by_place[place] for name, place in wanted.items()}


def before(cut: tuple[str, int] | None, salt: str, id_col: str = "doc_id") -> Column:
    """Per-row test "ranks before the cut"; without a cut every row does.

    The cut is a constant, so the test is one comparison wherever the frame is used.
    """
    if cut is None:
        return F.lit(True)
    key = order_key(salt, F.col(id_col))
    return (key < cut[0]) | ((key == cut[0]) & (F.col(id_col) < F.lit(cut[1])))


def dense_rank_rows(df: DataFrame, *order: str, rank_col: str = "rank") -> DataFrame:
    """Add the zero-based rank of every row by columns that identify it.

    A range sort numbers the rows inside each partition; the sorted rows are written
    once, which freezes the numbering, and each partition is shifted by the rows
    before it. The offsets are one row per partition of the sort.
    """
    number = F.monotonically_increasing_id()
    frozen = materialise(df.orderBy(*order).withColumn("_number", number), "ranked")
    part = F.shiftright("_number", ROW_BITS)
    sizes = frozen.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("_part", (F.sum("rows").over(upto) - F.col("rows")).alias("_offset"))
    row = F.col("_number").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        frozen.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # at most one row per sort partition
        .withColumn(rank_col, F.col("_offset") + row)
        .drop("_number", "_part", "_offset")
    )


def seeded_rank(df: DataFrame, salt: str, id_col: str = "doc_id", rank_col: str = "rank") -> DataFrame:
    """Add the dense zero-based rank of every row in the seeded order."""
    keyed = df.withColumn("_key", order_key(salt, F.col(id_col)))
    return dense_rank_rows(keyed, "_key", id_col, rank_col=rank_col).drop("_key")
