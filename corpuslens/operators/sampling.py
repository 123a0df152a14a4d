"""Seeded samples and splits.

The seeded order is only ever inspected at the cuts: the row ranks at the sample
size or at the split boundaries are found on the ids alone, and the text rows are
then classified by one comparison each, without moving.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.seeded import order_key
from corpuslens.operators.ordering import before, seeded_cuts, seeded_rank


def sample_reviews(df: DataFrame, n: int, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """``n`` rows without replacement; all rows if there are no more than ``n``."""
    salt = str(seed)
    cuts = seeded_cuts(df, salt, lambda total: {"sample": n}, id_col)
    return df.filter(before(cuts["sample"], salt, id_col)) if cuts else df


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) >= 1e-6:
        raise ValueError(f"ratios must sum to 1, got {train} + {val} + {test}")


def assign_split(
    df: DataFrame,
    *,
    train: float = 0.8,
    val: float = 0.1,
    test: float = 0.1,
    seed: int = 42,
    id_col: str = "doc_id",
    mode: str = "exact",
) -> DataFrame:
    """Add ``split`` in train/val/test.

    ``mode="exact"`` gives the truncated shares of a seeded permutation.
    ``mode="hash"`` decides per row from the id alone: one pass, approximate shares.
    """
    check_ratios(train, val, test)
    salt = str(seed)
    if mode == "hash":
        bucket = F.pmod(F.conv(F.substring(order_key(salt, F.col(id_col)), 1, 8), 16, 10).cast("bigint"), F.lit(1_000_000))
        in_train = bucket < F.lit(round(train * 1_000_000))
        in_val = bucket < F.lit(round((train + val) * 1_000_000))
    elif mode == "exact":
        cuts = seeded_cuts(
            df, salt, lambda total: {"train": int(total * train), "val": int(total * train) + int(total * val)}, id_col
        )
        in_train, in_val = (before(cuts.get(name), salt, id_col) for name in ("train", "val"))
    else:
        raise ValueError(f"mode must be 'exact' or 'hash', got {mode!r}")
    return df.withColumn("split", F.when(in_train, "train").when(in_val, "val").otherwise("test"))


def select_test(df: DataFrame, n: int = 100, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Add ``selected``: a seeded choice of at most ``n`` test rows."""
    salt = f"{seed}:selected"
    cuts = seeded_cuts(df.filter("split = 'test'"), salt, lambda total: {"selected": n}, id_col)
    chosen = before(cuts.get("selected"), salt, id_col)
    return df.withColumn("selected", (F.col("split") == "test") & chosen)


def take_split(df: DataFrame, keys: DataFrame | None, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in ``keys``."""
    if keys is None:
        raise ValueError("split keys are required")
    return df.join(keys.select(id_col), id_col, "left_semi")


def not_contained(subset: DataFrame, whole: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``subset`` missing from ``whole``; empty if it is a subset."""
    return subset.join(whole.select(id_col), id_col, "left_anti")


def assert_subset(subset: DataFrame, whole: DataFrame, id_col: str = "doc_id") -> None:
    if not not_contained(subset, whole, id_col).isEmpty():
        raise AssertionError("the selected rows are not a subset of the test rows")


def epoch_order(df: DataFrame, seed: int, epoch: int, id_col: str = "doc_id", rank_col: str = "position") -> DataFrame:
    """Add the position of every row in the shuffled order of one epoch."""
    return seeded_rank(df, f"{seed}:{epoch}", id_col, rank_col)
