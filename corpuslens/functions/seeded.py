"""Seeded order and seeded uniforms from md5, the same on every engine and run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIFORM_DIGITS = 13  # 52 bits: the largest hex prefix a double holds exactly


def order_key(salt: str, *ids: Column) -> Column:
    """md5 of ``salt:id:...``; sorting by it is a seeded permutation."""
    return F.md5(F.concat_ws(":", F.lit(salt), *[i.cast("string") for i in ids]))


def uniform(salt: str, *ids: Column) -> Column:
    """Uniform double in ``[0, 1)``."""
    prefix = F.substring(order_key(salt, *ids), 1, UNIFORM_DIGITS)
    return F.conv(prefix, 16, 10).cast("bigint").cast("double") / F.lit(float(16**UNIFORM_DIGITS))
