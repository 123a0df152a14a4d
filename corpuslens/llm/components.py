"""Connected components of a table of links, by contraction: no link or label reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.session import materialise


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that has a link; ``root`` names its component.

    Each round lets every node hook to its least neighbour, shortens the hooks until
    they point to roots, and carries the links over to the roots. The links that remain
    join different roots; they shrink by half or more each round. The tables that one
    round hands to the next are written, which cuts the lineage.
    """
    open_links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    labels = None
    while True:
        both = open_links.union(open_links.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        hooks = shortened(hooks.select("node", F.least("node", "up").alias("up")))
        if labels is None:
            labels = hooks.select("node", F.col("up").alias("root"))
        else:
            labels = composed(labels, hooks)
        labels = materialise(labels, "labels")
        left = hooks.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        right = hooks.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        moved = open_links.join(left, "a").join(right, "b").filter("ra <> rb")
        moved = moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        open_links = materialise(moved, "links")
        if open_links.isEmpty():
            return labels


def composed(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """``labels`` with each root replaced by what it hooks to."""
    onward = hooks.select(F.col("node").alias("root"), "up")
    return labels.join(onward, "root", "left").select("node", F.coalesce("up", "root").alias("root"))


def shortened(hooks: DataFrame) -> DataFrame:
    """Let every hook ``(node, up)``, ``up <= node``, point to its root: each pass doubles what is skipped.

    Every pass is written, as its result is read several times and the plan would double.
    """
    hooks = materialise(hooks, "hooks")
    while True:
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        joined = hooks.join(above, "up", "left").select("node", "up", F.coalesce("top", "up").alias("top"))
        joined = materialise(joined, "hooks")
        hooks = joined.select("node", F.col("top").alias("up"))
        if joined.filter("up <> top").isEmpty():
            return hooks
