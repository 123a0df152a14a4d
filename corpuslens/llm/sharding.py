"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

Rows are dealt to ``parts`` source parts by a hash of what identifies them. The target is
the range 0..n-1 of places, cut into cells of exact sizes; a shard is a run of cells. How
many rows of a part go to which cell is drawn from the multivariate hypergeometric
distribution: the counts that a uniform permutation would give. Each part permutes its
rows and deals them to the cells by these counts; after the exchange each cell permutes
again. The number of rows in every cell is known beforehand, so places need no counting.

Everything is a column expression: the matrix is drawn by folds over arrays, first between
groups of parts, then inside every group in parallel. Rows carry ids and hashes only.

Defined cases: a null text has no bytes and crc32 0; rows alike in id, text and size are
interchangeable; null ids are dealt by their text; with fewer rows than cells some cells
are empty; an empty table gives an empty result. Further columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.session import materialise

SHARDS = 8
ROWS_PER_PART = 1 << 20
LEAST_PARTS, MOST_PARTS = 64, 4096
GROUP = 64
SPREAD = 12  # standard deviations searched on either side of the mode


def _log_factorial(x: Column) -> Column:
    """Stirling's series, after a shift by eight that makes its error less than 1e-13."""
    y = x + 9.0
    shift = F.log((x + 1.0) * (x + 2.0) * (x + 3.0) * (x + 4.0)) + F.log((x + 5.0) * (x + 6.0) * (x + 7.0) * (x + 8.0))
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def _named(**values: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in values.items()])


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Number of marked among ``drawn`` of ``total`` for the uniform ``u``, by inversion from the mode.

    The search takes the mode, then its neighbours on both sides in turn, and subtracts
    their probabilities from ``u``; outside of ``SPREAD`` deviations these are below the
    precision of a double. The answer always lies in the possible range.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - total)
    high = F.least(marked, drawn)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1.0) * (marked + 1.0) / (total + 2.0))))
    rest = total - marked
    p = F.exp(
        _log_factorial(marked.cast("double")) - _log_factorial(mode.cast("double"))
        - _log_factorial((marked - mode).cast("double")) + _log_factorial(rest.cast("double"))
        - _log_factorial((drawn - mode).cast("double")) - _log_factorial((rest - drawn + mode).cast("double"))
        - _log_factorial(total.cast("double")) + _log_factorial(drawn.cast("double"))
        + _log_factorial((total - drawn).cast("double"))
    )
    share = marked / F.greatest(total, F.lit(1))
    deviation = F.sqrt(drawn * share * (1 - share))
    steps = F.least(high - low, F.ceil(SPREAD * deviation) + 20)
    start = _named(
        up=mode, down=mode, p_up=p, p_down=p, u=u - p, found=F.when(u < p, mode).otherwise(F.lit(-1).cast("long"))
    )

    def step(s: Column, _: Column) -> Column:
        a, b = s["up"].cast("double"), s["down"].cast("double")
        m, k, r = marked.cast("double"), drawn.cast("double"), rest.cast("double")
        p_up = F.when(s["up"] < high, s["p_up"] * (m - a) * (k - a) / ((a + 1) * (r - k + a + 1))).otherwise(0.0)
        p_down = F.when(s["down"] > low, s["p_down"] * b * (r - k + b) / ((m - b + 1) * (k - b + 1))).otherwise(0.0)
        up, down = F.least(s["up"] + 1, high), F.greatest(s["down"] - 1, low)
        found = (
            F.when(s["found"] >= 0, s["found"])
            .when((s["u"] < p_up) & (p_up > 0), up)
            .when((s["u"] - p_up < p_down) & (p_down > 0), down)
            .otherwise(F.lit(-1).cast("long"))
        )
        return _named(up=up, down=down, p_up=p_up, p_down=p_down, u=s["u"] - p_up - p_down, found=found)

    walk = F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1).cast("long")))
    answer = F.aggregate(walk, start, step, lambda s: F.when(s["found"] >= 0, s["found"]).otherwise(mode))
    return F.when(low == high, low).otherwise(answer)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 53 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / float(1 << 53)


def draw_matrix(rows: Column, cells: Column, seed: Column) -> Column:
    """Counts by row and cell: a uniform deal of items with row sums ``rows`` into cells of sizes ``cells``.

    Rows take their items in turn; within a row, each cell's count is hypergeometric given
    what the cells before it got.
    """

    def one_row(state: Column, row: Column) -> Column:
        left, at = state["left"], F.size(state["matrix"])
        total = F.aggregate(left, F.lit(0).cast("long"), lambda s, x: s + x)

        def one_cell(s: Column, size: Column) -> Column:
            u = uniform(seed, at.cast("long"), F.size(s["got"]).cast("long"))
            got = hypergeometric(s["total"], size, s["want"], u)
            return _once(
                got, lambda g: _named(got=F.concat(s["got"], F.array(g)), total=s["total"] - size, want=s["want"] - g)
            )

        begin = _named(got=F.array().cast("array<bigint>"), total=total, want=row)
        got = F.aggregate(left, begin, one_cell, lambda s: s["got"])
        return _once(
            got,
            lambda g: _named(
                left=F.zip_with(left, g, lambda a, b: a - b), matrix=F.concat(state["matrix"], F.array(g))
            ),
        )

    empty = F.array().cast("array<array<bigint>>")
    return F.aggregate(rows, _named(left=cells, matrix=empty), one_row, lambda s: s["matrix"])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _even(total: Column, parts: int) -> Column:
    """``parts`` sizes, at most one apart, that add up to ``total``."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda i: F.floor(total / F.lit(parts)) + F.when(i < total % parts, 1).otherwise(0),
    )


def matrix(counts: DataFrame, parts: int, shards: int, per_shard: int, seed: int) -> DataFrame:
    """``(part, before, starts)``: a part's rows ahead of each cell's share, and the cells' first places.

    ``counts`` is ``(part, rows)``, at most ``MOST_PARTS`` rows.
    """
    groups = math.ceil(parts / GROUP)
    filled = counts.groupBy((F.col("part") % groups).alias("grp")).agg(
        F.sort_array(F.collect_list(F.struct("part", "rows"))).alias("members"), F.sum("rows").alias("rows")
    )
    whole = filled.agg(
        F.sort_array(F.collect_list(F.struct("grp", "rows"))).alias("all"), F.sum("rows").alias("total")
    )
    sizes = whole.select(
        "all", F.flatten(F.transform(_even(F.col("total"), shards), lambda n: _even(n, per_shard))).alias("cells")
    )
    top = sizes.select(
        "cells",
        F.explode(
            F.arrays_zip(
                F.transform("all", lambda x: x["grp"]).alias("grp"),
                draw_matrix(F.transform("all", lambda x: x["rows"]), F.col("cells"), F.lit(seed).cast("long")).alias("got"),
            )
        ).alias("g"),
    ).select(F.col("cells").alias("sizes"), "g.grp", "g.got")
    members = F.transform("members", lambda x: x["rows"])
    within = filled.join(top, "grp").select(
        "sizes",
        F.explode(
            F.arrays_zip(
                F.transform("members", lambda x: x["part"]).alias("part"),
                draw_matrix(members, F.col("got"), F.xxhash64(F.lit(seed), F.col("grp"))).alias("cells"),
            )
        ).alias("p"),
    )
    return within.select(
        F.col("p.part").alias("part"), _running("p.cells").alias("before"), _running("sizes").alias("starts")
    )


def _running(name: str) -> Column:
    """Sums of what stands before each element."""
    return F.aggregate(
        name,
        _named(sums=F.array().cast("array<bigint>"), at=F.lit(0).cast("long")),
        lambda s, x: _named(sums=F.concat(s["sums"], F.array(s["at"])), at=s["at"] + x),
        lambda s: s["sums"],
    )


def shuffle(items: DataFrame, *identity: str, shards: int = SHARDS, seed: int = 20240229) -> DataFrame:
    """``items`` with ``shard`` and ``slot``, a uniform permutation cut into shards at most one row apart.

    ``identity`` are the columns that tell rows apart. ``items`` should be narrow: it is
    written once, then exchanged twice.
    """
    columns = items.columns
    held = materialise(items, "to-shard")
    n = held.count()
    parts = 1 << math.ceil(math.log2(min(MOST_PARTS, max(LEAST_PARTS, n / ROWS_PER_PART))))
    per_shard = max(1, parts // shards)
    cells = shards * per_shard
    dealt = held.withColumn("_s_part", F.pmod(F.xxhash64(F.lit(seed), *identity), F.lit(parts)))
    counts = dealt.groupBy(F.col("_s_part").alias("part")).agg(F.count("*").alias("rows"))
    deal = materialise(
        matrix(counts, parts, shards, per_shard, seed).select(
            F.col("part").alias("_s_part"), F.col("before").alias("_s_before"), F.col("starts").alias("_s_starts")
        ),
        "deal",
    )

    first, second = F.xxhash64(F.lit(seed + 1), *identity), F.xxhash64(F.lit(seed + 2), *identity)
    place = F.row_number().over(Window.partitionBy("_s_part").orderBy(first, *identity))
    local = dealt.withColumn("_s_place", place).join(deal, "_s_part")
    # The last cell that starts before the row's place, by bisection over the starts of this part's cells.
    halves = [1 << k for k in reversed(range(max(1, math.ceil(math.log2(cells)))))]
    cell = F.aggregate(
        F.array(*[F.lit(h) for h in halves]),
        F.lit(0),
        lambda at, h: F.when(
            (at + h < cells) & (F.get("_s_before", F.least(at + h, F.lit(cells - 1))) < F.col("_s_place")), at + h
        ).otherwise(at),
    )
    sent = local.withColumn("_s_cell", cell).withColumn("_s_first", F.get("_s_starts", "_s_cell"))
    again = F.row_number().over(Window.partitionBy("_s_cell").orderBy(second, *identity))
    shard = F.floor(F.col("_s_cell") / per_shard).cast("int")
    size, more = n // shards, n % shards
    before = shard * F.lit(size).cast("long") + F.least(shard, F.lit(more))
    return sent.select(
        *columns, shard.alias("shard"), (F.col("_s_first") + again - 1 - before).cast("long").alias("slot")
    )


def document_items(docs: DataFrame) -> DataFrame:
    """What the contract's query needs of each document: id, size and checksum of its text."""
    text = F.encode("text", "UTF-8")
    return docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
