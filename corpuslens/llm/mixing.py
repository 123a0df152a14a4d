r"""Mixing sources to target weights by entropy balancing, in column expressions only.

Each source has a target of words. Among all document rates between 0 and ``MOST`` that take
these words, entropy balancing picks those nearest to one copy a document, in relative
entropy. Its convex dual has one unknown a source; the rate of a document is exponentially
tilted by its words, ``min(MOST, exp(dual * size / scale))``. Newton iterations solve the
dual for all sources at once: each is one aggregation of gradient and curvature over the
distinct (source, size) classes, kept within brackets that close where a step leaves them.

Rates become whole copies in two steps. Running sums of the rates in order of size are rounded,
so the words of a source miss their target by half its longest document at most. Then the
rest is made up from the longest documents that fit into it, a greedy run of classes a round,
until no document fits, and by a few exchanges of neighbouring sizes. The copies of a class go
to its documents evenly, and what is left over to those that a hash of id and text puts first.

Targets: sources in order of code points, null last, weigh 5, 2, 1, 5, ... and share all words
by weight; a target stops at ``MOST`` times its source's words, and the excess is shared anew.

Documents move as id, source, size and hash. Classes are as many as there are different sizes
in a source; only they are ordered by windows. A class that holds much of the corpus is cut
into hashed buckets of about ``BUCKET`` documents, and is met by a salted lookup.

Defined cases: a null text has size 0; documents without words keep one copy and take nothing;
a source without words has target 0; a null source is a source of its own, after the others;
rows alike in id, text and source are interchangeable; the same rows give the same result in any
order and layout; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.operators.lookup import lookup, salt_of
from corpuslens.operators.ordering import dense_rank_rows
from corpuslens.session import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
BUCKET = 4096
TOLERANCE = 1e-9  # of a target, when the dual counts as solved
ROUNDS = 200
FINE_ROUNDS = 6  # single moves that bring a source nearer to its target
SOURCE = ["kind", "name"]  # kind is 1 for the null source, which has no name
CLASS = [*SOURCE, "size"]


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(id, kind, name, size, key)`` of every document, written once."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]++"))
    return materialise(
        docs.select(
            F.col(doc_id).alias("id"),
            F.col(source).isNull().cast("int").alias("kind"),
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("name"),
            words.cast("long").alias("size"),
            F.xxhash64(F.col(doc_id), F.col(text)).alias("key"),
        ),
        "mix-sizes",
    )


def targets(classes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(kind, name, source_size, scale, shortest, target)`` per source of ``(kind, name, size, n)``."""
    words = F.col("size") * F.col("n")
    sources = classes.groupBy(*SOURCE).agg(
        F.sum(words).alias("source_size"),
        F.try_divide(_exact(words.cast("double") * F.col("size")), F.sum(words).cast("double")).alias("scale"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("shortest"),
    )
    ranked = dense_rank_rows(sources, *SOURCE)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(ranked.withColumn("weight", weight).drop("rank"), "mix-sources")
    cap = MOST * F.col("source_size")
    level, stopped = 0.0, -1
    while True:
        above = cap < F.lit(level) * F.col("weight") if stopped >= 0 else F.lit(False)
        seen = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(above, cap)).alias("stopped"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"), F.count_if(above).alias("n"),
        ).first()
        if seen.n == stopped or not seen.open:
            break
        level, stopped = (seen.all - (seen.stopped or 0)) / seen.open, seen.n
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return materialise(ranked.withColumn("target", target).drop("weight"), "mix-targets")


def _exact(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows."""
    return F.sum(value.cast("decimal(38,9)")).cast("double")


def _tilt(dual: Column) -> Column:
    return F.exp(dual * F.col("size") / F.col("scale"))


def solved(classes: DataFrame, aims: DataFrame) -> DataFrame:
    """``aims`` with ``dual``, so that the tilted rates of a source's documents take its target.

    Newton's step is taken on the logarithm of the words taken. A source whose target is all
    that its documents may give has no finite need of a dual; it gets the least that lifts
    every document to ``MOST`` copies.
    """
    full = math.log(MOST) * F.col("scale") / F.col("shortest")
    ratio = F.try_divide(F.col("target"), F.col("source_size"))
    whole = ratio >= MOST * (1 - 1e-12)
    begun = aims.withColumn("dual", F.when(whole, full).otherwise(F.ln(ratio))).withColumns(
        {"low": F.lit(None).cast("double"), "high": full, "done": whole | F.coalesce(F.col("target") <= 0, F.lit(True))}
    )
    state = materialise(begun.withColumn("done", F.coalesce("done", F.lit(True))), "mix-duals")
    real = classes.filter("size > 0")
    for _ in range(ROUNDS):
        tilt = _tilt(F.col("dual"))
        words = F.col("size") * F.col("n")
        sums = real.join(state.filter(~F.col("done")), SOURCE).groupBy(*SOURCE).agg(
            _exact(words * F.least(tilt, F.lit(float(MOST)))).alias("taken"),
            _exact(F.when(tilt < MOST, words * tilt * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"),
        )
        short = F.col("taken") < F.col("target")
        low = F.when(short, F.col("dual")).otherwise(F.col("low"))
        high = F.when(short, F.col("high")).otherwise(F.col("dual"))
        step = F.col("dual") + (F.ln("target") - F.ln("taken")) * F.try_divide(F.col("taken"), F.col("slope"))
        inside = F.coalesce((step > F.coalesce(low, F.lit(-math.inf))) & (step < high), F.lit(False))
        middle = F.coalesce((low + high) / 2, high - 1 - F.abs(high))
        near = F.abs(F.col("taken") - F.col("target")) <= TOLERANCE * F.col("target") + 1e-6
        closed = (high - F.coalesce(low, F.lit(-math.inf))) <= 1e-14 * F.abs(high)
        over = F.col("done") | F.coalesce(near | closed, F.lit(False))
        moved = state.join(sums, SOURCE, "left").withColumns(
            {
                "low": F.when(F.col("done"), F.col("low")).otherwise(low),
                "high": F.when(F.col("done"), F.col("high")).otherwise(high),
                "dual": F.when(over, F.col("dual")).when(inside, step).otherwise(middle),
                "done": over,
            }
        )
        state = materialise(moved.select(*state.columns), "mix-duals")
        if state.filter(~F.col("done")).isEmpty():
            return state.drop("low", "high", "done")
    raise ArithmeticError("the dual was not solved")


def rates(classes: DataFrame, duals: DataFrame) -> DataFrame:
    """``classes`` with the columns of ``duals`` and the ``rate`` of their documents."""
    rate = F.least(F.coalesce(_tilt(F.col("dual")), F.lit(1.0)), F.lit(float(MOST)))
    rate = F.when(F.col("target") >= MOST * F.col("source_size"), F.lit(float(MOST))).otherwise(rate)
    return classes.join(duals, SOURCE).withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(1.0))


def copies(rated: DataFrame) -> DataFrame:
    """``rated`` classes with ``copies`` of all their documents together, near the target of each source."""
    by_size = Window.partitionBy(*SOURCE).orderBy("size")
    upto = F.sum(F.col("rate") * F.col("n")).over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = rated.withColumn("upto", F.floor(upto + 0.5).cast("long"))
    given = F.col("upto") - F.lag("upto", 1, 0).over(by_size)
    limit = MOST * F.col("n")
    state = materialise(
        summed.withColumn("copies", F.greatest(F.least(given, limit), F.lit(0).cast("long"))).drop("upto"), "mix-copies"
    )
    longest_first = Window.partitionBy(*SOURCE).orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    while True:  # the longest documents that fit, each class as far as the rest goes
        open_ = _lacking(state).filter("size > 0 AND size <= rest AND room > 0")
        used = F.coalesce(F.sum(F.col("room") * F.col("size")).over(longest_first), F.lit(0))
        fits = F.least(F.col("room"), F.floor((F.col("rest") - used) / F.col("size")))
        chosen = open_.withColumn("change", F.when(used <= F.col("rest"), fits).otherwise(0)).filter("change > 0")
        moved = _moved(state, chosen.select(*CLASS, (F.col("change") * F.col("sign")).alias("change")))
        if moved is None:
            break
        state = moved
    for _ in range(FINE_ROUNDS):  # one copy more or less, or one exchanged for the next longer size
        seen = _lacking(state).filter("size > 0").withColumns(
            {c: F.lead(c).over(by_size) for c in ("size", "copies", "n")} | {"own": F.col("size"), "held": F.col("copies"), "m": F.col("n")}
        )
        swap = F.when(F.col("sign") > 0, (F.col("held") > 0) & (F.col("copies") < MOST * F.col("n"))).otherwise(
            (F.col("copies") > 0) & (F.col("held") < MOST * F.col("m"))
        )
        ways = F.array(
            F.struct(F.col("own").alias("gain"), F.array(F.struct(F.col("own").alias("size"), F.col("sign").alias("change"))).alias("moves")),
            F.when(
                swap,
                F.struct(
                    (F.col("size") - F.col("own")).alias("gain"),
                    F.array(
                        F.struct(F.col("own").alias("size"), (-F.col("sign")).alias("change")),
                        F.struct(F.col("size").alias("size"), F.col("sign").alias("change")),
                    ).alias("moves"),
                ),
            ),
        )
        tried = seen.select(*SOURCE, "rest", "room", F.posexplode(ways).alias("way", "w")).filter("w IS NOT NULL AND (way > 0 OR room > 0)")
        better = tried.withColumn("left", F.abs(F.col("rest") - F.col("w.gain"))).filter("left < rest - 1e-6")
        best = better.groupBy(*SOURCE).agg(F.min(F.struct("left", "way", "w.gain", "w.moves")).alias("b"))
        moved = _moved(state, best.select(*SOURCE, F.inline("b.moves")))
        if moved is None:
            break
        state = moved
    return state


def _lacking(state: DataFrame) -> DataFrame:
    """Classes with what their source misses (``rest``), its ``sign``, and the copies that could change (``room``)."""
    taken = state.groupBy(*SOURCE).agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
    gap = F.col("target") - F.col("taken")
    room = F.when(gap > 0, MOST * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
    sign = F.when(gap > 0, 1).otherwise(-1).cast("long")
    return state.join(taken, SOURCE).withColumns({"rest": F.abs(gap), "sign": sign, "room": room})


def _moved(state: DataFrame, moves: DataFrame) -> DataFrame | None:
    """``state`` after ``(kind, name, size, change)``, written; None if there is no change."""
    moves = materialise(moves.select(*CLASS, F.col("change").cast("long").alias("change")), "mix-moves")
    if moves.isEmpty():
        return None
    more = F.col("copies") + F.coalesce("change", F.lit(0))
    return materialise(state.join(moves, CLASS, "left").withColumn("copies", more).drop("change"), "mix-copies")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """Per document ``(id, size, source_size, target, rate, copies, taken)``; ``taken`` is its copies' words."""
    items = measured(docs, doc_id, text, source)
    classes = materialise(items.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    rounded = copies(rates(classes, solved(classes, targets(classes, weights))))
    facts = rounded.select(
        *CLASS, "source_size", "target", "rate",
        F.floor(F.col("copies") / F.col("n")).cast("long").alias("each"),
        F.pmod("copies", F.col("n")).alias("over"),
        F.ceil(F.col("n") / BUCKET).cast("long").alias("buckets"),
    )
    counts = classes.withColumnRenamed("n", "cnt")
    met = lookup(items, facts, CLASS, spread=salt_of("key"), counts=counts)
    met = materialise(met.withColumn("bucket", F.pmod("key", F.col("buckets"))).drop("buckets"), "mix-dealt")
    place = [*CLASS, "bucket"]
    filled = met.groupBy(*place).agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy(*CLASS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = filled.select(*place, F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead"))
    at = F.row_number().over(Window.partitionBy(*place).orderBy("key", "id")) + F.col("ahead")
    own = (F.col("each") + (F.col("at") <= F.col("over")).cast("long")).alias("copies")
    out = met.join(ahead, place).withColumn("at", at).select("id", "size", "source_size", "target", "rate", own)
    return out.withColumn("taken", F.col("size") * F.col("copies"))
