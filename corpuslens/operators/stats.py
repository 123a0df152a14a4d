"""Corpus statistics as tables.

All word and n-gram statistics roll up from one table with a row per gram and a
count column per class, so the corpus is exploded and shuffled once. The most frequent
n-grams need few rows of it: ``frequent_grams`` finds and counts these. Counts are
combined before the shuffle; a gram that makes up a third of the corpus sends one
row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import text, wordlists
from corpuslens.schema import CLASSES, OVERALL, require_columns
from corpuslens.session import materialise

GRAM_BUCKETS = 1 << 20  # of a size of grams
FULLEST_BUCKETS = 2_000  # of a size and scope, whose grams are counted first
MOST_BUCKETS = 1 << 17  # that are worth a selection of grams
NEEDS_WORDS = "Corpus statistics need word tokens: run operators.corpus.tokenise first."


def at_position(id_col: str, pos_col: str) -> Column:
    """Corpus position of a token as one number that sorts by document, then place.

    A struct would sort the same but cannot be aggregated in a hash table.
    """
    return F.col(id_col).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col(pos_col)


# ---- lengths and classes -------------------------------------------------------


def class_distribution(df: DataFrame) -> DataFrame:
    return df.filter(F.col("sentiment").isNotNull()).groupBy("sentiment").agg(F.count(F.lit(1)).alias("cnt"))


def length_stats(df: DataFrame) -> DataFrame:
    """Exact mean and median text length and word count, as ``(stat, scope, value)``.

    Lengths are first reduced to a histogram; the percentile then runs over as
    many rows as there are different lengths.
    """
    measures = F.array(
        F.struct(F.lit("text_length").alias("measure"), F.col("_char_len").alias("length")),
        F.struct(F.lit("word_count").alias("measure"), F.col("_word_count").alias("length")),
    )
    histogram = (
        df.select("sentiment", F.explode(measures).alias("m"))
        .groupBy("sentiment", "m.measure", "m.length")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    # grouping() tells the overall row apart from rows whose sentiment is NULL
    grouped = (
        histogram.groupingSets([["measure"], ["measure", "sentiment"]], "measure", "sentiment")
        .agg(
            F.grouping("sentiment").alias("is_overall"),
            (F.sum(F.col("length") * F.col("cnt")) / F.sum("cnt")).alias("average"),
            F.percentile("length", 0.5, F.col("cnt")).alias("median"),
        )
        .filter("is_overall = 1 OR sentiment IS NOT NULL")
    )
    scope = F.when(F.col("is_overall") == 1, OVERALL).otherwise(F.col("sentiment"))
    stats = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("average", "median")])
    return grouped.select("measure", scope.alias("scope"), F.explode(stats).alias("s")).select(
        F.concat_ws("_", "s.kind", "measure").alias("stat"), "scope", "s.value"
    )


# ---- words and n-grams ---------------------------------------------------------


def _grams(df: DataFrame, sizes: Sequence[int], keep: Sequence[str], words_col: str) -> DataFrame:
    """``(*keep, pos, n, gram)``, one row per occurrence."""
    require_columns(df, words_col, hint=NEEDS_WORDS)
    longest = max(sizes)
    # Word i next to words i+1, i+2, ...: one zip and one explode serve every size,
    # without a lambda per position.
    whole = df.select(*keep, text.drop_nulls(F.col(words_col)).alias("s0"))
    shifts = [F.slice("s0", j + 1, F.size("s0")).alias(f"s{j}") for j in range(1, longest)]
    zipped = F.arrays_zip(*[f"s{j}" for j in range(longest)])
    # posexplode_outer keeps the optimiser from evaluating the token expression a second
    # time in a "size > 0" filter; the rows it adds for empty documents are dropped here
    rows = (
        whole.select(*keep, "s0", *shifts)
        .select(*keep, F.posexplode_outer(zipped).alias("pos", "w"))
        .filter("w.s0 IS NOT NULL")
    )

    def gram(n: int) -> Column:
        if n == 1:
            return F.array("w.s0")
        return F.when(F.col(f"w.s{n - 1}").isNotNull(), F.array(*[F.col(f"w.s{j}") for j in range(n)]))

    if len(sizes) == 1:
        rows = rows.select(*keep, "pos", F.lit(sizes[0]).alias("n"), gram(sizes[0]).alias("gram"))
    else:
        entries = F.array(*[F.struct(F.lit(n).alias("n"), gram(n).alias("gram")) for n in sizes])
        rows = rows.select(*keep, "pos", F.inline(entries))
    return rows.filter("gram IS NOT NULL")


def _counts(classes: Sequence[str]) -> list[Column]:
    return [*[F.count_if(F.col("sentiment") == c).alias(c) for c in classes], F.count(F.lit(1)).alias(OVERALL)]


def _bucket() -> Column:
    return F.pmod(F.xxhash64("gram"), F.lit(GRAM_BUCKETS)).cast("int")


def gram_table(
    df: DataFrame,
    sizes: Sequence[int] = (1,),
    classes: Sequence[str] = CLASSES,
    *,
    first_seen: bool = False,
    words_col: str = "_words",
    buckets: DataFrame | None = None,
) -> DataFrame:
    """``(n, gram, <count per class>, overall)``; a NULL class counts in ``overall`` only.

    ``first_seen`` adds ``first_<scope>``, the corpus position of the first occurrence. ``buckets(n, bucket)``, a
    bounded table, keeps the grams of these hash buckets only.
    """
    rows = _grams(df, sizes, ["sentiment", *(["doc_id"] if first_seen else [])], words_col)
    if buckets is not None:
        rows = rows.withColumn("bucket", _bucket()).join(F.broadcast(buckets), ["n", "bucket"], "left_semi")
    columns = _counts(classes)
    if first_seen:
        rows = rows.withColumn("at", at_position("doc_id", "pos"))
        columns += [F.min(F.when(F.col("sentiment") == c, F.col("at"))).alias(f"first_{c}") for c in classes]
        columns.append(F.min("at").alias(f"first_{OVERALL}"))
    return rows.groupBy("n", "gram").agg(*columns)


def frequent_grams(
    df: DataFrame,
    sizes: Sequence[int],
    k: int = 10,
    classes: Sequence[str] = CLASSES,
    *,
    first_seen: bool = False,
    words_col: str = "_words",
) -> DataFrame:
    """The rows of ``gram_table`` that can be among the ``k`` most frequent of a size and scope, and some others.

    All occurrences are counted by hash bucket first, so what is shuffled does not grow with the
    number of different grams. The grams of the fullest buckets are then counted exactly; the ``k``-th
    count of these is no larger than that of the corpus, and a gram is no more frequent than its
    bucket. So every gram of a bucket that reaches that count is counted, ties included, and the
    rest cannot matter. If too many buckets reach it, all grams are counted. ``df`` is read up to three times.
    """
    occurrences = _grams(df, sizes, ["sentiment"], words_col).withColumn("bucket", _bucket())
    filled = materialise(occurrences.groupBy("n", "bucket").agg(*_counts(classes)), "gram-buckets")
    entries = F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), F.col(s).alias("cnt")) for s in (*classes, OVERALL)]))
    scoped = filled.select("n", "bucket", entries.alias("s")).select("n", "bucket", "s.*").filter("cnt > 0")
    fullest = Window.partitionBy("n", "scope").orderBy(F.desc("cnt"), "bucket")
    first = scoped.withColumn("place", F.row_number().over(fullest)).filter(F.col("place") <= FULLEST_BUCKETS)
    chosen = materialise(first.select("n", "bucket").distinct(), "gram-buckets-chosen")
    counted = gram_table(df, sizes, classes, first_seen=first_seen, words_col=words_col, buckets=chosen)
    counted = materialise(counted, "gram-counts")
    kth = top_grams(by_scope(counted, classes), k, "first_seen" if first_seen else "alphabetical")
    least = {(r.n, r.scope): r.cnt for r in kth.filter(F.col("rank") == k).collect()}  # a row per size and scope
    reaches = [
        (F.col("n") == n) & (F.col(s) >= max(least.get((n, s), 1), 1)) for n in sizes for s in (*classes, OVERALL)
    ]
    needed = filled.filter(reduce(Column.__or__, reaches)).select("n", "bucket")
    missing = needed.join(chosen, ["n", "bucket"], "left_anti").limit(MOST_BUCKETS + 1).count()
    if not missing:
        return counted
    few = materialise(needed, "gram-buckets-needed") if missing <= MOST_BUCKETS else None
    return gram_table(df, sizes, classes, first_seen=first_seen, words_col=words_col, buckets=few)


def shown(gram: str) -> Column:
    """A gram as text, for display only: grams of different tokens may read alike."""
    return F.array_join(gram, " ")


def by_scope(table: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Gram table in long form: ``(n, scope, gram, cnt[, first])`` with positive counts."""
    dated = f"first_{OVERALL}" in table.columns

    def entry(scope: str) -> Column:
        parts = [F.lit(scope).alias("scope"), F.col(scope).alias("cnt")]
        return F.struct(*parts, *([F.col(f"first_{scope}").alias("first")] if dated else []))

    entries = F.explode(F.array(*[entry(s) for s in (*classes, OVERALL)]))
    return (
        table.select("n", "gram", entries.alias("s"))
        .select("n", "s.scope", "gram", "s.cnt", *(["s.first"] if dated else []))
        .filter("cnt > 0")
    )


def word_frequency(df: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``(scope, token, cnt)``."""
    return by_scope(gram_table(df, (1,), classes), classes).select("scope", F.get("gram", F.lit(0)).alias("token"), "cnt")


def vocabulary_size(table: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``(scope, vocabulary_size)`` from a unigram table, without a distinct count."""
    one = table.filter("n = 1").agg(*[F.count_if(F.col(s) > 0).alias(s) for s in (*classes, OVERALL)])
    return one.unpivot([], [*classes, OVERALL], "scope", "vocabulary_size")


def approximate_vocabulary_size(
    df: DataFrame, error: float = 0.02, classes: Sequence[str] = CLASSES, words_col: str = "_words"
) -> DataFrame:
    """``(scope, vocabulary_size)`` by sketches with the relative standard ``error``.

    One pass without a shuffle of words: each task sends a sketch per scope, and these are merged.
    """
    require_columns(df, words_col, "sentiment", hint=NEEDS_WORDS)
    rows = df.select("sentiment", F.explode_outer(words_col).alias("token")).filter("token IS NOT NULL")
    sketches = [F.approx_count_distinct(F.when(F.col("sentiment") == c, F.col("token")), error).alias(c) for c in classes]
    one = rows.agg(*sketches, F.approx_count_distinct("token", error).alias(OVERALL))
    return one.unpivot([], [*classes, OVERALL], "scope", "vocabulary_size")


def top_grams(scoped: DataFrame, k: int = 10, ties: str = "alphabetical") -> DataFrame:
    """The ``k`` most frequent grams of every ``(n, scope)``, with their rank.

    Ties go to the alphabetically first gram, or with ``ties="first_seen"`` to the
    one that occurs first in the corpus. Each task keeps ``k`` rows per scope before
    anything is shuffled.
    """
    if ties not in ("alphabetical", "first_seen"):
        raise ValueError(f"ties must be 'alphabetical' or 'first_seen', got {ties!r}")
    tie = F.col("first") if ties == "first_seen" else F.col("gram")
    order = Window.partitionBy("n", "scope").orderBy(F.desc("cnt"), tie)
    return (
        scoped.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("n", "scope", "rank", "gram", "cnt")
    )


def top_words(df: DataFrame, k: int = 10, classes: Sequence[str] = CLASSES, ties: str = "alphabetical") -> DataFrame:
    """``(scope, rank, token, cnt)``."""
    scoped = by_scope(gram_table(df, (1,), classes, first_seen=ties == "first_seen"), classes)
    return top_grams(scoped, k, ties).select("scope", "rank", F.get("gram", F.lit(0)).alias("token"), "cnt")


def top_ngrams(
    df: DataFrame,
    sizes: Sequence[int] = (2, 3, 4),
    k: int = 10,
    classes: Sequence[str] = CLASSES,
    ties: str = "alphabetical",
) -> DataFrame:
    """``(n, scope, rank, gram, cnt)`` for all sizes; the words are written once and read from there."""
    require_columns(df, "_words", hint=NEEDS_WORDS)
    first_seen = ties == "first_seen"
    kept = materialise(df.select(*(["doc_id"] if first_seen else []), "sentiment", "_words"), "gram-words")
    return top_grams(by_scope(frequent_grams(kept, sizes, k, classes, first_seen=first_seen), classes), k, ties)


# ---- terms by class ------------------------------------------------------------


def term_frequency(df: DataFrame, terms: str = "unigram", classes: Sequence[str] = CLASSES) -> DataFrame:
    """``(term, positive, negative)`` over the rows that have a class."""
    sizes = {"unigram": (1,), "unigram+bigram": (1, 2)}
    if terms not in sizes:
        raise ValueError(f"terms must be one of {', '.join(sizes)}, got {terms!r}")
    return class_terms(gram_table(df, sizes[terms], classes), classes)


def class_terms(table: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Term frequencies out of a gram table."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in classes])
    return table.filter(total > 0).select(shown("gram").alias("term"), *classes)


def log_odds(terms: DataFrame, alpha: float = 0.01, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Log-odds z-score per term with an uninformative Dirichlet prior.

    Positive scores lean to the first class. The corpus totals enter as a scalar
    subquery of one row.
    """
    i, j = classes
    totals = terms.agg(
        F.struct(
            F.sum(i).alias("ni"), F.sum(j).alias("nj"), (F.count(F.lit(1)) * F.lit(alpha)).alias("a0")
        ).alias("t")
    ).scalar()

    def log_odds_of(count: Column, class_total: Column, a0: Column) -> Column:
        return F.ln((count + alpha) / (class_total + a0 - count - alpha))

    t, yi, yj = F.col("_totals"), F.col(i), F.col(j)
    difference = log_odds_of(yi, t.ni, t.a0) - log_odds_of(yj, t.nj, t.a0)
    spread = F.sqrt(1 / (yi + alpha) + 1 / (yj + alpha))
    return terms.withColumn("_totals", totals).select("term", i, j, (difference / spread).alias("z"))


def significant_words(scores: DataFrame, k: int = 10, classes: Sequence[str] = CLASSES) -> DataFrame:
    """``(scope, term, z)``: the ``k`` largest scores for the first class, smallest for the second."""
    i, j = classes
    largest = scores.orderBy(F.desc("z"), "term").limit(k)
    smallest = scores.orderBy("z", "term").limit(k)
    return largest.select(F.lit(i).alias("scope"), "term", "z").unionByName(
        smallest.select(F.lit(j).alias("scope"), "term", "z")
    )


def word_cloud(
    words: DataFrame,
    k: int = 100,
    stop_words: Iterable[str] = wordlists.STOP_WORDS,
    classes: Sequence[str] = CLASSES,
) -> DataFrame:
    """``(scope, token, cnt, weight)`` of the ``k`` commonest content words per class.

    ``words`` is a word frequency table; the weight is relative to the commonest word.
    """
    kept = words.filter(
        F.col("scope").isin(list(classes))
        & ~F.col("token").isin(sorted(set(stop_words)))
        & (F.char_length("token") > 2)
    )
    order = Window.partitionBy("scope").orderBy(F.desc("cnt"), "token")
    top = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    largest = F.max("cnt").over(Window.partitionBy("scope"))  # at most k rows per class by now
    return top.select("scope", "token", "cnt", (F.col("cnt") / largest).alias("weight"))


def term_scatter(terms: DataFrame, min_count: int = 50, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Coordinates of the frequent terms: log frequency per class, scaled to [0, 1]."""
    i, j = classes
    logs = terms.filter(F.col(i) + F.col(j) >= min_count).select(
        "term", i, j, F.log2(1 + F.col(i)).alias("li"), F.log2(1 + F.col(j)).alias("lj")
    )
    ends = logs.agg(
        F.struct(*[f(c).alias(f"{name}_{c}") for c in ("li", "lj") for name, f in (("min", F.min), ("max", F.max))]).alias("e")
    ).scalar()

    def scaled(c: str) -> Column:
        low, high = F.col("_ends")[f"min_{c}"], F.col("_ends")[f"max_{c}"]
        return F.coalesce(F.try_divide(F.col(c) - low, high - low), F.lit(0.0))

    return logs.withColumn("_ends", ends).select("term", i, j, scaled("li").alias("x"), scaled("lj").alias("y"))
