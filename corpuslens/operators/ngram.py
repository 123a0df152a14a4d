"""Count-based n-gram language models as tables.

A model is ``counts(n, context, word, cnt)``, ``totals(n, context, total)`` and the
number of different predicted words. Several sizes live in one model, keyed by
``n``. A context is the array of its words, so tokens may hold any character.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.functions import text
from corpuslens.functions.seeded import uniform
from corpuslens.operators.lookup import lookup, salt_of
from corpuslens.schema import BOS, EOS, require_columns
from corpuslens.session import fresh_path, materialise, materialise_bucketed, stored_bytes


def _windows(df: DataFrame, sizes: Sequence[int], keep: Sequence[str], words_col: str) -> DataFrame:
    """``(*keep, e)``: per document the array of predicted words ``b0`` with those before them, ``b1, b2, ...``."""
    require_columns(df, words_col)
    back = max(sizes) - 1
    padded = F.concat(F.array_repeat(F.lit(BOS), back), F.col("_w"), F.array(F.lit(EOS)))
    # b0 is the predicted word, b1 the one before it, and so on
    shifts = [F.slice("_p", back - j + 1, F.size("_p") - back).alias(f"b{j}") for j in range(back + 1)]
    return (
        df.select(*keep, text.drop_nulls(F.col(words_col)).alias("_w"))
        .select(*keep, padded.alias("_p"))
        .select(*keep, *shifts)
        .select(*keep, F.arrays_zip(*[f"b{j}" for j in range(back + 1)]).alias("e"))
    )


def _event(e: Column, n: int) -> list[Column]:
    context = F.array(*[e[f"b{j}"] for j in range(n - 1, 0, -1)]).cast("array<string>")
    return [context.alias("context"), e["b0"].alias("word")]


def events(df: DataFrame, sizes: Sequence[int], *keep: str, words_col: str = "_words") -> DataFrame:
    """``(*keep, n, context, word)``, one row per predicted word.

    A document is padded with start marks and one end mark, so it has ``len + 1``
    events per size, also when it is empty. The predicted word is zipped with the
    words before it once, up to the largest size; contexts are cut from that row.
    """
    # never empty: outer only avoids a second evaluation in an inferred filter
    rows = _windows(df, sizes, keep, words_col).select(*keep, F.explode_outer("e").alias("e"))
    entries = {n: [F.lit(n).alias("n"), *_event(F.col("e"), n)] for n in sizes}
    if len(sizes) == 1:
        return rows.select(*keep, *entries[sizes[0]])
    return rows.select(*keep, F.inline(F.array(*[F.struct(*entries[n]) for n in sizes])))


def event_arrays(df: DataFrame, sizes: Sequence[int], *keep: str, words_col: str = "_words") -> DataFrame:
    """``(*keep, n, events)``: the ``events`` of a row of ``df`` as one array of ``(context, word)`` per size.

    For what is worked out per document: nothing is exploded, sorted or shuffled.
    """
    rows = _windows(df, sizes, keep, words_col)
    nothing = F.array(F.lit(None).cast(rows.schema["e"].dataType.elementType))  # as events has it where there is no array of words
    rows = rows.select(*keep, F.coalesce("e", nothing).alias("e"))

    def of_size(n: int) -> Column:
        return F.struct(F.lit(n).alias("n"), F.transform("e", lambda e: F.struct(*_event(e, n))).alias("events"))

    return rows.select(*keep, F.inline(F.array(*[of_size(n) for n in sizes])))


BETWEEN, ESCAPE = "\x01", "\x02"  # words of a key


def _escaped(w: Column) -> Column:
    return F.replace(F.replace(w, F.lit(ESCAPE), F.lit(ESCAPE + "b")), F.lit(BETWEEN), F.lit(ESCAPE + "a"))


def _words_of(text_col: str) -> Column:
    """The words of a text that escaped words were joined to."""

    def word(w: Column) -> Column:
        plain = F.replace(F.replace(w, F.lit(ESCAPE + "a"), F.lit(BETWEEN)), F.lit(ESCAPE + "b"), F.lit(ESCAPE))
        return F.when(w != ESCAPE + "n", plain)

    words = F.split(text_col, BETWEEN)
    return F.when(F.contains(text_col, F.lit(ESCAPE)), F.transform(words, word)).otherwise(words)


def _key(most: int) -> Column:
    """``context`` of up to ``most`` words as text, another one for every array: shorter to move and faster to compare."""

    def word(k: int) -> Column:
        w = F.get("context", F.lit(k))
        return F.when(F.size("context") > k, F.coalesce(_escaped(w), F.lit(ESCAPE + "n")))

    return F.concat_ws(BETWEEN, *[word(k) for k in range(most)]) if most else F.lit("")


def _context_of() -> Column:
    """The array of which ``key`` is the text."""
    return F.when(F.col("n") == 1, F.array().cast("array<string>")).otherwise(_words_of("key"))


def event_counts(df: DataFrame, sizes: Sequence[int], words_col: str = "_words") -> DataFrame:
    """``(n, context, word, cnt)``, combined before the shuffle, which moves contexts as text."""
    return (
        events(df, sizes, words_col=words_col)
        .select("n", _key(max(sizes) - 1).alias("key"), "word")
        .groupBy("n", "key", "word")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select("n", _context_of().alias("context"), "word", "cnt")
    )


def context_totals(counts: DataFrame) -> DataFrame:
    """``(n, context, total)``; hot contexts are pre-summed in every task."""
    return counts.groupBy("n", "context").agg(F.sum("cnt").alias("total"))


def event_vocabulary(counts: DataFrame) -> DataFrame:
    """``(n, v)``: different predicted words, which include the end mark but not the start mark."""
    return counts.groupBy("n").agg(F.count_distinct("word").alias("v"))


# ---- counts in files -----------------------------------------------------------

PARTS = 32  # of a context of fewer than two words, by what follows it
SHORT = 2  # size up to which a context has parts
BUCKET_BYTES = 8 << 20  # of stored text whose events make a bucket
EVENTS_HELD, BYTES_HELD = 1 << 20, 64 << 20  # by a task that combines equal events
DEALT = ("context", "part")


def part_of_context() -> Column:
    return F.when(F.size("context") < SHORT, F.pmod(F.hash("word"), F.lit(PARTS))).otherwise(0).cast("int")


@dataclass(frozen=True)
class Dealt:
    """Counts ``(context, part, word, cnt)`` under ``path``, a folder ``n=`` per size, bucketed by context and part.

    A context of two words or more is one part, the others are ``PARTS`` parts by the word that follows,
    so no task has all that follows a frequent word. What is asked by context is answered where the
    counts lie; only the parts of short contexts are added up elsewhere.
    """

    path: str
    sizes: tuple[int, ...]
    buckets: int


def write_dealt(rows: DataFrame, path: str, sizes: Sequence[int], buckets: int) -> Dealt:
    """Write ``(n, context, part, word, cnt)``, in place of what the folder held."""
    at = f"{path.rstrip('/')}/"
    if any(at.split(":", 1)[-1].replace("//", "/") in file.replace("//", "/") for file in rows.inputFiles()):
        raise ValueError(f"cannot overwrite {path}, which is also being read from")
    entry = f"dealt_{uuid.uuid4().hex}"
    writer = rows.select(*DEALT, "word", "cnt", "n").write.format("parquet").mode("overwrite").option("compression", "zstd")
    writer.partitionBy("n").bucketBy(buckets, *DEALT).option("path", path).saveAsTable(entry)
    rows.sparkSession.sql(f"DROP TABLE {entry}")  # the catalog's entry; the files stay
    return Dealt(path, tuple(sizes), buckets)


def read_dealt(spark: SparkSession, *tables: Dealt) -> DataFrame:
    """``(side, n, context, part, word, cnt)`` of one or more tables of as many buckets; ``side`` is a table's place.

    They are folders of one bucketed table, so equal contexts of all of them meet without an exchange.
    """
    entry = f"dealt_{uuid.uuid4().hex}"
    columns = "context ARRAY<STRING>, part INT, word STRING, cnt BIGINT, side INT, n INT"
    spark.sql(
        f"CREATE TABLE {entry} ({columns}) USING parquet PARTITIONED BY (side, n) "
        f"CLUSTERED BY (context, part) INTO {tables[0].buckets} BUCKETS LOCATION '{tables[0].path}'"
    )
    for side, table in enumerate(tables):
        for n in table.sizes:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.path}/n={n}")
            if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):  # a size without events has none
                spark.sql(f"ALTER TABLE {entry} ADD PARTITION (side={side}, n={n}) LOCATION '{table.path}/n={n}'")
    return spark.table(entry).select("side", "n", *DEALT, "word", "cnt")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(n, context, word, cnt)`` of files that ``write_dealt`` wrote."""
    files = spark.read.schema("context ARRAY<STRING>, word STRING, cnt BIGINT, n INT").parquet(path)
    return files.select("n", "context", "word", "cnt")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(gram)`` to ``(gram, cnt)``, equal ones among ``EVENTS_HELD`` added up, so a frequent one is few rows of a task."""
    held: list[pa.RecordBatch] = []

    def flush() -> list[pa.RecordBatch]:
        counts = pa.Table.from_batches(held).group_by("gram", use_threads=False).aggregate([([], "count_all")])
        held.clear()
        return counts.select(["gram", "count_all"]).rename_columns(["gram", "cnt"]).to_batches(max_chunksize=1 << 16)

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= EVENTS_HELD or sum(b.nbytes for b in held) >= BYTES_HELD:
            yield from flush()
    if held:
        yield from flush()


def _counted(df: DataFrame, sizes: Sequence[int], buckets: int, words_col: str) -> DataFrame:
    """``(n, context, part, word, cnt)``: events are dealt as one short text each, and counted where their bucket is.

    A task combines what it can beforehand without an exchange of its own. Single words repeat
    most: they are counted as ``event_counts`` does.
    """
    require_columns(df, words_col)
    long = [n for n in sizes if n > 1]
    parts = []
    if long:
        # the texts of several words: escaped once, before they are put together
        rows = _windows(df.select(F.transform(words_col, _escaped).alias("_words")), long, (), "_words")
        rows = rows.select(F.explode_outer("e").alias("e"))
        word = [F.coalesce(F.col("e")[f"b{j}"], F.lit(ESCAPE + "n")) for j in range(max(long))]
        grams = rows.select(F.explode(F.array(*[F.concat_ws(BETWEEN, *word[n - 1 :: -1]) for n in long])).alias("gram"))
        grams = grams.mapInArrow(_combined, "gram STRING, cnt BIGINT")
        words = _words_of("gram")
        last, rest = F.element_at(words, -1), F.slice(words, 1, F.size(words) - 1)
        part = F.when(F.size(words) <= SHORT, F.pmod(F.hash(last), F.lit(PARTS))).otherwise(0).cast("int")
        there = grams.repartition(buckets, rest, part).select(
            F.size(words).alias("n"), rest.alias("context"), part.alias("part"), last.alias("word"), "cnt"
        )
        parts.append(there.groupBy("n", *DEALT, "word").agg(F.sum("cnt").alias("cnt")))
    if len(long) < len(sizes):
        parts.append(event_counts(df, (1,), words_col).withColumn("part", part_of_context()))
    return reduce(DataFrame.unionByName, parts)


def _per_context(per_part: DataFrame, sizes: Sequence[int], sums: Sequence[str]) -> DataFrame:
    """``(n, context, *sums)`` from the sums per part: those of short contexts are added up, the others are whole."""
    whole = per_part.filter(F.col("n") > SHORT).select("n", "context", *sums)
    short = per_part.filter(F.col("n") <= SHORT).groupBy("n", "context").agg(*[F.sum(c).alias(c) for c in sums])
    kept = ([whole] if max(sizes) > SHORT else []) + ([short] if min(sizes) <= SHORT else [])
    return reduce(DataFrame.unionByName, kept)


@dataclass(frozen=True)
class NGramModel:
    """Fitted count tables, kept in the shared folder. Totals are added up and written when they are first asked for.

    ``dealt`` names the files of the counts where these are bucketed.
    """

    counts: DataFrame
    sizes: tuple[int, ...]
    laplace: bool = True
    stored_totals: DataFrame | None = None
    dealt: Dealt | None = None

    def summed(self) -> DataFrame:
        """``(n, context, total)``, from the written totals if there are any."""
        if self.stored_totals is not None or "totals" in self.__dict__:
            return self.totals
        if self.dealt is None:
            return context_totals(self.counts)
        table = read_dealt(self.counts.sparkSession, self.dealt)
        per_part = table.groupBy("n", *DEALT).agg(F.sum("cnt").alias("total"))
        return _per_context(per_part, self.sizes, ["total"])

    @cached_property
    def totals(self) -> DataFrame:
        if self.stored_totals is not None:
            return self.stored_totals
        return materialise(self.summed(), "ngram-totals", "zstd")

    @property
    def vocabulary(self) -> DataFrame:
        return event_vocabulary(self.counts)


def fit(df: DataFrame, sizes: Sequence[int] = (2, 3), *, laplace: bool = True, words_col: str = "_words") -> NGramModel:
    """Count once, write once; everything after reads the written tables."""
    spark = df.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(stored_bytes(df) / BUCKET_BYTES))
    dealt = write_dealt(_counted(df, sizes, buckets, words_col), fresh_path(spark, "ngram-counts"), sizes, buckets)
    return NGramModel(read_counts(spark, dealt.path), tuple(sizes), laplace, dealt=dealt)


def _v(model: NGramModel) -> Column:
    """Number of predicted words as a one-value subquery.

    Every word is predicted once per size, so the smallest size tells it for all.
    """
    smallest = model.counts.filter(F.col("n") == min(model.sizes))
    return smallest.agg(F.count_distinct("word")).scalar()


def probabilities(model: NGramModel, wanted: DataFrame) -> DataFrame:
    """Add ``cnt``, ``total`` and ``p`` to distinct ``(n, context, word)`` rows.

    Unseen counts are 0. With Laplace smoothing an unseen context gives ``1 / v``,
    without it 0. Both sides of the first join have unique keys; in the second a
    context may head many rows. What the first join finds is written, so ``wanted`` is
    computed once.
    """
    found = wanted.join(model.counts, ["n", "context", "word"], "left")
    found = lookup(found, model.totals, ["n", "context"], spread=salt_of("context", "word"))
    found = found.withColumn("cnt", F.coalesce("cnt", F.lit(0))).withColumn("total", F.coalesce("total", F.lit(0)))
    if model.laplace:
        return found.withColumn("_v", _v(model)).withColumn(
            "p", (F.col("cnt") + 1).cast("double") / (F.col("total") + F.col("_v"))
        ).drop("_v")
    return found.withColumn("p", F.coalesce(F.try_divide(F.col("cnt").cast("double"), F.col("total")), F.lit(0.0)))


def perplexity(
    model: NGramModel, df: DataFrame, words_col: str = "_words", *, scored: DataFrame | NGramModel | None = None
) -> DataFrame:
    """``(n, events, perplexity)`` of ``df``; ``scored`` may pass in its event counts, or the model that was fitted
    to it, where they are already there.

    The log probability of an event splits into a word part and a context part,
    ``ln(cnt + 1) - ln(total + v)``. The counted events of model and text are put together
    and dealt once, by context: there they add up by event, which gives the word part, and
    then by context, whose total is the sum of its counts. Nothing is sorted or joined, and
    as both sides are counted, a task holds a context's different words at most once each.
    Counts that lie in buckets are not dealt again: the sums of a long context are whole there.
    What has no partner adds ``ln(1)`` and ``ln(v)``.
    """
    plus = 1 if model.laplace else 0
    spark, none = df.sparkSession, F.lit(0).cast("bigint")
    asked = model.dealt if scored is model.counts else scored.dealt if isinstance(scored, NGramModel) else None
    bucketed = asked is not None and model.dealt is not None and model.dealt.buckets == asked.buckets
    if bucketed and asked == model.dealt:
        each, keys = read_dealt(spark, asked).withColumn("w", F.col("cnt")), ["n", *DEALT]
    elif bucketed:
        mine = [F.sum(F.when(F.col("side") == side, F.col("cnt")).otherwise(none)).alias(c) for side, c in enumerate(("cnt", "w"))]
        each, keys = read_dealt(spark, model.dealt, asked).groupBy("n", *DEALT, "word").agg(*mine), ["n", *DEALT]
    else:
        if isinstance(scored, NGramModel):
            scored = scored.counts
        text_counts = event_counts(df, model.sizes, words_col) if scored is None else scored
        both = model.counts.select("n", "context", "word", "cnt", none.alias("w")).unionByName(
            text_counts.select("n", "context", "word", none.alias("cnt"), F.col("cnt").alias("w"))
        )
        each = both.repartition("n", "context").groupBy("n", "context", "word").agg(F.sum("cnt").alias("cnt"), F.sum("w").alias("w"))
        keys = ["n", "context"]
    hit = (F.col("cnt") > 0) & (F.col("w") > 0) & F.col("word").isNotNull()
    per_context = each.groupBy(*keys).agg(
        F.sum("w").alias("w"), F.sum("cnt").alias("total"),
        F.sum(F.when(hit, F.col("w"))).alias("seen"),
        F.sum(F.when(hit, F.col("w") * F.ln(F.col("cnt") + plus))).alias("word_part"),
    )
    if bucketed:
        per_context = _per_context(per_context, {*model.sizes, *asked.sizes}, ["w", "total", "seen", "word_part"])
    known = (F.col("total") > 0) & (F.col("w") > 0)
    met = per_context.withColumn("_v", _v(model) if model.laplace else F.lit(0))
    everything = met.groupBy("n").agg(
        F.sum("w").alias("events"), F.sum("seen").alias("seen"), F.sum("word_part").alias("word_part"),
        F.sum(F.when(known, F.col("w"))).alias("met"),
        F.sum(F.when(known, F.col("w") * F.ln(F.col("total") + F.col("_v")))).alias("context_part"),
    )
    # one row per size also for an empty corpus, which reports infinity
    parts = df.sparkSession.createDataFrame([(n,) for n in model.sizes], "n INT")
    columns = ("events", "seen", "word_part", "met", "context_part")
    parts = parts.unionByName(everything, allowMissingColumns=True)
    summed = parts.groupBy("n").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    if model.laplace:
        unmet = (F.col("events") - F.col("met")) * F.ln("_v")
        summed = summed.withColumn("_v", _v(model))
        possible = F.col("events") > 0
    else:
        unmet = F.lit(0.0)
        possible = (F.col("events") > 0) & (F.col("seen") == F.col("events"))
    mean = F.try_divide(F.col("word_part") - F.col("context_part") - unmet, F.col("events"))
    return summed.select(
        "n", "events", F.when(possible, F.exp(-mean)).otherwise(F.lit(float("inf"))).alias("perplexity")
    )


def successors(model: NGramModel, contexts: DataFrame | None = None, k: int | None = None) -> DataFrame:
    """``(n, context, word, cnt)`` seen after a context, or the ``k`` most frequent with their rank."""
    rows = model.counts if contexts is None else model.counts.join(contexts, ["n", "context"], "left_semi")
    if k is None:
        return rows
    order = Window.partitionBy("n", "context").orderBy(F.desc("cnt"), "word")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# ---- drawing words -------------------------------------------------------------

TOTAL_WEIGHT = 1 << 53  # of one context: exact as a double
SUB_DIGITS = 2  # 256 parts of a large context at least
SUCCESSORS_HELD = 1 << 12  # of a context that is not cut into parts, and of a part
ROWS_PER_BUCKET = 1 << 20
DRAWS_BROADCAST = 500_000


def sharpened(model: NGramModel, temperature: float = 0.8) -> DataFrame:
    """``(n, context, word, cnt, q)``: ``q`` is ``p ** (1/T)`` renormalised over the seen successors.

    The denominator of ``p`` is the same for all successors of a context and cancels.
    """
    plus = 1 if model.laplace else 0
    raised = F.pow((F.col("cnt") + plus).cast("double"), F.lit(1.0 / temperature))
    sums = model.counts.groupBy("n", "context").agg(F.sum(raised).alias("mass"), F.count(F.lit(1)).alias("cnt"))
    sums = materialise(sums, "ngram-masses")
    found = lookup(
        model.counts, sums.drop("cnt"), ["n", "context"], spread=salt_of("context", "word"), counts=sums.drop("mass")
    )
    return found.select("n", "context", "word", "cnt", (raised / F.col("mass")).alias("q"))


@dataclass(frozen=True)
class DrawTable:
    """Cumulative integer weights of the seen successors of every context, an entry per successor.

    ``entries(place, n, key, part, word, lo, hi, part_mass)``: a draw ``r`` inside a part picks the entry with
    ``lo <= r < hi``. ``key`` is the context as text. A context is one part, the empty one, unless it has more
    than ``SUCCESSORS_HELD`` successors: those lie in parts by the hash of their word, and ``parts(n, key, part,
    start, part_mass, whole_mass)`` tells where in the context a part begins. The entries are bucketed by
    ``place``, a short hash of context and part, so draws come to them and they stay where they are.
    """

    entries: DataFrame
    parts: DataFrame  # of large contexts only
    most: int  # words of a context

    @property
    def contexts(self) -> DataFrame:
        """``(n, context, successors, mass)``."""
        sums = self.entries.groupBy("n", "key").agg(
            F.count(F.lit(1)).alias("successors"), F.sum(F.col("hi") - F.col("lo")).alias("mass")
        )
        return sums.select("n", _context_of().alias("context"), "successors", "mass")

    @property
    def cells(self) -> DataFrame:
        """``(n, context, part, steps)`` with ``(lo, hi, word)`` as places in the whole context."""
        start = F.coalesce("start", F.lit(0))
        placed = self.entries.join(self.parts.select("n", "key", "part", "start"), ["n", "key", "part"], "left")
        step = F.struct((F.col("lo") + start).alias("lo"), (F.col("hi") + start).alias("hi"), "word")
        steps = placed.groupBy("n", "key", "part").agg(F.collect_list(step).alias("steps"))
        return steps.select("n", _context_of().alias("context"), "part", "steps")


def _place() -> Column:
    return F.hash("n", "key", "part")


def _sizes(n: int | Sequence[int]) -> list[int]:
    return [n] if isinstance(n, int) else list(n)


def draw_table(model: NGramModel, n: int | Sequence[int], temperature: float = 1.0) -> DrawTable:
    """Draw table of one or several sizes of the model. Weights are ``cnt + 1`` (or ``cnt`` unsmoothed); other temperatures give
    weights relative to the largest, as finely as a uniform double can tell them
    apart. A successor below that, 2 ** -53 of its context, cannot be drawn.

    The counts are exchanged once, by context and part; there they are weighed, added up and
    written. Large contexts are found beforehand, so no task sees all successors of a hot one;
    the number of their parts follows the number of words.
    """
    plus = 1 if model.laplace else 0
    sizes = _sizes(n)
    counted = model.counts.filter(F.col("n").isin(sizes))
    words = counted.filter(F.col("n") == min(sizes)).agg(F.approx_count_distinct("word")).first()[0]
    digits = SUB_DIGITS
    while 16**digits * SUCCESSORS_HELD < words:
        digits += 1
    spark, rows = counted.sparkSession, counted.count()
    keyed = counted.select("n", _key(max(sizes) - 1).alias("key"), "word", (F.col("cnt") + plus).alias("weight"))
    large = _large_contexts(keyed, rows)
    sub = F.substring(F.md5("word"), 1, digits)
    given = ["top", "successors"] if temperature != 1.0 else []
    keys = ["n", "key", "part"]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(rows / ROWS_PER_BUCKET))
    marked = keyed.join(F.broadcast(large), ["n", "key"], "left")
    own = F.when(F.col("successors").isNull(), "").otherwise(sub).alias("part")
    # the place is worked out anew behind the exchange: it would not compress
    dealt = marked.select("n", "key", "word", "weight", *given, own).repartition(buckets, _place()).withColumn("place", _place())
    part = Window.partitionBy("place", *keys)
    if temperature != 1.0:
        top, number = F.coalesce("top", F.max("weight").over(part)), F.coalesce("successors", F.count(F.lit(1)).over(part))
        weighed = dealt.withColumn("_top", top).withColumn("_number", number)
        relative = F.pow(F.col("weight") / F.col("_top"), F.lit(1.0 / temperature))
        unit = F.floor(F.lit(TOTAL_WEIGHT) / F.col("_number"))
        dealt = weighed.select("place", *keys, "word", F.round(relative * unit).cast("bigint").alias("weight")).filter("weight > 0")
    running = part.orderBy(sub, "word").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = dealt.withColumn("hi", F.sum("weight").over(running)).withColumn("part_mass", F.sum("weight").over(part))
    entries = materialise_bucketed(
        summed.select("place", *keys, "word", (F.col("hi") - F.col("weight")).alias("lo"), "hi", "part_mass"),
        "ngram-draws", buckets, "place",
    )
    before = Window.partitionBy("n", "key").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    masses = entries.filter("part <> ''").groupBy(*keys).agg(F.max("part_mass").alias("part_mass"))
    parts = masses.select(
        *keys, (F.sum("part_mass").over(before) - F.col("part_mass")).alias("start"), "part_mass",
        F.sum("part_mass").over(Window.partitionBy("n", "key")).alias("whole_mass"),
    )
    return DrawTable(entries, materialise(parts, "ngram-draw-parts"), max(sizes) - 1)


def _large_contexts(keyed: DataFrame, rows: int) -> DataFrame:
    """``(n, key, successors, top)`` of the contexts with more than ``SUCCESSORS_HELD`` successors, ``top`` their largest weight.

    Successors are counted by a hash of the context first, which shuffles little; only what is
    in a bucket that is full enough is counted by context.
    """
    buckets = max(1 << 12, rows // (SUCCESSORS_HELD // 4))
    hashed = keyed.withColumn("_b", F.pmod(F.xxhash64("n", "key"), F.lit(buckets)).cast("int"))
    full = hashed.groupBy("_b").count().filter(F.col("count") > SUCCESSORS_HELD).select("_b")
    per_context = hashed.join(F.broadcast(full), "_b", "left_semi").groupBy("n", "key").agg(
        F.count(F.lit(1)).alias("successors"), F.max("weight").alias("top")
    )
    return materialise(per_context.filter(F.col("successors") > SUCCESSORS_HELD), "ngram-large-contexts")


def draw(table: DrawTable, states: DataFrame, u: Column, id_col: str = "sent_id") -> DataFrame:
    """Add the drawn ``word`` to rows that have ``n`` and ``context``; ``id_col`` tells them apart.

    ``u`` is a uniform number per row. A row whose context was never seen gets NULL.
    """
    located = materialise(states, "draw-states")
    drawn = _step(table, located, u, located.count()).select(id_col, "word")
    return located.join(drawn, id_col, "left").select(*states.columns, "word")


def _at(u: Column, mass: Column) -> Column:
    return F.least(F.floor(u * mass).cast("bigint"), mass - 1)


def _step(table: DrawTable, states: DataFrame, u: Column, rows: int | None = None) -> DataFrame:
    """One draw for rows ``(n, context, ...)``; adds the drawn ``word``, rows in a context without a successor are gone.

    A draw from a large context picks its part first. Few draws are broadcast to the entries; many
    are dealt like these, which stay in their buckets either way. ``rows`` may tell how many there are.
    """
    own = [c for c in states.columns if c != "word"]
    drawing = states.select(*own, _key(table.most).alias("_key"), u.alias("_u"))
    cut = table.parts.select(F.col("n").alias("_n"), F.col("key").alias("_k"), "part", "start", "part_mass", "whole_mass")
    at = drawing.join(cut, (F.col("n") == F.col("_n")) & (F.col("_key") == F.col("_k"))).withColumn("_r", _at(F.col("_u"), F.col("whole_mass")))
    inside = at.filter((F.col("_r") >= F.col("start")) & (F.col("_r") < F.col("start") + F.col("part_mass")))
    # a large context has no empty part, so of the two probes of its rows only one can meet entries
    probes = inside.select(*own, "_key", "_u", F.col("part").alias("_part"), (F.col("_r") - F.col("start")).alias("_r")).unionByName(
        drawing.withColumn("_part", F.lit("")).withColumn("_r", F.lit(None).cast("bigint"))
    ).withColumn("_place", F.hash("n", "_key", "_part"))
    if rows is not None:
        probes = F.broadcast(probes) if rows <= DRAWS_BROADCAST else probes.hint("shuffle_hash")
    e = table.entries.select(*[F.col(c).alias(f"_e_{c}") for c in table.entries.columns])
    # equal places are met by one number; that context and part are the same is told by order, so as not to be a key of the join
    same = F.col("_place") == F.col("_e_place")
    for mine, theirs in (("n", "_e_n"), ("_key", "_e_key"), ("_part", "_e_part")):
        same = same & (F.col(mine) <= F.col(theirs)) & (F.col(mine) >= F.col(theirs))
    r = F.coalesce("_r", _at(F.col("_u"), F.col("_e_part_mass")))
    met = probes.join(e, same & (r >= F.col("_e_lo")) & (r < F.col("_e_hi")))
    return met.select(*own, F.col("_e_word").alias("word"))


def generate(
    model: NGramModel,
    seeds: DataFrame,
    n: int | Sequence[int],
    *,
    max_length: int = 15,
    temperature: float = 1.0,
    seed: int = 42,
    id_col: str = "sent_id",
    start_col: str | None = None,
) -> DataFrame:
    """One sentence ``(n, sent_id, words, sentence)`` per row of ``seeds`` and size, all grown together.

    Sentences begin like documents do, or with the token in ``start_col``; the token is
    then the first word and must have been seen at a document's start for ``n > 2``, or
    anywhere for ``n = 2``. Each step is one draw for every open sentence of every size. What
    a step adds is written, ``(n, sent_id, step, word)`` and the state to go on from; the words
    are gathered by sentence at the end. As many sentences come out as seeds go in: a
    sentence without a next word is an error.
    """
    sizes = _sizes(n)
    table = draw_table(model, sizes, temperature)
    begins = {size: F.array_repeat(F.lit(BOS), size - 1).cast("array<string>") for size in sizes}
    every = F.explode(F.array(*[F.struct(F.lit(size).alias("n"), begins[size].alias("context")) for size in sizes]))
    opened = seeds.select(F.col(id_col), *([F.col(start_col).alias("_start")] if start_col else []), every.alias("s"))
    opened = materialise(opened, "sentence-seeds")  # read again at the end; what they are made of is computed once
    if start_col is None:
        is_first = F.col("key") == F.array_join(F.array_repeat(F.lit(BOS), F.col("n") - 1), BETWEEN)
        if table.entries.filter(is_first).select("n").distinct().count() < len(sizes):
            raise ValueError("the model has seen no document")
        begun = opened.select(id_col, "s.*")
        parts = []
    else:
        led = F.slice(F.concat("s.context", F.array("_start")), F.lit(2), F.col("s.n") - 1).alias("context")
        begun = opened.select(id_col, "s.n", led)
        parts = [opened.select("s.n", id_col, F.lit(0).alias("step"), F.col("_start").alias("word"))]
    state = materialise(begun, "sentences")
    standing = state.count()
    moved = F.slice(F.concat("context", F.array("word")), F.lit(2), F.col("n") - 1).alias("context")
    for step in range(1, max_length + 1 - len(parts)):
        drawn = _step(table, state, uniform(f"{seed}:{step}", F.col(id_col)), standing)
        state = materialise(drawn.select(id_col, "n", moved, "word", F.lit(step).alias("step")), "sentences")
        ends = F.col("word") == EOS
        seen = state.agg(F.count("word").alias("drawn"), F.count_if(~ends).alias("open")).first()
        if seen.drawn < standing:
            raise ValueError(f"{standing - seen.drawn} sentences stand in a context without a successor")
        standing = seen.open
        parts.append(state.filter(~ends).select("n", id_col, "step", "word"))
        if not seen.open:
            break
        state = state.filter(~ends).drop("word", "step")
    grown = reduce(DataFrame.unionByName, parts).groupBy("n", id_col).agg(
        F.array_sort(F.collect_list(F.struct("step", "word"))).alias("entries")
    )
    words = F.coalesce(F.transform("entries", lambda e: e["word"]), F.array().cast("array<string>"))
    out = opened.select("s.n", id_col).join(grown, ["n", id_col], "left").select("n", id_col, words.alias("words"))
    return out.withColumn("sentence", F.array_join("words", " "))
