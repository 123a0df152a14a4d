"""Subword pieces learned from a corpus, and encoding with them.

A piece at the start of a word is written plainly, one inside a word carries the
mark ``##``. Segmentation runs once per distinct word; documents look the result up. Where
documents must not move, it runs once per distinct word of a task, which has the piece table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.operators.lookup import lookup, salt_of, translate
from corpuslens.operators.wordforms import distinct_words
from corpuslens.session import materialise

# Special pieces with their ids, the inner mark.
SPECIAL_PIECES = {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3}
INNER = "##"
THRESHOLDS = (256, 320, 384, 448, 512)


def learn_pieces(
    df: DataFrame, size: int = 30_000, max_piece: int = 6, words_col: str = "_words", words: DataFrame | None = None
) -> DataFrame:
    """``(piece, id, cnt)``: special pieces, every single character, then the ``size``
    most frequent word beginnings and endings of 2 to ``max_piece`` characters.
    """
    words = distinct_words(df, words_col) if words is None else words
    length = F.char_length("token")
    first = F.transform(
        F.sequence(F.lit(2), F.greatest(F.least(length, F.lit(max_piece)), F.lit(2))),
        lambda k: F.when(k <= length, F.substring(F.col("token"), F.lit(1), k)),
    )
    last = F.transform(
        F.sequence(F.lit(2), F.greatest(F.least(length - 1, F.lit(max_piece)), F.lit(2))),
        lambda k: F.when(k < length, F.concat(F.lit(INNER), F.substring(F.col("token"), length - k + 1, k))),
    )
    singles = F.transform(
        F.sequence(F.lit(1), length),
        lambda i: F.concat(F.when(i == 1, "").otherwise(INNER), F.substring(F.col("token"), i, F.lit(1))),
    )
    counted = (
        words.select("cnt", F.explode_outer(F.concat(first, last, singles)).alias("piece"))
        .filter("piece IS NOT NULL")
        .groupBy("piece")
        .agg(F.sum("cnt").alias("cnt"))
    )
    counted = materialise(counted.withColumn("single", F.char_length(F.regexp_replace("piece", f"^{INNER}(?=.)", "")) == 1), "pieces-counted")
    # both parts are bounded: by the number of characters, and by size
    longer = counted.filter("NOT single").orderBy(F.desc("cnt"), "piece").limit(size)
    kept = counted.filter("single").unionByName(longer)
    order = Window.orderBy(F.desc("single"), F.desc("cnt"), "piece")
    numbered = kept.select("piece", (F.row_number().over(order) - 1 + len(SPECIAL_PIECES)).alias("id"), "cnt")
    specials = df.sparkSession.createDataFrame(
        [(p, i, 0) for p, i in SPECIAL_PIECES.items()], "piece STRING, id INT, cnt BIGINT"
    )
    return materialise(specials.unionByName(numbered), "pieces")


def with_log_probability(pieces: DataFrame) -> DataFrame:
    """Add ``logp``, the log share of every ordinary piece."""
    total = pieces.agg(F.sum("cnt")).scalar()
    ordinary = pieces.filter(F.col("id") >= len(SPECIAL_PIECES))
    return materialise(ordinary.withColumn("_t", total).select("piece", "id", "cnt", F.ln(F.col("cnt") / F.col("_t")).alias("logp")), "unigram-pieces")


def _matches(words: DataFrame, pieces: DataFrame, max_piece: int) -> DataFrame:
    """``(token, start, length, ...)`` for every piece found in a word.

    A word has at most ``max_piece`` candidates a position. They stay where their word is: the
    piece table is as small as the vocabulary asked for, so its statistics make the join a
    broadcast, and the words' partitioning serves the grouping that follows.
    """
    starts = F.explode_outer(F.sequence(F.lit(1), F.char_length("token")))
    sizes = F.explode(F.array(*[F.lit(k) for k in range(1, max_piece + 1)]))
    mark = F.when(F.col("start") == 1, "").otherwise(INNER)
    exploded = (
        words.select("token").repartition("token")
        .select("token", starts.alias("start"))
        .select("token", "start", sizes.alias("length"))
        .filter(F.col("start") + F.col("length") <= F.char_length("token") + 1)
        .withColumn("piece", F.concat(mark, F.substring(F.col("token"), F.col("start"), F.col("length"))))
    )
    return exploded.join(pieces.filter("id IS NOT NULL"), "piece")


def _piece_limit(pieces: DataFrame) -> int:
    ordinary = pieces.filter(F.col("id") >= len(SPECIAL_PIECES))
    return ordinary.agg(F.max(F.char_length(F.regexp_replace("piece", f"^{INNER}(?=.)", "")))).first()[0] or 1


def greedy_table(words: DataFrame, pieces: DataFrame, longest_word: int | None = None) -> DataFrame:
    """``(token, pieces, cnt)``: piece ids by longest match from the left.

    A word that cannot be covered is the unknown piece, and so is one of more than
    ``longest_word`` characters, if that is given.
    """
    unknown = F.array(F.lit(SPECIAL_PIECES["[UNK]"]))
    short = words if longest_word is None else words.filter(F.char_length("token") <= longest_word)
    # per position the longest piece sorts first, and the walk takes only the first
    span = F.struct("start", (-F.col("length")).alias("back"), "id")
    spans = (
        _matches(short, pieces, _piece_limit(pieces)).groupBy("token").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    )

    def walk(state: Column, span: Column) -> Column:
        taken = F.struct(
            (state["next"] - span["back"]).alias("next"), F.concat(state["ids"], F.array(span["id"])).alias("ids")
        )
        return F.when(span["start"] == state["next"], taken).otherwise(state)

    begin = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("ids"))
    walked = spans.select("token", F.aggregate("spans", begin, walk).alias("w"))
    covered = F.col("w.next") == F.char_length("token") + 1
    joined = words.join(walked, "token", "left")
    return joined.select("token", F.when(covered, F.col("w.ids")).otherwise(unknown).alias("pieces"), "cnt")


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _best_path(size: pd.Series, starts: pd.Series, lengths: pd.Series, ids: pd.Series, logps: pd.Series) -> pd.Series:
    """Most probable cover of each word by its spans, sorted by start and length; NULL if there is none."""

    def solve(size, *spans):
        score = [0.0] + [float("-inf")] * size  # best log probability of a cover up to each position
        last = [(0, 0)] * (size + 1)  # length and id of the piece that ends there
        for start, length, piece, logp in zip(*spans):
            candidate = (score[start - 1] + logp, length)
            end = start + length - 1
            if candidate[0] > float("-inf") and candidate > (score[end], last[end][0]):
                score[end], last[end] = candidate[0], (length, piece)
        if score[size] == float("-inf"):
            return None
        path = []
        while size:
            length, piece = last[size]
            path.append(piece)
            size -= length
        return path[::-1]

    return pd.Series([solve(*row) for row in zip(size, starts, lengths, ids, logps)])


def unigram_table(words: DataFrame, pieces: DataFrame | None) -> DataFrame:
    """``(token, pieces, cnt)``: piece ids of the most probable segmentation.

    ``pieces`` needs ``logp``. Ties prefer the longer last piece.
    """
    if pieces is None:
        raise ValueError("unigram tokenisation needs a piece table (piece, id, logp)")
    unknown = F.array(F.lit(SPECIAL_PIECES["[UNK]"]))
    spans = (
        _matches(words, pieces, _piece_limit(pieces))
        .groupBy("token")
        .agg(F.array_sort(F.collect_list(F.struct("start", "length", "id", "logp"))).alias("spans"))
    )
    arrays = [F.col("spans")[c] for c in ("start", "length", "id", "logp")]
    solved = spans.select("token", _best_path(F.char_length("token"), *arrays).alias("path"))
    return words.join(solved, "token", "left").select("token", F.coalesce("path", unknown).alias("pieces"), "cnt")


# ---- words segmented where they stand ------------------------------------------

WORDS_HELD = 1 << 18  # with their pieces, by a task
ROWS_AT_ONCE = 512

Spans = dict[str, list[tuple[int, float | None]]]  # ids of a piece, the smallest first, with their logp


def _greedy_cover(token: str, spans: Spans, limit: int) -> list[int] | None:
    """What ``greedy_table`` finds for one word; None if it cannot be covered."""
    if not token:
        return [] if INNER in spans else None
    at, ids = 0, []
    while at < len(token):
        for end in range(min(at + limit, len(token)), at, -1):
            found = spans.get(INNER + token[at:end] if at else token[:end])
            if found:
                ids.append(found[0][0])
                at = end
                break
        else:
            return None
    return ids


def _best_cover(token: str, spans: Spans, limit: int) -> list[int] | None:
    """What ``unigram_table`` finds for one word; None if it cannot be covered."""
    if not token:
        return [] if INNER in spans else None
    size = len(token)
    score, last = [0.0] + [float("-inf")] * size, [(0, 0)] * (size + 1)
    for at in range(size):
        if score[at] == float("-inf"):
            continue
        for end in range(at + 1, min(at + limit, size) + 1):
            for piece, logp in spans.get(INNER + token[at:end] if at else token[:end], ()):
                if logp is not None and (score[at] + logp, end - at) > (score[end], last[end][0]):
                    score[end], last[end] = score[at] + logp, (end - at, piece)
    if score[size] == float("-inf"):
        return None
    path = []
    while size:
        length, piece = last[size]
        path.append(piece)
        size -= length
    return path[::-1]


def _segmenter(cover: Callable[[str, Spans, int], list[int] | None], spans: Spans, limit: int):
    """Arrays of words to the ids of their pieces, one after the other; a NULL word has none."""
    unknown = [SPECIAL_PIECES["[UNK]"]]

    def segment(rows: pa.Array, held: dict[str, list[int]]) -> pa.Array:
        sizes = np.asarray(rows.value_lengths().fill_null(0), dtype=np.int64)
        coded = rows.flatten().dictionary_encode()
        ids = []
        for word in coded.dictionary.to_pylist():
            found = held.get(word)
            if found is None:
                found = cover(word, spans, limit)
                found = held[word] = unknown if found is None else found
            ids.append(found)
        ids.append([])  # of a NULL word
        lengths = np.array([len(x) for x in ids], dtype=np.int64)
        pool = np.array([i for x in ids for i in x], dtype=np.int32)
        at = np.asarray(coded.indices.fill_null(len(ids) - 1), dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths[at])])
        starts = np.cumsum(lengths) - lengths
        values = pool[np.repeat(starts[at] - ends[:-1], lengths[at]) + np.arange(ends[-1])]
        offsets = ends[np.concatenate([[0], np.cumsum(sizes)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def segmented(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held: dict[str, list[int]] = {}
        for batch in batches:
            done = [pa.array([], pa.list_(pa.int32()))]
            for at in range(0, len(batch), ROWS_AT_ONCE):
                if len(held) > WORDS_HELD:
                    held.clear()
                done.append(segment(batch.slice(at, ROWS_AT_ONCE), held))
            yield pa.concat_arrays(done)

    return segmented


def _spans(pieces: DataFrame, scored: bool) -> Spans:
    """The piece table for the tasks: as many rows as the vocabulary asked for."""
    logp = F.col("logp") if scored else F.lit(None).cast("double")
    spans: Spans = {}
    for r in pieces.filter("id IS NOT NULL AND piece IS NOT NULL").select("piece", "id", logp.alias("logp")).collect():
        spans.setdefault(r.piece, []).append((r.id, r.logp))
    return {piece: sorted(found, key=lambda x: x[0]) for piece, found in spans.items()}


# ---- merges learned from the corpus --------------------------------------------

JOINT = "\x01"  # between the two sides of a pair, where both stand in one string


def _joined(symbols: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Walk from the left; a symbol is joined to what stands before it if ``pairs`` lists the two."""
    listed = [f"{a}{JOINT}{b}" for a, b in pairs]

    def step(done: Column, symbol: Column) -> Column:
        last = F.element_at(done, -1)
        fits = F.concat(last, F.lit(JOINT), symbol).isin(listed)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(last, symbol)))
        return F.when(fits, longer).otherwise(F.concat(done, F.array(symbol)))

    rest = F.slice(symbols, 2, F.greatest(F.size(symbols) - 1, F.lit(0)))
    return F.when(F.size(symbols) > 1, F.aggregate(rest, F.slice(symbols, 1, 1), step)).otherwise(symbols)


def merge_table(words: DataFrame, rounds: int = 8, per_round: int = 64) -> tuple[DataFrame, list[list[tuple[str, str]]]]:
    """``(token, pieces, cnt)`` with the pieces that merging leaves, and the merges of each round.

    A word starts as its characters. Every round counts adjacent pairs over the distinct
    words, weighted by their frequency, and merges the ``per_round`` most frequent ones
    (ties: first pair by text). The driver sees ``per_round`` rows a round.
    """
    table = words.select("token", F.split("token", "").alias("pieces"), "cnt")
    merges = []
    for number in range(rounds):
        pairs = F.arrays_zip(
            F.slice("pieces", 1, F.greatest(F.size("pieces") - 1, F.lit(0))).alias("a"),
            F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0))).alias("b"),
        )
        counted = (
            table.select(F.explode(pairs).alias("p"), "cnt").groupBy("p.a", "p.b").agg(F.sum("cnt").alias("cnt"))
        )
        top = counted.orderBy(F.desc("cnt"), "a", "b").limit(per_round).collect()
        if not top:
            break
        merges.append([(r.a, r.b) for r in top])
        table = materialise(table.withColumn("pieces", _joined(F.col("pieces"), merges[-1])), f"merged-{number}")
    return table, merges


def merged(words: DataFrame, merges: Sequence[Sequence[tuple[str, str]]]) -> DataFrame:
    """``(token, pieces, cnt)`` of any words under merges learned before."""
    pieces = F.split("token", "")
    for pairs in merges:
        pieces = _joined(pieces, pairs)
    return words.select("token", pieces.alias("pieces"), "cnt")


def lengths(df: DataFrame, table: DataFrame, words_col: str = "_words", id_col: str = "doc_id", extra: int = 2) -> DataFrame:
    """``(doc_id, length)``: pieces per whole document by a table ``(token, pieces, cnt)``, and ``extra`` boundary pieces."""
    sizes = table.select("token", F.size("pieces").alias("size"))
    exploded = df.select(id_col, F.posexplode_outer(words_col).alias("pos", "token"))
    found = lookup(exploded, sizes, ["token"], spread=salt_of(id_col, "pos"), counts=table.select("token", "cnt"))
    return found.groupBy(id_col).agg((F.coalesce(F.sum("size"), F.lit(0)) + extra).cast("int").alias("length"))


def encode(
    df: DataFrame,
    pieces: DataFrame,
    *,
    kind: str = "wordpiece",
    max_length: int | None = 512,
    words_col: str = "_words",
    id_col: str = "doc_id",
    words: DataFrame | None = None,
    merges: Sequence[tuple[str, str, int]] | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``(doc_id, _input_ids, _attention_mask, _word_count)``, ids per document.

    Ids are wrapped in the class and separator pieces and cut to ``max_length``
    including both (``None``: whole); nothing is padded. Only ids and words are read and
    moved. ``words`` may pass in the distinct words of ``df`` where they are already counted.
    ``kind="bpe"`` needs ``merges`` and their pieces, see ``operators.merges``.

    Where other columns are wanted, ``keep`` names them: words are then segmented where their
    document is, row by row and with the same pieces, so no text moves and nothing is joined
    afterwards. Under learned merges the result is joined to these columns.
    """
    tables = {"wordpiece": greedy_table, "unigram": unigram_table, "bpe": _merge_table(merges)}
    covers = {"wordpiece": _greedy_cover, "unigram": _best_cover}
    if kind not in tables:
        raise ValueError(f"kind must be one of {', '.join(tables)}, got {kind!r}")
    kept = list(keep or ())
    if keep is not None and kind in covers:
        if pieces is None:
            raise ValueError(f"{kind} tokenisation needs a piece table")
        segment = _segmenter(covers[kind], _spans(pieces, kind == "unigram"), _piece_limit(pieces))
        found = df.select(id_col, *kept, segment(F.col(words_col)).alias("_parts"))
    else:
        if words is None:
            words = materialise(distinct_words(df, words_col), "subword-words")
        segmented = materialise(tables[kind](words, pieces), "subword-table")
        table = segmented.select(F.col("token").alias("key"), F.col("pieces").alias("value"))
        nothing = F.array().cast("array<int>")
        found = translate(df, table, array=words_col, out="_parts", default=nothing, id_col=id_col)
        found = found.select(id_col, F.flatten("_parts").alias("_parts"))
        if kept:
            found = df.select(id_col, *kept).join(found, id_col)
    body = F.col("_parts")
    inner = body if max_length is None else F.slice(body, 1, max(max_length - 2, 0))
    ids = F.concat(F.array(F.lit(SPECIAL_PIECES["[CLS]"])), inner, F.array(F.lit(SPECIAL_PIECES["[SEP]"])))
    encoded = found.select(id_col, *kept, ids.alias("_input_ids"))
    size = F.size("_input_ids")
    return encoded.withColumns({"_attention_mask": F.array_repeat(F.lit(1), size), "_word_count": size})


def _merge_table(merges: Sequence[tuple[str, str, int]] | None):
    def table(words: DataFrame, pieces: DataFrame) -> DataFrame:
        if merges is None:
            raise ValueError("bpe tokenisation needs merges: call operators.merges.learn_merges first")
        from corpuslens.operators.merges import merge_table

        return merge_table(words, merges, pieces)

    return table


def length_coverage(lengths: DataFrame, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """``(tokenizer, threshold, percent)`` of documents whose ``length`` fits."""
    shares = [F.avg(F.when(F.col("length") <= t, 100.0).otherwise(0.0)).alias(str(t)) for t in thresholds]
    wide = lengths.groupBy("tokenizer").agg(*shares)
    long = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"`{t}`").alias("percent")) for t in thresholds]))
    return wide.select("tokenizer", long.alias("c")).select("tokenizer", "c.threshold", "c.percent")


def length_distribution(lengths: DataFrame, exact: bool = True) -> DataFrame:
    """``(tokenizer, median, p95, p99)`` of ``length``."""
    shares = {"median": 0.5, "p95": 0.95, "p99": 0.99}
    if exact:
        histogram = lengths.groupBy("tokenizer", "length").agg(F.count(F.lit(1)).alias("cnt"))
        columns = [F.percentile("length", s, F.col("cnt")).alias(n) for n, s in shares.items()]
        return histogram.groupBy("tokenizer").agg(*columns)
    columns = [F.percentile_approx("length", s).cast("double").alias(n) for n, s in shares.items()]
    return lengths.groupBy("tokenizer").agg(*columns)
