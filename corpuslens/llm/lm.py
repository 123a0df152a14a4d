"""Language-model scores: a log-bilinear network trained with noise contrast, and exact word counts.

A token is a word hash or the end of the text. The network predicts the output group of the
next token: the most frequent tokens are groups of their own, all other words fall into
groups by their last letters. Within a group a word has the smoothed share of its exact
count, with one place for words not seen, so the probabilities of a text's tokens are
normalised. The context is the last ``CONTEXT`` tokens; each has a vector, scaled by a
vector per position and summed; its product with a group's vector plus a bias is the
group's score.

Counts cover all training texts and grow with them. Every task trains on all tokens of its
texts, in batches of matrix products with shared noise; the weights are averaged over the
tasks by Spark, by numbers of tokens. Scoring applies the softmax over all groups. Counts
of frequent words, a bounded table, are broadcast; rarer words are joined.

Defined cases: a null or empty text is its end alone; a null id counts as the empty text in
the fold; rows that repeat are scored each; without training texts every count is 0;
further columns are not read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.words import LOWERED, SPACE, mix, placed_words, slices, utf8
from corpuslens.session import materialise

CONTEXT = 3
WIDTH = 24
OWN_OUTPUTS = 128
OWN_INPUTS = 2048
ENDINGS = 128  # a power of two
FREQUENT = 1 << 18  # words whose counts are broadcast
BATCH = 4096
NOISE = 64
RATE = 0.15
SCORED_AT_ONCE = 1 << 10
END = 0  # hash that stands for the end of a text
BUCKET_BITS = 20  # of the index over the frequent words
START = OWN_INPUTS + ENDINGS
OUTPUTS = OWN_OUTPUTS + ENDINGS

Weights = dict[str, np.ndarray]


def ending(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Group of each word by its last three bytes, in lower case."""
    code = np.zeros(len(first), np.uint64)
    for k in range(1, 4):
        letters = LOWERED[data[np.maximum(first + size - k, first)]]
        code = code * np.uint64(3) + np.where(size >= k, letters, np.uint64(0))
    return mix(code, 31) % np.uint64(ENDINGS)


def ending_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(ENDINGS - 1)).astype(np.int64)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, with their ending in the low bits, and the rows' offsets; ends are left out."""
    data, starts = utf8(column)
    hashes, offsets, first, size = placed_words(data, starts, lower=True, separators=SPACE)
    return (hashes & ~np.uint64(ENDINGS - 1)) | ending(data, first, size), offsets


def in_training() -> Column:
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 7 != 2


def counts(texts: DataFrame) -> DataFrame:
    """``(hash, cnt)`` of every token of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 16 << 20):
                found, n = np.unique(tokens(batch.column("text"))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(found.view(np.int64), END)), pa.array(np.append(n, batch.num_rows))], names=["hash", "cnt"]
                )

    made = texts.select("text").mapInArrow(run, "hash long, cnt long")
    return made.groupBy("hash").agg(F.sum("cnt").alias("cnt"))


@dataclass
class Lexicon:
    """Frequent words by hash: their counts, input and output numbers; and what all words add up to."""

    hashes: np.ndarray
    cnt: np.ndarray
    input: np.ndarray  # -1: by ending
    output: np.ndarray  # -1: by ending
    tokens: int
    types: int
    mass: np.ndarray  # by ending: sum of count + 1 over words without an output of their own, plus one
    noise: np.ndarray  # share of each output

    def __post_init__(self):
        edges = np.arange(1 << BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
        self.starts = np.searchsorted(self.hashes, edges).astype(np.int32)
        self.ended = np.append(self.hashes, np.uint64((1 << 64) - 1))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the table, -1 if it is not frequent; a few steps from its bucket's start."""
        at = self.starts[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)]
        found = np.full(len(hashes), -1)
        held = self.ended[at]
        same = held == hashes
        found[same] = at[same]
        rest = np.flatnonzero(held < hashes)
        while len(rest):
            at[rest] += 1
            held, wanted = self.ended[at[rest]], hashes[rest]
            same = held == wanted
            found[rest[same]] = at[rest[same]]
            rest = rest[held < wanted]
        return np.where(found < len(self.hashes), found, -1)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the table, input and output number of each word."""
        at, endings = self.find(hashes), ending_of(hashes)
        into, out = np.append(self.input, -1)[at], np.append(self.output, -1)[at]
        return at, np.where(into >= 0, into, OWN_INPUTS + endings), np.where(out >= 0, out, OWN_OUTPUTS + endings)


def lexicon(counted: DataFrame) -> Lexicon:
    """The bounded part of the counts that tasks need at hand."""
    words = counted.filter(F.col("hash") != END)
    top = words.orderBy(F.desc("cnt"), "hash").limit(FREQUENT).toArrow()
    ranked, cnt = top.column("hash").to_numpy().view(np.uint64), top.column("cnt").to_numpy()
    rank = np.arange(len(ranked))
    order = np.argsort(ranked)
    # Output 0 is the end; the words of highest rank follow.
    own = [int(h) for h in ranked[: OWN_OUTPUTS - 1].view(np.int64)]
    alone = F.col("hash").isin(own) if own else F.lit(False)
    mass = np.ones(ENDINGS)
    group = F.col("hash").bitwiseAND(ENDINGS - 1).alias("ending")
    for r in words.filter(~alone).groupBy(group).agg(F.sum(F.col("cnt") + 1).alias("mass")).collect():
        mass[r.ending] += r.mass
    whole = counted.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"), F.count("*").alias("v"),
        F.coalesce(F.sum(F.when(F.col("hash") == END, F.col("cnt"))), F.lit(0)).alias("ends"),
    ).first()
    share = np.ones(OUTPUTS)
    share[0] += whole.ends
    share[1 : 1 + len(own)] += cnt[: len(own)]
    share[OWN_OUTPUTS:] = mass
    return Lexicon(
        ranked[order], cnt[order], np.where(rank < OWN_INPUTS, rank, -1)[order],
        np.where(rank < OWN_OUTPUTS - 1, rank + 1, -1)[order], whole.n, whole.v, mass, share / share.sum(),
    )


def begin(lexicon: Lexicon, seed: int = 5) -> Weights:
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return {
        "input": small(START + 1, WIDTH),
        "place": np.full((CONTEXT, WIDTH), 0.6, np.float32) * np.float32(0.7) ** np.arange(CONTEXT, dtype=np.float32)[:, None],
        "output": small(OUTPUTS, WIDTH),
        "bias": np.log(lexicon.noise).astype(np.float32),
    }


def examples(into: np.ndarray, out: np.ndarray, offsets: np.ndarray, reach: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of ``reach`` tokens (nearest first) and outputs of all tokens with ends, and the rows' offsets among these."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(into)) + row  # a row's words, one further per end before them
    targets = np.zeros(len(into) + n, np.int64)
    targets[at] = out
    inputs = np.full(len(targets), START, np.int64)
    inputs[at] = into
    place = np.arange(len(targets)) - np.repeat(begins, sizes + 1)
    context = np.full((len(targets), reach), START, np.int64)
    for k in range(reach):
        have = np.flatnonzero(place > k)
        context[have, k] = inputs[have - k - 1]
    return context, targets, np.concatenate([[0], ends])


def predicted(w: Weights, context: np.ndarray) -> np.ndarray:
    return sum(w["input"][context[:, k]] * w["place"][k] for k in range(context.shape[1]))


def add_rows(table: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to the row of the table that its index names; an index may repeat."""
    index = index.astype(np.uint16)  # tables are small; a radix sort then applies
    order = np.argsort(index, kind="stable")
    sorted_index = index[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_index[1:] != sorted_index[:-1]]))
    table[sorted_index[first]] += np.add.reduceat(rows[order], first, axis=0)


def train_batch(w: Weights, grad: Weights, context: np.ndarray, target: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> None:
    """One step of noise contrast: each target against the batch's noise outputs."""
    n, k = len(target), len(noise)
    vectors = [w["input"][context[:, j]] for j in range(CONTEXT)]
    q = sum(v * w["place"][j] for j, v in enumerate(vectors))
    own = w["output"][target]
    shift = w["bias"] - log_noise - w["bias"].dtype.type(math.log(k))
    seen = np.einsum("ij,ij->i", q, own) + shift[target]
    fake = q @ w["output"][noise].T
    fake += shift[noise]
    up = 1 / (1 + np.exp(np.clip(seen, -30, 30)))  # gradient of log sigmoid(seen)
    np.clip(fake, -30, 30, out=fake)
    np.negative(fake, out=fake)
    np.exp(fake, out=fake)
    fake += 1
    down = np.divide(-1, fake, out=fake)  # of log sigmoid(-fake)
    dq = up[:, None] * own
    dq += down @ w["output"][noise]
    step = {name: np.zeros_like(x) for name, x in w.items()}
    add_rows(step["output"], np.concatenate([target, noise]), np.concatenate([up[:, None] * q, down.T @ q]))
    step["bias"] += np.bincount(target, up, len(step["bias"])) + np.bincount(noise, down.sum(0), len(step["bias"]))
    for j, v in enumerate(vectors):
        step["place"][j] = np.einsum("ij,ij->j", dq, v)
    add_rows(step["input"], context.T.ravel(), np.concatenate([dq * w["place"][j] for j in range(CONTEXT)]))
    for name, g in step.items():
        g /= n
        grad[name] += g * g
        w[name] += RATE * g / np.sqrt(grad[name] + g.dtype.type(1e-8))


def train(texts: DataFrame, known: Lexicon) -> Weights:
    """Average of the weights that the tasks reach on their texts."""
    shared = texts.sparkSession.sparkContext.broadcast(known)
    first = begin(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        w = {k: v.copy() for k, v in first.items()}
        grad = {k: np.full_like(v, 1e-3) for k, v in w.items()}
        rng = np.random.default_rng(11)
        log_noise = np.log(lex.noise).astype(np.float32)
        total = 0
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, offsets = tokens(batch.column("text"))
                _, into, out = lex.numbers(hashes)
                context, target, _ = examples(into, out, offsets, CONTEXT)
                order = rng.permutation(len(target))
                for lo in range(0, len(order), BATCH):
                    own = order[lo : lo + BATCH]
                    noise = rng.choice(OUTPUTS, NOISE, p=lex.noise)
                    train_batch(w, grad, context[own], target[own], noise, log_noise)
                total += len(target)
        if total:
            flat = np.concatenate([w[k].ravel() for k in sorted(w)]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat * total), pa.array(np.full(len(flat), total))],
                names=["at", "value", "weight"],
            )

    made = texts.select("text").mapInArrow(run, "at long, value double, weight long")
    mean = made.groupBy("at").agg((F.sum("value") / F.sum("weight")).alias("mean")).toArrow()  # one row a weight
    flat = np.concatenate([first[k].ravel() for k in sorted(first)])
    flat[mean.column("at").to_numpy()] = mean.column("mean").to_numpy()
    out, lo = {}, 0
    for name in sorted(first):
        size = first[name].size
        out[name] = flat[lo : lo + size].reshape(first[name].shape).astype(np.float32)
        lo += size
    return out


def log_probabilities(w: Weights, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log10 of the softmax over all outputs at the targets."""
    out = np.empty(len(target))
    # The bias is one more dimension; a batch and its scores stay within a core's cache.
    outputs = np.concatenate([w["output"], w["bias"][:, None]], axis=1).T.copy()
    for lo in range(0, len(target), SCORED_AT_ONCE):
        part = slice(lo, lo + SCORED_AT_ONCE)
        q = predicted(w, context[part])
        scores = np.concatenate([q, np.ones((len(q), 1), q.dtype)], axis=1) @ outputs
        scores -= scores.max(1)[:, None]
        own = scores[np.arange(len(scores)), target[part]]
        np.exp(scores, out=scores)
        out[part] = own - np.log(scores.sum(1))
    return out / math.log(10)


PARTS = "n_tokens long, n_known long, log_counts double, log_own double, log_model double, rare array<struct<hash: long, n: long>>"


def parts(docs: DataFrame, known: Lexicon, w: Weights, ends: int) -> DataFrame:
    """Per row what is known without the counts of rare words, and its rare words.

    ``log_counts`` and ``log_own`` sum log10(count + 1) of the frequent words, the second
    of those that have an output of their own; ``log_model`` is the score but for counts.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, w))
    names = [x.strip().split()[0] for x in PARTS.split(", rare")[0].split(",")] + ["rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, weights = shared.value
        log_mass = np.log10(lex.mass)
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, offsets = tokens(batch.column("text"))
                at, into, out = lex.numbers(hashes)
                context, target, bounds = examples(into, out, offsets, CONTEXT)
                model = log_probabilities(weights, context, target)
                grouped = target >= OWN_OUTPUTS
                model[grouped] -= log_mass[target[grouped] - OWN_OUTPUTS]
                sums = np.concatenate([[0], np.cumsum(model)])
                logs = np.where(at >= 0, np.log10(lex.cnt[at] + 1.0), 0.0) if len(lex.hashes) else np.zeros(len(at))
                all_logs = np.concatenate([[0], np.cumsum(logs)])
                own_logs = np.concatenate([[0], np.cumsum(np.where(out < OWN_OUTPUTS, logs, 0.0))])
                frequent = np.concatenate([[0], np.cumsum(at >= 0)])
                rare_hash, rare_n, cuts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
                for lo, hi in zip(offsets[:-1], offsets[1:]):
                    found, n = np.unique(hashes[lo:hi][at[lo:hi] < 0], return_counts=True)
                    rare_hash.append(found.view(np.int64))
                    rare_n.append(n)
                    cuts.append(cuts[-1] + len(found))
                rare = pa.ListArray.from_arrays(
                    pa.array(cuts, pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(np.concatenate(rare_hash)), pa.array(np.concatenate(rare_n))], names=["hash", "n"]
                    ),
                )
                lo, hi = offsets[:-1], offsets[1:]
                end_log = math.log10(ends + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("training"),
                        pa.array(hi - lo + 1), pa.array(frequent[hi] - frequent[lo] + int(ends > 0)),
                        pa.array(all_logs[hi] - all_logs[lo] + end_log), pa.array(own_logs[hi] - own_logs[lo] + end_log),
                        pa.array(sums[bounds[1:]] - sums[bounds[:-1]]), rare,
                    ],
                    names=["doc_id", "training", *names],
                )

    return docs.mapInArrow(run, "doc_id long, training boolean, " + PARTS)


def scores(docs: DataFrame) -> DataFrame:
    """Base and model scores of every row of ``docs`` (``doc_id``, ``text``)."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("training", in_training())
    texts = given.filter("training")
    counted = materialise(counts(texts), "token-counts")
    known = lexicon(counted)
    ends = counted.filter(F.col("hash") == END).agg(F.sum("cnt")).first()[0] or 0
    weights = train(texts, known)
    made = parts(given, known, weights, ends).withColumn("row", F.monotonically_increasing_id())
    held = materialise(made, "scored")  # freezes the row numbers

    rare = held.select("row", F.explode("rare").alias("r")).select("row", "r.hash", "r.n")
    found = rare.join(counted.select("hash", "cnt"), "hash", "left")
    cnt = F.coalesce("cnt", F.lit(0))
    more = found.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(cnt + 1)).alias("rare_logs"), F.sum(F.when(cnt > 0, F.col("n")).otherwise(0)).alias("rare_known")
    )
    joined = held.drop("rare").join(more, "row", "left")
    logs = F.col("log_counts") + F.coalesce("rare_logs", F.lit(0.0))
    total = math.log10(known.tokens + known.types + 1)
    return joined.select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("log_model") + logs - F.col("log_own")).alias("score"),
    )
