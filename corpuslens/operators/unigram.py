"""A unigram piece model trained on the distinct words of a corpus.

Pieces have probabilities, a cover of a word has the product of those of its pieces. Expectation
runs forward and backward over the lattice of every distinct word, in Arrow batches, and adds up
how often each piece is expected; maximisation takes the shares. Between rounds the pieces whose
loss would cost the corpus least are removed until the size asked for is reached: a piece's
loss is its expected count times what its best other cover has less in log probability.

The piece table is as large as asked for and is broadcast; the words stay distributed. A word
that no cover reaches takes no part. Single characters always stay.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.subword import INNER, SPECIAL_PIECES
from corpuslens.session import materialise

LIKELIHOOD = -1  # id of the row that holds the log likelihood of all words
LEAST = 1e-9  # share of a single character that training did not need
FAINT = 1e-100  # words less probable than this are added up in logarithms
TASKS_A_CORE = 2


def _plain(piece: str) -> str:
    return piece.removeprefix(INNER) if len(piece) > len(INNER) else piece


def _add_logs(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def spans(word: str, pieces: Mapping[str, tuple[int, float]], longest: int) -> list[tuple[int, int, int, float]]:
    """``(start, end, id, logp)`` of every piece in a word, by end and then by start."""
    out = []
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            found = pieces.get(word[start:end] if start == 0 else INNER + word[start:end])
            if found:
                out.append((start, end, *found))
    return out


def word_expectation(word: str, pieces: Mapping[str, tuple[int, float]], longest: int) -> tuple[float, dict[int, float]] | None:
    """Log probability of a word over all its covers, and how often a cover is expected to hold each piece."""
    found = spans(word, pieces, longest)
    ahead: list[list[float]] = [[] for _ in range(len(word) + 1)]
    forward = [-math.inf] * (len(word) + 1)
    forward[0] = 0.0
    for k, (start, end, _, logp) in enumerate(found):
        if forward[start] > -math.inf:
            ahead[end].append(forward[start] + logp)
        if k + 1 == len(found) or found[k + 1][1] != end:
            forward[end] = _add_logs(ahead[end]) if ahead[end] else -math.inf
    whole = forward[len(word)]
    if whole == -math.inf or not word:
        return None
    behind: list[list[float]] = [[] for _ in range(len(word) + 1)]
    backward = [-math.inf] * len(word) + [0.0]
    counts: dict[int, float] = defaultdict(float)
    by_start = sorted(found, reverse=True)
    for k, (start, end, piece, logp) in enumerate(by_start):
        if backward[end] > -math.inf:
            behind[start].append(backward[end] + logp)
            if forward[start] > -math.inf:
                counts[piece] += math.exp(forward[start] + logp + backward[end] - whole)
        if k + 1 == len(by_start) or by_start[k + 1][0] != start:
            backward[start] = _add_logs(behind[start]) if behind[start] else -math.inf
    return whole, counts


def _split(pieces: Mapping[str, tuple[int, float]]) -> tuple[dict[str, tuple[int, float]], dict[str, tuple[int, float]]]:
    """``{letters: (id, probability)}`` of the pieces that begin a word, and of those inside one."""
    first, inner = {}, {}
    for piece, (number, logp) in pieces.items():
        first[piece] = (number, math.exp(logp))
        if piece.startswith(INNER):
            inner[piece.removeprefix(INNER)] = (number, math.exp(logp))
    return first, inner


def _short_expectation(
    word: str, first: Mapping[str, tuple[int, float]], inner: Mapping[str, tuple[int, float]], longest: int
) -> tuple[float, list[tuple[int, float]]] | None:
    """``word_expectation`` in plain probabilities; None where these become too small to be exact."""
    size = len(word)
    forward = [1.0] + [0.0] * size
    found = []
    for end in range(1, size + 1):
        reached = 0.0
        for start in range(end - longest if end > longest else 0, end):
            piece = inner.get(word[start:end]) if start else first.get(word[:end])
            if piece:
                share = forward[start] * piece[1]
                reached += share
                found.append((start, end, piece[0], piece[1], share))
        forward[end] = reached
    whole = forward[size]
    if not whole > FAINT:
        return None
    backward = [0.0] * size + [1.0 / whole]
    counts = []
    for start, end, number, p, share in reversed(found):
        # by falling end: everything that leaves ``end`` has been added
        behind = backward[end]
        if behind and share:
            backward[start] += p * behind
            counts.append((number, share * behind))
    return math.log(whole), counts


def expected_counts(words: DataFrame, pieces: Mapping[str, tuple[int, float]]) -> DataFrame:
    """``(id, expected)`` over ``(token, cnt)``; the row ``LIKELIHOOD`` is the log likelihood."""
    longest = max((len(_plain(p)) for p in pieces), default=1)
    shared = words.sparkSession.sparkContext.broadcast((dict(pieces), *_split(pieces), longest))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, first, inner, longest = shared.value
        sums: dict[int, float] = defaultdict(float)  # as many as there are pieces
        for batch in batches:
            for word, cnt in zip(batch["token"], batch["cnt"]):
                found = _short_expectation(word, first, inner, longest)
                if found is None:
                    if (exact := word_expectation(word, table, longest)) is None:
                        continue
                    found = exact[0], exact[1].items()
                elif not word:
                    continue
                sums[LIKELIHOOD] += cnt * found[0]
                for piece, n in found[1]:
                    sums[piece] += cnt * n
        yield pd.DataFrame({"id": list(sums), "expected": list(sums.values())}, columns=["id", "expected"])

    partial = words.select("token", "cnt").mapInPandas(run, "id INT, expected DOUBLE")
    return partial.groupBy("id").agg(F.sum("expected").alias("expected"))


def _best_cover(word: str, first: bool, pieces: Mapping[str, tuple[int, float]], longest: int, without: int) -> float:
    """Log probability of the best cover of a piece's letters that does not use the piece."""
    best = [0.0] + [-math.inf] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            found = pieces.get(word[start:end] if first and start == 0 else INNER + word[start:end])
            if found and found[0] != without:
                best[end] = max(best[end], best[start] + found[1])
    return best[len(word)]


def _pruned(pieces: dict[str, tuple[int, float]], counts: Mapping[int, float], size: int, share: float) -> dict[str, tuple[int, float]]:
    """``pieces`` without the longer ones that are needed least, no more than ``1 - share`` of them at once."""
    longest = max(len(_plain(p)) for p in pieces)
    longer = {p: v for p, v in pieces.items() if len(_plain(p)) > 1}
    loss = {}
    for piece, (number, logp) in longer.items():
        other = _best_cover(_plain(piece), not piece.startswith(INNER) or piece == INNER, pieces, longest, number)
        loss[piece] = math.inf if other == -math.inf and counts.get(number) else counts.get(number, 0.0) * (logp - other)
    keep = max(size, math.ceil(share * len(longer)))
    kept = set(sorted(longer, key=lambda p: (-loss[p], p))[:keep])
    return {p: v for p, v in pieces.items() if p in kept or p not in longer}


@dataclass(frozen=True)
class Trained:
    """``pieces(piece, id, logp)`` and the log likelihood before each round, with the number of pieces then."""

    pieces: DataFrame
    likelihoods: list[tuple[int, float]]


def train_unigram(words: DataFrame, seeds: DataFrame, size: int = 30_000, *, rounds: int = 2, share: float = 0.75) -> Trained:
    """Fit the pieces ``seeds(piece, id, cnt)`` to the distinct words ``(token, cnt)``.

    ``rounds`` of expectation and maximisation alternate with pruning until at most ``size`` pieces
    of two and more characters are left; the seeds' counts give the first probabilities. The
    driver holds the piece table, which the number of seeds bounds.
    """
    # the words are few bytes but much work: dealt to all cores, whatever the size of their files
    parts = TASKS_A_CORE * words.sparkSession.sparkContext.defaultParallelism
    words = materialise(words.select("token", "cnt"), "unigram-words").repartition(parts, "token")
    given = seeds.filter(F.col("id") >= len(SPECIAL_PIECES)).select("piece", "id", "cnt").collect()
    total = sum(r.cnt for r in given) or 1
    table = {r.piece: (r.id, math.log(r.cnt / total)) for r in given if r.cnt > 0}
    singles = {p for p in table if len(_plain(p)) == 1}
    likelihoods: list[tuple[int, float]] = []
    while True:
        for _ in range(rounds):
            found = {r.id: r.expected for r in expected_counts(words, table).collect()}
            likelihoods.append((len(table), found.pop(LIKELIHOOD, 0.0)))
            mass = sum(found.values()) or 1.0
            # a character that no cover needs keeps a place without weight
            table = {
                p: (i, math.log(found[i] / mass) if found.get(i, 0.0) > 0 else -math.inf)
                for p, (i, _) in table.items() if found.get(i, 0.0) > 0 or p in singles
            }
        if len(table) - len(singles) <= size:
            break
        table = _pruned(table, found, size, share)
    least = math.log(LEAST)
    rows = [(p, i, max(logp, least) if p in singles else logp) for p, (i, logp) in table.items()]
    spark = words.sparkSession
    return Trained(materialise(spark.createDataFrame(rows, "piece STRING, id INT, logp DOUBLE"), "unigram-trained"), likelihoods)
