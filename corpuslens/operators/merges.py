"""Merges learned from the words of a corpus one after the other, and ids under them.

A word starts as its characters. Each merge joins the pair of neighbouring pieces that is most
frequent in the corpus at that moment (ties: the first pair by text), everywhere at once.

The words stay distributed with their present pieces. A round counts all pairs, an aggregation
that is combined before the shuffle, and decides as many merges as it can from one of these:

* the words of the most frequent pairs, as many pairs as ``WORDS_AT_ONCE`` words allow. Merges run
  on them one by one with incremental counts, exact as long as the best pair lies ahead of the
  first pair that was not fetched: every occurrence of a fetched pair, and of a pair that a merge
  creates, is in the fetched words;
* segments, where pairs are in too many words: all words are cut between two pieces that are no
  fetched pair, and equal segments are added up, so that thousands of pairs take few rows. A pair
  that a merge creates across a cut is not seen; it stems from a pair that was not fetched, so it is
  no more frequent than that one, times the number of such pairs it can stem from. The round ends
  before such a pair could be the best;
* the counts alone, if even these are too many: the best pairs up to the first whose count could
  have been changed by those before it.

Any way the list is that of a learner that recounts everything after each merge. The driver
holds the merges and the words or segments of one round.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.ordering import dense_rank_rows
from corpuslens.operators.subword import SPECIAL_PIECES
from corpuslens.session import materialise

WORDS_AT_ONCE = 100_000  # or segments
PAIRS_AT_ONCE = 5_000
FIRST_CUTS = 512  # pairs between which the first round does not cut
WORD_PAIRS_WORTH = 4  # a pair fetched with whole words decides about as many merges as this many with segments
SEGMENTS_HELD = 200_000  # of one task

Merge = tuple[str, str, int]  # left, right, occurrences when it was made


def _pairs(pieces: Sequence[str]) -> Iterator[tuple[str, str]]:
    return zip(pieces, pieces[1:])


def _merged(pieces: list[str], left: str, right: str) -> list[str]:
    out, i = [], 0
    while i < len(pieces):
        if pieces[i] == left and i + 1 < len(pieces) and pieces[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(pieces[i])
            i += 1
    return out


class Fetched:
    """Words of a round with an index from pairs to words; counts follow every merge."""

    def __init__(self, words: Sequence[tuple[list[str], int]]):
        self.words = [(list(pieces), cnt) for pieces, cnt in words]
        self.counts: Counter[tuple[str, str]] = Counter()
        self.where: dict[tuple[str, str], set[int]] = defaultdict(set)
        for number in range(len(self.words)):
            self._add(number, 1)
        self.queue = [(-n, *pair) for pair, n in self.counts.items()]
        heapq.heapify(self.queue)

        self.beside: dict[str, set[tuple[str, str]]] = defaultdict(set)
        for pair in self.counts:
            self._list(pair)
        self.watched: dict[tuple[str, str], int] = {}
        self.risks: list[tuple[int, str, str]] = []

    def _list(self, pair: tuple[str, str]) -> None:
        for piece in pair:
            self.beside[piece].add(pair)

    def _add(self, number: int, sign: int) -> set[tuple[str, str]]:
        pieces, cnt = self.words[number]
        seen = set()
        for pair in _pairs(pieces):
            self.counts[pair] += sign * cnt
            seen.add(pair)
        for pair in seen:
            (self.where[pair].add if sign > 0 else self.where[pair].discard)(number)
        return seen

    def best(self) -> tuple[int, str, str] | None:
        """``(-count, left, right)`` of the most frequent pair."""
        while self.queue:
            minus, left, right = self.queue[0]
            if minus and self.counts[left, right] == -minus:
                return self.queue[0]
            heapq.heappop(self.queue)
        return None

    def risk(self, pair: tuple[str, str], unseen: int) -> None:
        """Watch a pair that may occur up to ``unseen`` times more than is counted."""
        if unseen:
            self.watched[pair] = unseen
            heapq.heappush(self.risks, (-self.counts[pair] - unseen, *pair))
        else:
            self.watched.pop(pair, None)

    def riskiest(self) -> int:
        """What the most frequent watched pair may count."""
        while self.risks:
            minus, left, right = self.risks[0]
            pair = (left, right)
            if pair in self.watched and self.counts.get(pair) and self.counts[pair] + self.watched[pair] == -minus:
                return -minus
            heapq.heappop(self.risks)
        return 0

    def merge(self, left: str, right: str) -> set[tuple[str, str]]:
        """Merge a pair everywhere; returns the pairs whose counts changed and that still occur."""
        changed = set()
        for number in list(self.where[left, right]):
            pieces, cnt = self.words[number]
            changed |= self._add(number, -1)
            self.words[number] = (_merged(pieces, left, right), cnt)
            changed |= self._add(number, 1)
        for pair in changed:
            if self.counts[pair]:
                heapq.heappush(self.queue, (-self.counts[pair], *pair))
                self._list(pair)
            else:
                del self.counts[pair], self.where[pair]
                for piece in pair:
                    self.beside[piece].discard(pair)
        return {pair for pair in changed if pair in self.counts}


def _of_words(fetched: Fetched, known: set[tuple[str, str]], limit: tuple[int, str, str] | None, made: set[str], most: int) -> list[Merge]:
    """Merges that the fetched words decide.

    ``known`` are the fetched pairs, ``limit`` is the first pair that was not fetched, ``made``
    what earlier rounds have made. A pair beside a piece that is made again may also stand
    in words that were not fetched, as often as the limit's count at most; the round ends
    before such a pair could be the best.
    """
    out: list[Merge] = []
    again: set[str] = set()
    done: set[tuple[str, str]] = set()

    def watch(pairs: Iterable[tuple[str, str]]) -> None:
        for pair in pairs:
            if pair not in known and not again.isdisjoint(pair):
                fetched.risk(pair, -limit[0])

    while len(out) < most and (best := fetched.best()) is not None:
        minus, left, right = best
        if limit is not None and (best >= limit or (again and -minus <= fetched.riskiest())):
            break
        if (left, right) in done:
            break
        done.add((left, right))
        changed = fetched.merge(left, right)
        out.append((left, right, -minus))
        if limit is not None:
            if left + right in made and left + right not in again:
                again.add(left + right)
                watch(fetched.beside[left + right])
            if again:
                watch(changed)
    return out


def _of_segments(fetched: Fetched, known: set[tuple[str, str]], limit: tuple[int, str, str] | None, made: set[str], most: int) -> list[Merge]:
    """Merges that segments decide, the best pair at least.

    ``lasts`` and ``firsts`` tell which pieces of the round's beginning a piece may end and begin
    with: a pair occurs across a cut only where two of them are no fetched pair, ``limit`` times
    for each such two at most. A merge is sure if its pair is never cut and is more frequent than
    any pair could be with what is not seen.
    """
    out: list[Merge] = []
    lasts: dict[str, set[str]] = {}
    firsts: dict[str, set[str]] = {}
    several = [1, 1]  # the most lasts and firsts of a piece
    done: set[tuple[str, str]] = set()

    def unseen(pair: tuple[str, str]) -> int:
        if limit is None:
            return 0
        ends, begins = lasts.get(pair[0], {pair[0]}), firsts.get(pair[1], {pair[1]})
        return -limit[0] * sum((q, r) not in known for q in ends for r in begins)

    while len(out) < most and (best := fetched.best()) is not None:
        minus, left, right = best
        if out and limit is not None:
            if -minus <= max(-limit[0] * several[0] * several[1], fetched.riskiest()) or unseen((left, right)):
                break
        if (left, right) in done:
            break
        done.add((left, right))
        changed = fetched.merge(left, right)
        out.append((left, right, -minus))
        piece = left + right
        own = {piece} if piece in made else set()
        lasts[piece] = lasts.get(piece, own) | lasts.get(right, {right})
        firsts[piece] = firsts.get(piece, own) | firsts.get(left, {left})
        several = [max(several[0], len(lasts[piece])), max(several[1], len(firsts[piece]))]
        for pair in changed | fetched.beside[piece]:
            fetched.risk(pair, unseen(pair))
    return out


def _of_counts(ranked: Sequence[tuple[int, str, str]], made: set[str], most: int) -> list[Merge]:
    """Merges that the counts alone decide, the best one at least.

    A merge changes the counts of pairs that overlap it and creates pairs no more frequent than
    these, so pairs above the first overlapping count are untouched.
    """
    out: list[Merge] = []
    lefts, rights, overlapping = set(), set(), None
    for minus, left, right in ranked:
        if right in lefts or left in rights or left == right:
            overlapping = -minus
            break
        lefts.add(left)
        rights.add(right)
    for k, (minus, left, right) in enumerate(ranked[:most]):
        if k and overlapping is not None and -minus <= overlapping:
            break
        out.append((left, right, -minus))
        if left == right or left + right in made:
            break
    return out


def spell(word: Sequence[str], ranks: dict[tuple[str, str], list[int]]) -> list[str]:
    """Pieces after all merges, each applied once in the order of its rank, from the left."""
    pieces: list[str | None] = list(word)
    after = list(range(1, len(pieces) + 1))
    before = list(range(-1, len(pieces) - 1))

    def offer(i: int, above: int) -> None:
        if i >= 0 and after[i] < len(pieces):
            found = ranks.get((pieces[i], pieces[after[i]]))
            if found and (k := bisect_right(found, above)) < len(found):
                heapq.heappush(queue, (found[k], i, pieces[i], pieces[after[i]]))

    queue: list[tuple[int, int, str, str]] = []
    for i in range(len(pieces) - 1):
        offer(i, -1)
    while queue:
        rank, i, left, right = heapq.heappop(queue)
        j = after[i]
        if pieces[i] != left or j >= len(pieces) or pieces[j] != right:
            continue
        pieces[i], pieces[j] = left + right, None
        after[i] = after[j]
        if after[j] < len(pieces):
            before[after[j]] = i
        offer(before[i], rank)
        offer(i, rank)
    return [p for p in pieces if p is not None]


def _spelt(words: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """``(token, pieces, cnt)`` with further merges applied to ``pieces``."""
    ranks: dict[tuple[str, str], list[int]] = defaultdict(list)
    for rank, (left, right, _) in enumerate(merges):
        ranks[left, right].append(rank)
    shared = words.sparkSession.sparkContext.broadcast(dict(ranks))  # as many as merges were asked for

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(pieces=[spell(p, shared.value) for p in batch["pieces"]])

    return words.select("token", "pieces", "cnt").mapInPandas(run, "token STRING, pieces ARRAY<STRING>, cnt BIGINT")


def _characters(words: DataFrame) -> DataFrame:
    return words.select("token", F.split("token", "").alias("pieces"), F.col("cnt").cast("bigint").alias("cnt"))


def _segments(state: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(pieces, cnt)``: the longest runs of pieces whose neighbours all are among ``pairs``, equal ones added up."""
    shared = state.sparkSession.sparkContext.broadcast(frozenset(pairs))  # PAIRS_AT_ONCE at most

    def rows(sums: Counter[tuple[str, ...]]) -> pd.DataFrame:
        return pd.DataFrame({"pieces": [list(p) for p in sums], "cnt": list(sums.values())}, columns=["pieces", "cnt"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, sums = shared.value, Counter()
        for batch in batches:
            for pieces, cnt in zip(batch["pieces"], batch["cnt"]):
                pieces, begin = list(pieces), 0
                for k in range(1, len(pieces) + 1):
                    if k == len(pieces) or (pieces[k - 1], pieces[k]) not in known:
                        if k - begin > 1:
                            sums[tuple(pieces[begin:k])] += cnt
                        begin = k
            if len(sums) > SEGMENTS_HELD:
                yield rows(sums)
                sums = Counter()
        yield rows(sums)

    cut = state.select("pieces", "cnt").mapInPandas(run, "pieces ARRAY<STRING>, cnt BIGINT")
    return cut.groupBy("pieces").agg(F.sum("cnt").alias("cnt"))


def learn_merges(
    words: DataFrame, size: int = 30_000, *, words_at_once: int = WORDS_AT_ONCE, pairs_at_once: int = PAIRS_AT_ONCE
) -> list[Merge]:
    """Up to ``size`` merges ``(left, right, cnt)`` of the distinct words ``(token, cnt)``, in order."""
    state = materialise(_characters(words.filter("token <> ''")), "spelt-words")
    merges: list[Merge] = []
    cuts = min(FIRST_CUTS, pairs_at_once)
    while len(merges) < size:
        neighbours = F.arrays_zip(
            F.slice("pieces", 1, F.size("pieces") - 1).alias("a"), F.slice("pieces", 2, F.size("pieces") - 1).alias("b")
        )
        many = state.filter(F.size("pieces") > 1)
        each = many.select("token", "cnt", F.explode(neighbours).alias("p")).select("token", "cnt", "p.a", "p.b")
        # a pair is in as many words as it has places at most
        counted = each.groupBy("a", "b").agg(F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("words"))
        rows = counted.orderBy(F.desc("cnt"), "a", "b").limit(pairs_at_once + 1).collect()
        if not rows:
            break
        ranked = [(-r.cnt, r.a, r.b) for r in rows]
        fetch, held = 0, 0
        while fetch < min(len(rows), pairs_at_once) and held + rows[fetch].words <= words_at_once:
            held += rows[fetch].words
            fetch += 1
        made, left = {left + right for left, right, _ in merges}, size - len(merges)
        found: list[Merge] = []
        if fetch and (fetch * WORD_PAIRS_WORTH >= min(cuts, len(rows)) or fetch >= left):
            wanted = [(a, b) for _, a, b in ranked[:fetch]]
            chosen = F.broadcast(words.sparkSession.createDataFrame(wanted, "a STRING, b STRING"))
            holding = each.join(chosen, ["a", "b"], "left_semi").select("token").distinct()
            fetched = Fetched([(r.pieces, r.cnt) for r in state.join(holding, "token", "left_semi").collect()])
            limit = ranked[fetch] if fetch < len(ranked) else None
            found = _of_words(fetched, set(wanted), limit, made, left)
        elif words_at_once:
            while not found and cuts:
                chosen = [(a, b) for _, a, b in ranked[: min(cuts, pairs_at_once)]]
                cut = _segments(state, chosen).limit(words_at_once + 1).collect()
                if len(cut) <= words_at_once:
                    limit = ranked[len(chosen)] if len(chosen) < len(ranked) else None
                    found = _of_segments(Fetched([(r.pieces, r.cnt) for r in cut]), set(chosen), limit, made, left)
                    if len(cut) * 4 <= words_at_once:
                        cuts = min(cuts * 2, pairs_at_once)
                else:
                    cuts //= 2
            cuts = max(cuts, 1)
        if not found:
            found = _of_counts(ranked, made, left)
        merges += found
        state = materialise(_spelt(state, found), "spelt-words")
    return merges


def segment(words: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """``(token, pieces, cnt)`` of any words under merges learned before."""
    return _spelt(_characters(words), merges)


def merge_pieces(words: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """``(piece, id)``: special pieces, the characters of the words by code point, then what the merges make, in order."""
    characters = words.select(F.explode_outer(F.split("token", "")).alias("piece")).filter("piece <> ''").distinct()
    ranked = dense_rank_rows(characters, "piece").select("piece", (F.col("rank") + len(SPECIAL_PIECES)).cast("int").alias("id"))
    ranked = materialise(ranked, "merge-characters")
    spark, first = words.sparkSession, len(SPECIAL_PIECES) + ranked.count()
    made = list(dict.fromkeys(left + right for left, right, _ in merges))
    listed = [*SPECIAL_PIECES.items(), *((piece, first + k) for k, piece in enumerate(made))]
    return materialise(spark.createDataFrame(listed, "piece STRING, id INT").unionByName(ranked), "merge-pieces")


def merge_table(words: DataFrame, merges: Sequence[Merge], pieces: DataFrame) -> DataFrame:
    """``(token, pieces, cnt)`` with the ids of a word's pieces; characters that training has not seen are unknown."""
    spelt = materialise(segment(words, merges), "merge-segments")
    each = spelt.select("token", F.posexplode("pieces").alias("at", "piece"))
    # the piece table is as large as the vocabulary asked for: Catalyst broadcasts it by its size
    found = each.join(pieces.select("piece", "id"), "piece", "left")
    entry = F.struct("at", F.coalesce("id", F.lit(SPECIAL_PIECES["[UNK]"])).alias("id"))
    ids = found.groupBy("token").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    ids = ids.select("token", F.transform("entries", lambda e: e["id"]).alias("pieces"))
    return spelt.select("token", "cnt").join(ids, "token").select("token", "pieces", "cnt")
