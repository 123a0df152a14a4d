"""Merges one after the other against a learner that recounts everything after each."""

import random
from collections import Counter

import pytest

from corpuslens.operators import merges as m
from corpuslens.operators import subword, wordforms


def plain(words, size):
    words = {w: (list(w), n) for w, n in words.items()}
    out = []
    while len(out) < size:
        counts = Counter()
        for pieces, n in words.values():
            for pair in zip(pieces, pieces[1:]):
                counts[pair] += n
        if not counts:
            break
        (left, right), n = min(counts.items(), key=lambda x: (-x[1], x[0]))
        out.append((left, right, n))
        words = {w: (m._merged(p, left, right), k) for w, (p, k) in words.items()}
    return out, {w: p for w, (p, _) in words.items()}


def corpus(seed, words, letters="abcdeé"):
    rng = random.Random(seed)
    syllables = ["".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(12)]
    return {"".join(rng.choices(syllables, k=rng.randint(1, 5))): rng.choice([1, 1, 2, 3, 9, 40]) for _ in range(words)}


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "token STRING, cnt LONG").repartition(3)


@pytest.mark.parametrize("words_at_once, pairs_at_once", [(10**6, 5000), (60, 40), (25, 7), (0, 50)])
def test_same_list_as_a_plain_learner(spark, words_at_once, pairs_at_once):
    words = corpus(4, 90)
    size = 60 if words_at_once else 25
    got = m.learn_merges(frame(spark, words), size, words_at_once=words_at_once, pairs_at_once=pairs_at_once)
    want, spelt = plain(words, size)
    assert got == want
    assert {r.token: r.pieces for r in m.segment(frame(spark, words), got).collect()} == spelt


def test_rounds_over_many_random_words_without_spark():
    """The decisions of a round, with all pairs outside of the fetched words counted exactly."""
    for seed in range(40):
        words = corpus(seed, 120, "abc" if seed % 2 else "abcdefgh")
        want, _ = plain(words, 80)
        state, got = {w: (list(w), n) for w, n in words.items()}, []
        rng = random.Random(seed)
        while len(got) < 80:
            counts = Counter()
            for pieces, n in state.values():
                for pair in zip(pieces, pieces[1:]):
                    counts[pair] += n
            if not counts:
                break
            ranked = sorted((-n, *pair) for pair, n in counts.items())
            made, fetch = {a + b for a, b, _ in got}, rng.randint(0, 12)
            if fetch:
                known = {pair[1:] for pair in ranked[:fetch]}
                held = [x for x in state.values() if known & set(zip(x[0], x[0][1:]))]
                found = m._of_words(m.Fetched(held), known, ranked[fetch] if fetch < len(ranked) else None, made, 80 - len(got))
            else:
                found = m._of_counts(ranked, made, 80 - len(got))
            assert found
            got += found
            for left, right, _ in found:
                state = {w: (m._merged(p, left, right), n) for w, (p, n) in state.items()}
        assert got == want, seed


def test_thirty_thousand_merges_of_a_test_vocabulary(spark):
    """A vocabulary that allows them all: each merge is the best one of counts kept over all words."""
    rng = random.Random(11)
    words = {"".join(rng.choices("etaoinshrdlucmfw", k=rng.randint(3, 12))): rng.randint(1, 30) for _ in range(14_000)}
    got = m.learn_merges(frame(spark, words), 30_000)
    assert len(got) == 30_000
    head, _ = plain(words, 40)
    assert got[:40] == head
    assert [n for _, _, n in got] == sorted((n for _, _, n in got), reverse=True)
    state = m.Fetched([(list(w), n) for w, n in words.items()])
    for left, right, n in got:
        assert state.best() == (-n, left, right)
        state.merge(left, right)


def test_ids_of_documents(spark, docs):
    df = docs([["banana", "band"], ["ban", "x"], [], ["band", "q"]])
    counted = wordforms.distinct_words(df.filter("doc_id < 3"))
    merges = m.learn_merges(counted, 3)
    assert merges[0][:2] == ("a", "n")
    pieces = m.merge_pieces(counted, merges)
    ids = {r.piece: r.id for r in pieces.collect()}
    assert [ids[p] for p in ("a", "b", "d", "n", "x")] == [4, 5, 6, 7, 8] and ids["an"] == 9
    out = subword.encode(df, pieces, kind="bpe", merges=merges, max_length=None)
    _, spelt = plain({r.token: r.cnt for r in counted.collect()}, 3)
    got = {r.doc_id: r._input_ids for r in out.collect()}
    assert got[0] == [2, *[ids[p] for w in ("banana", "band") for p in spelt[w]], 3]
    assert got[2] == [2, 3] and got[3][-2] == 1


def test_no_words(spark):
    empty = spark.createDataFrame([], "token STRING, cnt LONG")
    assert m.learn_merges(empty, 5) == []
    one = spark.createDataFrame([("a", 3), ("", 1)], "token STRING, cnt LONG")
    assert m.learn_merges(one, 5) == []


def _cut(pieces, known):
    out, begin = [], 0
    for k in range(1, len(pieces) + 1):
        if k == len(pieces) or (pieces[k - 1], pieces[k]) not in known:
            out, begin = [*out, pieces[begin:k]], k
    return [p for p in out if len(p) > 1]


def test_rounds_over_segments_without_spark():
    """Segments know nothing of what merges create across a cut; what they decide is still exact."""
    longest = 0
    for seed in range(150):
        words = corpus(seed, 120, "abc" if seed % 2 else "abcdefgh")
        want, _ = plain(words, 80)
        state, got = {w: (list(w), n) for w, n in words.items()}, []
        rng = random.Random(seed)
        while len(got) < 80:
            counts = Counter()
            for pieces, n in state.values():
                for pair in zip(pieces, pieces[1:]):
                    counts[pair] += n
            if not counts:
                break
            ranked = sorted((-n, *pair) for pair, n in counts.items())
            fetch = rng.randint(1, 40)
            known, sums = {pair[1:] for pair in ranked[:fetch]}, Counter()
            for pieces, n in state.values():
                for part in _cut(pieces, known):
                    sums[tuple(part)] += n
            limit = ranked[fetch] if fetch < len(ranked) else None
            found = m._of_segments(m.Fetched(list(sums.items())), known, limit, {a + b for a, b, _ in got}, 80 - len(got))
            assert found
            longest = max(longest, len(found))
            got += found
            for left, right, _ in found:
                state = {w: (m._merged(p, left, right), n) for w, (p, n) in state.items()}
        assert got == want, seed
    assert longest > 5


def test_pairs_in_too_many_words_take_few_rounds(spark, monkeypatch):
    """The best pairs stand in more words than may be fetched; segments decide many merges a round."""
    words = corpus(8, 400, "abcdefgh")
    rounds, plainly = [], m.materialise
    monkeypatch.setattr(m, "materialise", lambda df, name: rounds.append(name) or plainly(df, name))
    got = m.learn_merges(frame(spark, words), 40, words_at_once=200)
    assert got == plain(words, 40)[0]
    assert len(rounds) <= 12
