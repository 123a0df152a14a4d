"""Training of unigram pieces against all covers of every word."""

import math
import random
from collections import Counter

import pytest

from corpuslens.operators import subword, unigram, wordforms


def covers(word, table, start=0):
    if start == len(word):
        yield []
    for end in range(start + 1, len(word) + 1):
        piece = word[start:end] if start == 0 else "##" + word[start:end]
        if piece in table:
            for rest in covers(word, table, end):
                yield [piece, *rest]


def brute(words, table):
    counts, likelihood = {}, 0.0
    for word, n in words.items():
        every = list(covers(word, table))
        weights = [math.exp(sum(table[p][1] for p in c)) for c in every]
        if not every or not word:
            continue
        likelihood += n * math.log(sum(weights))
        for cover, weight in zip(every, weights):
            for piece in cover:
                i = table[piece][0]
                counts[i] = counts.get(i, 0.0) + n * weight / sum(weights)
    return counts | {unigram.LIKELIHOOD: likelihood}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = [(i, ["".join(rng.choices(["ba", "na", "nd", "o", "ré", "th"], k=rng.randint(1, 5))) for _ in range(12)]) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id LONG, _words ARRAY<STRING>")


def test_expected_counts_against_all_covers(spark, corpus):
    words = wordforms.distinct_words(corpus)
    seeds = [r for r in subword.learn_pieces(corpus, size=40, max_piece=4).collect() if r.id > 3]
    total = sum(r.cnt for r in seeds)
    table = {r.piece: (r.id, math.log(r.cnt / total)) for r in seeds}
    got = {r.id: r.expected for r in unigram.expected_counts(words, table).collect()}
    want = brute({r.token: r.cnt for r in words.collect()}, table)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_long_words_and_words_without_cover(spark):
    words = spark.createDataFrame([("ab" * 5000, 2), ("xyz", 9), ("", 1), ("a", 1)], "token STRING, cnt LONG")
    table = {"a": (4, math.log(0.25)), "b": (5, math.log(0.25)), "##a": (6, math.log(0.25)), "##b": (7, math.log(0.25))}
    got = {r.id: r.expected for r in unigram.expected_counts(words, table).collect()}
    assert got[4] == pytest.approx(3) and got[6] == pytest.approx(2 * 4999) and got[7] == pytest.approx(10_000)
    assert got[unigram.LIKELIHOOD] == pytest.approx((20_000 + 1) * math.log(0.25))


def test_likelihood_never_falls_while_the_pieces_stay(spark, corpus):
    words = wordforms.distinct_words(corpus)
    seeds = subword.learn_pieces(corpus, size=60, max_piece=4)
    trained = unigram.train_unigram(words, seeds, 10_000, rounds=6)
    values = [v for _, v in trained.likelihoods]
    assert len(values) == 6 and values[-1] > values[0]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:]))


def test_pruned_to_size_and_used(spark, corpus):
    words = wordforms.distinct_words(corpus)
    seeds = subword.learn_pieces(corpus, size=60, max_piece=4)
    trained = unigram.train_unigram(words, seeds, 8)
    pieces = {r.piece: r.logp for r in trained.pieces.collect()}
    singles = {r.piece for r in seeds.collect() if r.id > 3 and len(r.piece.removeprefix("##")) == 1}
    assert singles <= set(pieces) and len(pieces) - len(singles) <= 8
    assert sum(math.exp(v) for v in pieces.values()) == pytest.approx(1, abs=1e-6)
    sizes = [n for n, _ in trained.likelihoods]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[-1]
    table = subword.unigram_table(words, trained.pieces).collect()
    assert table and all(1 not in r.pieces for r in table)


def test_empty(spark):
    none = spark.createDataFrame([], "token STRING, cnt LONG")
    seeds = spark.createDataFrame([("a", 4, 1)], "piece STRING, id INT, cnt LONG")
    assert unigram.train_unigram(none, seeds).pieces.count() == 1


def test_plain_probabilities_give_what_logarithms_give():
    pieces = {"a": (4, -2.0), "##a": (5, -1.5), "##b": (6, -2.5), "ab": (7, -3.0), "##ba": (8, -2.2), "b": (9, -math.inf), "##": (10, -4.0)}
    first, inner = unigram._split(pieces)
    for word in ("a", "ab", "abab", "aba", "abbaab"):
        whole, counts = unigram.word_expectation(word, pieces, 2)
        got = unigram._short_expectation(word, first, inner, 2)
        sums = Counter()
        for number, share in got[1]:
            sums[number] += share
        assert got[0] == pytest.approx(whole) and dict(sums) == pytest.approx(counts)
    for word in ("z", "az", "a" * 400):  # no cover, or too faint a one
        assert unigram._short_expectation(word, first, inner, 2) is None


def test_faint_words_are_counted_too(spark):
    words = spark.createDataFrame([("a" * 400, 2), ("a", 3), ("", 5), ("z", 7)], "token STRING, cnt BIGINT")
    got = {r.id: r.expected for r in unigram.expected_counts(words, {"a": (4, -2.0), "##a": (5, -1.5)}).collect()}
    assert got == pytest.approx({unigram.LIKELIHOOD: 2 * (-2 - 399 * 1.5) - 6, 4: 5, 5: 798})


def test_words_of_one_file_are_dealt_to_all_cores(spark, monkeypatch):
    seen, whole = [], unigram.expected_counts

    def counted(words, pieces):
        seen.append(words.rdd.getNumPartitions())
        return whole(words, pieces)

    monkeypatch.setattr(unigram, "expected_counts", counted)
    words = spark.createDataFrame([("ab", 3), ("a", 2)], "token STRING, cnt BIGINT").coalesce(1)
    seeds = spark.createDataFrame([("a", 4, 5), ("##b", 5, 3), ("ab", 6, 3)], "piece STRING, id INT, cnt BIGINT")
    unigram.train_unigram(words, seeds, 10)
    assert min(seen) >= spark.sparkContext.defaultParallelism
