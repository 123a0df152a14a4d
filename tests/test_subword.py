import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import subword, wordforms


@pytest.fixture
def pieces(spark):
    rows = [("[PAD]", 0, 0), ("[UNK]", 1, 0), ("[CLS]", 2, 0), ("[SEP]", 3, 0)]
    rows += [(p, 4 + i, c) for i, (p, c) in enumerate([("u", 5), ("un", 9), ("##a", 4), ("##aff", 2), ("##able", 7), ("##f", 3), ("##n", 2)])]
    return spark.createDataFrame(rows, "piece STRING, id INT, cnt LONG")


def ids(df):
    return {r.token: r.pieces for r in df.collect()}


def test_greedy_takes_the_longest_piece(spark, pieces):
    words = spark.createDataFrame([("unaffable", 1), ("unx", 1), ("u" * 101, 1), ("una", 1)], "token STRING, cnt LONG")
    name = {r.piece: r.id for r in pieces.collect()}
    got = ids(subword.greedy_table(words, pieces))
    assert got["unaffable"] == [name["un"], name["##aff"], name["##able"]]
    assert got["unx"] == [1]
    assert ids(subword.greedy_table(words, pieces, longest_word=5))["unaffable"] == [1]
    assert got["una"] == [name["un"], name["##a"]]


def test_unigram_is_the_best_cover(spark, pieces):
    table = subword.with_log_probability(pieces)
    logp = {r.piece: (r.id, r.logp) for r in table.collect()}
    words = ["unaffable", "una", "unn", "ux", "unaf", "u"]
    got = ids(subword.unigram_table(spark.createDataFrame([(w, 1) for w in words], "token STRING, cnt LONG"), table))
    for w in words:
        best = None
        for cuts in itertools.product([0, 1], repeat=len(w) - 1):
            parts, at = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(w[at:i])
                    at = i
            parts.append(w[at:])
            named = [p if i == 0 else "##" + p for i, p in enumerate(parts)]
            if all(p in logp for p in named):
                score = sum(logp[p][1] for p in named)
                if best is None or score > best[0] + 1e-12:
                    best = (score, [logp[p][0] for p in named])
        assert got[w] == (best[1] if best else [1]), w
    with pytest.raises(ValueError, match="piece table"):
        subword.unigram_table(None, None)


def test_encode_wraps_and_cuts(docs, pieces):
    df = docs([["una", "unx"], [], ["u"] * 20])
    got = {r.doc_id: (r._input_ids, r._attention_mask, r._word_count) for r in subword.encode(df, pieces, max_length=6).collect()}
    assert got[0][0] == [2, 5, 6, 1, 3] and got[0][1] == [1] * 5 and got[0][2] == 5
    assert got[1][0] == [2, 3]
    assert got[2][0] == [2, 4, 4, 4, 4, 3]
    with pytest.raises(ValueError, match="kind"):
        subword.encode(df, pieces, kind="bytes")


def test_learned_pieces_cover_the_corpus(docs):
    df = docs([["banana", "band"], ["ban", "x"]])
    learned = subword.learn_pieces(df, size=4, max_piece=3)
    name = {r.piece: r.cnt for r in learned.collect()}
    assert name["ba"] == 3 and name["ban"] == 3 and name["x"] == 1 and name["##a"] == 5
    table = ids(subword.greedy_table(wordforms.distinct_words(df), learned))
    assert all(1 not in p for p in table.values())
    assert learned.selectExpr("count(distinct id) = count(*)").first()[0]


def test_length_reports(spark):
    lengths = spark.createDataFrame([("t", n) for n in (1, 2, 3, 300)], "tokenizer STRING, length INT")
    cover = {r.threshold: r.percent for r in subword.length_coverage(lengths, (2, 300)).collect()}
    assert cover == {2: 50.0, 300: 100.0}
    d = subword.length_distribution(lengths).first()
    assert d.median == 2.5 and d.p95 == pytest.approx(3 + 0.85 * 297)
    assert subword.length_distribution(lengths, exact=False).first().median in (2.0, 3.0)
    assert math.isfinite(d.p99)


def test_merges(spark, docs):
    """Merges against a plain walk over the words."""
    df = docs([["banana", "bandana", "ban"], ["banana", "x", "aaaa"]])
    counted = wordforms.distinct_words(df)
    table, merges = subword.merge_table(counted, rounds=3, per_round=2)
    got = {r.token: r.pieces for r in table.collect()}

    def walk(word):
        symbols = list(word)
        for pairs in merges:
            done = symbols[:1]
            for s in symbols[1:]:
                if (done[-1], s) in pairs:
                    done[-1] += s
                else:
                    done.append(s)
            symbols = done
        return symbols

    assert got == {w: walk(w) for w in ("banana", "bandana", "ban", "x", "aaaa")}
    assert [len(p) for p in merges] == [2, 2, 2] and merges[0] == [("a", "n"), ("n", "a")]
    other = spark.createDataFrame([("nana", 1), ("b", 1)], "token STRING, cnt LONG")
    assert {r.token: r.pieces for r in subword.merged(other, merges).collect()} == {"nana": walk("nana"), "b": ["b"]}
    lengths = {r.doc_id: r.length for r in subword.lengths(df, table).collect()}
    assert lengths[1] == 2 + sum(len(walk(w)) for w in ("banana", "x", "aaaa"))


def test_documents_are_encoded_where_they_are(spark, pieces, monkeypatch):
    """As the tables by distinct word say, whatever words, arrays and ids a table holds; no row moves."""
    monkeypatch.setattr(subword, "ROWS_AT_ONCE", 3)
    monkeypatch.setattr(subword, "WORDS_HELD", 5)
    rng = random.Random(11)
    more = spark.createDataFrame(
        [("##a", 90, 6), ("é", 91, 3), ("##é", 92, 2), ("[P", 93, 4), (None, 94, 1), ("zz", None, 1)], "piece STRING, id INT, cnt LONG"
    )
    pieces = pieces.unionByName(more)
    known = ["", "u", "un", "una", "##a", "[PAD]", "zz", "é", "uéa", "\U0001f600", None]
    words = known + ["".join(rng.choice("unaffblé") for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    rows = [(i % 15 if i else None, [rng.choice(words) for _ in range(rng.randrange(12))], f"x{i}") for i in range(20)] + [(99, None, "none")]
    df = spark.createDataFrame(rows, "doc_id LONG, _words ARRAY<STRING>, other STRING").repartition(3)
    counted = spark.createDataFrame([(w, 1) for w in set(words) - {None}], "token STRING, cnt LONG")
    ordinary = pieces.filter("id > 3 AND piece IS NOT NULL")
    scored = subword.with_log_probability(ordinary)
    for kind, table, found in (
        ("wordpiece", pieces, subword.greedy_table(counted, pieces)), ("unigram", scored, subword.unigram_table(counted, scored))
    ):
        by_word = ids(found)
        out = subword.encode(df, table, kind=kind, max_length=None, keep=["other", "_words"])
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1 and "Join" not in text  # the one of df
        got = {r.other: r for r in out.collect()}
        assert len(got) == len(rows)
        for doc_id, given, other in rows:
            whole = [2, *itertools.chain.from_iterable(by_word[w] for w in given or [] if w is not None), 3]
            assert (got[other].doc_id, got[other]._words, got[other]._input_ids) == (doc_id, given, whole)
            assert got[other]._word_count == len(whole)
        cut = subword.encode(df, table, kind=kind, max_length=5, keep=[]).agg(F.max("_word_count")).first()[0]
        assert cut == 5
        one = df.filter("doc_id = 99 OR other IN ('x1', 'x2', 'x3')")  # looked up by distinct word, as without other columns
        looked = {r.doc_id: r._input_ids for r in subword.encode(one, table, kind=kind, max_length=None).collect()}
        assert looked == {r.doc_id: r._input_ids for r in got.values() if r.other in ("none", "x1", "x2", "x3")}
    with pytest.raises(ValueError, match="piece table"):
        subword.encode(df, None, kind="unigram", keep=[])
