import random
import re

import numpy as np

from corpuslens.llm import jaccard
from corpuslens.llm.components import components
from corpuslens.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """Rows (doc_id, text) to (doc_id, n, component) by all pairs of distinct sets."""
    sets = [shingle_set(t) for _, t in rows]
    distinct = [s for s in set(sets) if s]
    root = {s: s for s in distinct}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= 75 * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for (k, _), s in zip(rows, sets):
        if s and k is not None:
            least[find(s)] = min(k, least.get(find(s), k))
    return sorted(((k, len(s), least.get(find(s)) if s else k) for (k, _), s in zip(rows, sets)), key=str)


def check(spark, rows):
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id LONG, text STRING, n INT, key STRING")
    assert sorted(map(tuple, jaccard.classes(df).collect()), key=str) == brute(rows)


def noisy(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def test_against_all_pairs(spark):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(rng.choice([6, 30, 120, 400]))]
        rows += [(0, noisy(rng, base, rng.randrange(1 + len(base) // 12))) for _ in range(rng.choice([1, 2, 9, 40]))]
    rows += [(0, " ".join(passage + [f"o{k}x{i}" for i in range(rng.randrange(5, 200))])) for k in range(60)]
    chain = [f"c{i}" for i in range(140)]
    rows += [(0, " ".join(chain[i : i + 100])) for i in range(0, 40, 2)]
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    rows += [(900 + i, t) for i, t in enumerate([None, "", " \n", "One two", "one TWO", "one two three four five", "ÉA b c d e", "éa b c d e"])]
    rows += [(950, rows[3][1]), (3, rows[3][1]), (None, rows[3][1]), (None, "only here without an id at all"), (960, "w " * 300_000), (961, "W " * 250_000)]
    check(spark, rows)


def test_large_group_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, noisy(rng, base, rng.randrange(3))) for i in range(300)]
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [])
    check(spark, [(1, None), (2, "")])


def test_query_against_sql(spark, sf):
    import duckdb

    from tests.compare import difference

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    name = "op8_ngram_jaccard_classes"
    assert difference(QUERIES[name](spark, sf), db.execute(SQL[name])) is None


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 900, rng.integers(1, 600)).astype(np.uint64))
        b = np.unique(rng.integers(0, 900, rng.integers(1, 600)).astype(np.uint64))
        x, y = (np.frombuffer(jaccard.bitmap_of(s), np.uint64) for s in (a, b))
        differ = int(np.bitwise_count(x ^ y).sum())
        assert jaccard.overlap(a, b) == len(np.intersect1d(a, b)) <= (len(a) + len(b) - differ) // 2


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 105), (105, 103), (200, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "a LONG, b LONG"), "a", "b").collect()}
    assert {out[i] for i in range(1, 61)} == {1} and {out[i] for i in (100, 103, 105)} == {100}


def test_one_of_each(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, noisy(rng, base, 1)) for i in range(20)] + [(50 + i, "copy of five words here") for i in range(5)]
    rows += [(7, rows[7][1]), (100, None), (101, ""), (100, None), (None, "copy of five words here"), (None, "an own text of a row without id"), (3, "alone under a used id of another")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id LONG, text STRING, n INT, root STRING")
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    left = [(0, rows[0][1]), (50, rows[20][1]), (100, None), (100, None), (101, ""), (None, "an own text of a row without id"), (3, "alone under a used id of another")]
    assert kept == sorted(left, key=str)
    again = jaccard.one_of_each(spark.createDataFrame([(1, "a b c d e f")] * 3, "doc_id LONG, text STRING"))
    assert [tuple(r) for r in again.collect()] == [(1, "a b c d e f")]
