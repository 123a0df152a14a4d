import math
import re
from collections import Counter, defaultdict

import pytest

from corpuslens.llm import mixing
from corpuslens.llm.queries import QUERIES


def brute_targets(rows):
    """Sizes and targets by the contract's words: share by weight, stop at three times, share the excess anew."""
    sizes = [(s, len(re.findall("[^\x20\x09-\x0d]+", t or ""))) for _, t, s in rows]
    total = defaultdict(int)
    for s, n in sizes:
        total[s] += n
    names = sorted((s for s in total if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, sum(total.values()), set(names)
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole > 3 * total[s]}
        if not over:
            target |= {s: left * weight[s] / whole for s in open_}
            break
        target |= {s: 3 * total[s] for s in over}
        left -= sum(3 * total[s] for s in over)
        open_ -= over
    return sizes, total, target


def brute_dual(sizes, target):
    """The dual by bisection: words taken rise with it."""
    scale = sum(n * n for n in sizes) / sum(sizes)
    low, high = -1e4, 1e4
    for _ in range(300):
        mid = (low + high) / 2
        if sum(n * min(3.0, math.exp(min(50, mid * n / scale))) for n in sizes) < target:
            low = mid
        else:
            high = mid
    return low, scale


def check(rows, out):
    sizes, total, target = brute_targets(rows)
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    by_id = {r[0]: (n, s) for r, (s, n) in zip(rows, sizes)}
    taken, longest, ones = defaultdict(int), defaultdict(int), defaultdict(list)
    for r in out:
        n, s = by_id[r.doc_id]
        assert r.size == n and r.source_size == total[s] and math.isclose(r.target, target[s], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * n and (n == 0 or r.taken % n == 0)
        taken[s] += r.taken
        longest[s] = max(longest[s], n)
        ones[s].append((n, r.taken, r.rate))
    for s in total:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1
    return taken, target, ones


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_registered_query(spark, folder):
    where = f"/root/testdata/{folder}"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    out = QUERIES["op12_entropy_balanced_mix"](spark, where).collect()
    taken, target, ones = check(rows, out)
    for s, listed in ones.items():
        if not 0 < target[s] < 2.99 * sum(n for n, _, _ in listed):
            continue
        assert abs(taken[s] - target[s]) <= max(20, 0.01 * target[s])
        dual, scale = brute_dual([n for n, _, _ in listed], target[s])
        for n, _, rate in listed:
            assert n == 0 or math.isclose(rate, min(3.0, math.exp(dual * n / scale)), rel_tol=1e-5)


def test_edge_cases_and_rerun(spark):
    rows = [(i, "w " * (i % 40), "a" if i % 3 else "b") for i in range(400)]
    rows += [(1000, None, "c"), (1001, "", "c"), (1002, " \t\n", None), (1003, "x\x0by", None), (1004, "one " * 3000, "é")]
    rows += [(2000 + i, "same text here", "copies") for i in range(300)] + [(3000, "w", ""), (3001, "w w", "B")]
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], "doc_id LONG, text STRING, source STRING, size INT, kind STRING")
    first = mixing.mix(df.repartition(3)).withColumnRenamed("id", "doc_id").collect()
    again = mixing.mix(df.repartition(5)).withColumnRenamed("id", "doc_id").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    check(rows, first)


def test_buckets_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 16)
    rows = [(i // 2, "a b c", "s") for i in range(500)] + [(None, "a b c", "s")] * 40 + [(i, "d " * (i % 9 + 1), "t") for i in range(600, 700)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING").repartition(4)
    out = mixing.mix(df).collect()
    _, total, target = brute_targets(rows)
    for s, size in total.items():
        assert abs(sum(r.taken for r in out if r.source_size == size) - target[s]) <= 5
    assert all(r.taken <= 3 * r.size for r in out) and len(out) == len(rows)


def test_far_targets_are_reached(spark):
    """A short source under a heavy weight, a long one under a light one, and one very long document."""
    rows = [(i, "w " * (1 + i * 7 % 50), "a") for i in range(200)] + [(500 + i, "w " * (100 + i), "b") for i in range(100)]
    rows += [(900 + i, "w " * (10 + i), "c") for i in range(1500)] + [(5000, "w " * 20000, "c")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING").repartition(4)
    taken, target, _ = check(rows, mixing.mix(df).withColumnRenamed("id", "doc_id").collect())
    assert all(abs(taken[s] - target[s]) <= 20 for s in taken)


def test_no_words_and_empty_table(spark):
    schema = "doc_id LONG, text STRING, source STRING"
    out = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema)).collect()
    assert [(r.size, r.target, r.taken) for r in out] == [(0, 0.0, 0)] * 2
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    out = QUERIES["op12_entropy_balanced_mix"](spark, sf)
    text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)
