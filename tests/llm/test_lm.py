import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from corpuslens.llm import lm
from corpuslens.llm.queries import QUERIES
from corpuslens.llm.words import hash_words, utf8

SCHEMA = "doc_id LONG, text STRING, training STRING, hash LONG"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + [None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check(rows, out):
    """Everything but the model's score, by plain counting; returns the scores."""
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        wanted.append((doc_id, held_out(doc_id), len(own), sum(counts[t] > 0 for t in own), n, base))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out]
    for a, b in zip(sorted(got, key=str), sorted(wanted, key=str), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5]))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 40)
    rows = [(i, f"the Cat sat on w{i % 13} mat\x0bthe dog é w{i}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, "the cat"), (103, "x" * 300_000), (104, "the " * 50_000), (5, rows[5][1]), (5, "other")]
    out = lm.scores(spark.createDataFrame([(i, t, "n", 0) for i, t in rows], SCHEMA)).collect()
    check(rows, out)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_nothing_to_learn_from(spark):
    unseen = [i for i in range(100) if held_out(i)][:3]
    rows = [(i, "a b") for i in unseen]
    out = lm.scores(spark.createDataFrame([(i, t, "n", 0) for i, t in rows], SCHEMA)).collect()
    check(rows, out)
    assert lm.scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_and_held_out_gain(spark):
    sf = "/root/testdata/sf0.01"  # some 300,000 tokens, enough for the network to learn from
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = QUERIES["op10_log_bilinear_scores"](spark, sf).collect()
    check(rows, out)
    unseen = [r for r in out if r.held_out]
    size = sum(r.n_tokens for r in unseen)
    assert sum(r.score for r in unseen) / size > sum(r.base_score for r in unseen) / size + 0.015


def test_probabilities_add_up_to_one(spark):
    rows = [(i, f"a b c{i % 5} d{i} tion{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    counted = lm.counts(df)
    known = lm.lexicon(counted)
    w = lm.begin(known)
    types = counted.filter("hash <> 0").collect()
    hashes = np.array([r.hash for r in types]).view(np.uint64)
    _, _, out = known.numbers(hashes)
    for context in ([3, 4], [lm.START] * 2):
        each = 10 ** lm.log_probabilities(w, np.array([context] * lm.OUTPUTS), np.arange(lm.OUTPUTS))
        assert abs(each.sum() - 1) < 1e-5
        inside = np.where(out < lm.OWN_OUTPUTS, 1.0, (np.array([r.cnt for r in types]) + 1) / known.mass[np.maximum(out - lm.OWN_OUTPUTS, 0)])
        own = {int(o) for o in out if o < lm.OWN_OUTPUTS} | {0}
        idle = sum(each[i] for i in range(lm.OWN_OUTPUTS) if i not in own)
        unknown = (each[lm.OWN_OUTPUTS :] / known.mass).sum()
        assert abs((each[out] * inside).sum() + unknown + idle + each[0] - 1) < 1e-5


def test_examples():
    _, offsets = hash_words(*utf8(pa.array(["a b", "", "c"])), lower=True)
    context, target, bounds = lm.examples(np.array([7, 8, 9]), np.array([1, 2, 3]), offsets)
    s = lm.START
    assert target.tolist() == [1, 2, 0, 0, 3, 0] and bounds.tolist() == [0, 3, 4, 6]
    assert context.tolist() == [[s, s], [7, s], [8, 7], [s, s], [s, s], [9, s]]


def test_gradient():
    rng = np.random.default_rng(0)
    known = lm.Lexicon(np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), 1, 1, np.ones(lm.ENDINGS), np.ones(lm.OUTPUTS) / lm.OUTPUTS)
    w = {k: v.astype(np.float64) for k, v in lm.begin(known).items()}
    context, target, noise = rng.integers(0, lm.START, (6, lm.CONTEXT)), rng.integers(0, 9, 6), rng.integers(0, 9, 5)
    log_noise = np.log(known.noise)

    def objective(w):
        q = lm.predicted(w, context)
        seen = (q * w["output"][target]).sum(1) + w["bias"][target] - log_noise[target] - math.log(5)
        fake = q @ w["output"][noise].T + w["bias"][noise] - log_noise[noise] - math.log(5)
        return (-np.log1p(np.exp(-seen)).sum() - np.log1p(np.exp(fake)).sum()) / 6

    grad = {k: np.zeros_like(v) for k, v in w.items()}
    lm.train_batch({k: v.copy() for k, v in w.items()}, grad, context, target, noise, log_noise)
    for name, where in (("bias", target[0]), ("output", (target[1], 3)), ("place", (1, 4)), ("input", (context[2, 0], 5))):
        up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
        up[name][where] += 1e-5
        down[name][where] -= 1e-5
        slope = (objective(up) - objective(down)) / 2e-5
        assert abs(slope**2 - grad[name][where]) < 1e-8


def test_find():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 1 << 63, 5_000).astype(np.uint64) << np.uint64(1))
    hashes = np.unique(np.concatenate([hashes, hashes[:50] + np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)]))
    rank = np.arange(len(hashes))
    known = lm.Lexicon(hashes, rank, rank, rank, 1, 1, np.ones(lm.ENDINGS), np.ones(lm.OUTPUTS))
    assert (known.find(hashes) == rank).all()
    other = np.setdiff1d(rng.integers(0, 1 << 63, 5_000).astype(np.uint64), hashes)
    assert (known.find(other) == -1).all()


def test_size_of_the_model(spark):
    """Training and scoring see contexts of three tokens, against 64 noise outputs, with 128 groups by ending."""
    known = lm.lexicon(lm.counts(spark.createDataFrame([(0, "a b c d")], "doc_id LONG, text STRING")))
    w = lm.begin(known)
    assert w["place"].shape == (3, lm.WIDTH) and len(w["output"]) == len(w["bias"]) == lm.OWN_OUTPUTS + 128 and lm.NOISE == 64
    context, _, _ = lm.examples(np.array([7, 8, 9]), np.array([1, 2, 3]), np.array([0, 3]), lm.CONTEXT)
    assert context[3].tolist() == [9, 8, 7]
    other = np.array([[9, 8, 6]])
    assert lm.log_probabilities(w, context[3:], np.array([1])) != lm.log_probabilities(w, other, np.array([1]))
