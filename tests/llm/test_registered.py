"""Registered queries on the smallest tables, held against plain Python."""

import zlib
from collections import Counter, defaultdict

import pytest

from corpuslens.llm import decontamination as deco
from corpuslens.llm import licenses
from corpuslens.llm.queries import QUERIES
from tests.llm.test_decontamination import distance
from tests.llm.test_licenses import words


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_shards_are_even_and_gapless(spark, sf, texts):
    out = QUERIES["op3_hypergeometric_shards"](spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    sizes = Counter(r.shard for r in out)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))


def test_licenses_of_whole_texts(spark, sf, texts):
    found = defaultdict(set)
    for r in QUERIES["op5_license_windows"](spark, sf).collect():
        found[r.doc_id].add(r.license)
    want = defaultdict(set)
    listed = [(name, words(text)) for name, text in licenses.TEMPLATES]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    listed = [(name, grams(w), 1 << (len(w) - 1).bit_length()) for name, w in listed]
    for doc_id, text in texts.items():
        own = words(text)
        every = grams(own)
        for name, wanted, size in listed:
            if len(wanted & every) < 0.75 * len(wanted):
                continue
            if any(len(wanted & grams(own[lo : lo + 2 * size])) >= 0.75 * len(wanted) for lo in range(0, max(1, len(own)), size)):
                want[doc_id].add(name)
    assert want and found == want


def test_leaks_of_whole_texts(spark, sf, texts):
    items = {r.item_id: deco.folded(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    out = QUERIES["op6_pigeonhole_decontamination"](spark, sf).collect()
    pairs = {(r.doc_id, r.item_id): r for r in out}
    assert len(pairs) == len(out)
    folded = {doc_id: deco.folded(text or "") for doc_id, text in texts.items()}
    exact = {(d, i) for d, text in folded.items() for i, item in items.items() if item in text}
    assert exact and exact == {k for k, r in pairs.items() if r.distance == 0}
    for (doc_id, item_id), r in pairs.items():
        item = items[item_id]
        assert r.distance <= int(deco.RATE * len(item))
        assert distance(item, folded[doc_id][r.start : r.end]) == r.distance


def test_no_operator_reads_a_part_of_its_table(spark, sf, texts):
    for name in ("op1_weak_supervision_pii", "op7_cross_document_lines", "op8_ngram_jaccard_classes", "op10_log_bilinear_scores"):
        assert sorted(r.doc_id for r in QUERIES[name](spark, sf).select("doc_id").collect()) == sorted(texts), name
