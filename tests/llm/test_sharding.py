from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from corpuslens.llm import sharding


def dealt(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, shard STRING")
    return sharding.shuffle(sharding.document_items(df), "doc_id", "text_crc32", "size", **options).collect()


def test_exact_sizes_and_gapless_slots(spark):
    out = dealt(spark, [(i, "x" * (i % 7), "s") for i in range(1003)])
    sizes = Counter(r.shard for r in out)
    assert sorted(sizes.values()) == [125] * 5 + [126] * 3
    for shard in range(8):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sizes[shard]))
    assert sorted(r.doc_id for r in out) == list(range(1003))
    assert len({(r.shard, r.slot) for r in out}) == 1003


def test_null_empty_and_repeated_rows(spark):
    rows = [(None, None, "a"), (None, "", "a"), (5, "é퟿", "a"), (5, "é퟿", "b")] + [(7, "same", None)] * 30
    out = dealt(spark, rows)
    assert len(out) == 34
    assert Counter(r.shard for r in out) == Counter({s: 4 + (s < 2) for s in range(8)})
    assert {r.size for r in out if r.doc_id is None} == {1}
    assert {r.size for r in out if r.doc_id == 5} == {6}


def test_empty_table(spark):
    assert dealt(spark, []) == []


def test_hypergeometric_follows_the_distribution(spark):
    # 5 of 12 marked, 4 drawn: compare with the counts of all subsets.
    exact = Counter(sum(x < 5 for x in c) for c in combinations(range(12), 4))
    total = sum(exact.values())
    draw = sharding.hypergeometric(*[F.lit(x).cast("long") for x in (12, 5, 4)], (F.col("id") + 0.5) / 1000)
    got = {r.k: r.n for r in spark.range(1000).groupBy(draw.alias("k")).agg(F.count("*").alias("n")).collect()}
    assert set(got) == {k for k in exact if exact[k]}
    assert all(abs(got[k] / 1000 - exact[k] / total) < 0.002 for k in got)


def test_places_look_uniform(spark):
    # Mean place of a fixed row over many seeds, and no tie between order in and order out.
    places = []
    for seed in range(4):
        out = dealt(spark, [(i, "t", "s") for i in range(200)], seed=seed)
        places += [(r.doc_id, r.shard * 25 + r.slot) for r in out]
    low = [p for i, p in places if i < 100]
    assert abs(sum(low) / len(low) - 99.5) < 9
    assert len({p for i, p in places if i == 0}) > 2
