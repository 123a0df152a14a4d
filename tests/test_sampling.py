import hashlib

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import sampling
from corpuslens.operators.lookup import lookup, salt_of
from corpuslens.operators.ordering import dense_rank_rows, seeded_rank
from corpuslens.session import materialise


def key(salt, i):
    return hashlib.md5(f"{salt}:{i}".encode()).hexdigest(), i


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(500).withColumnRenamed("id", "doc_id")


def test_sample_is_the_head_of_the_seeded_order(ids):
    got = {r.doc_id for r in sampling.sample_reviews(ids, 37).collect()}
    assert got == set(sorted(range(500), key=lambda i: key(42, i))[:37])
    assert sampling.sample_reviews(ids, 500).count() == 500
    assert sampling.sample_reviews(ids, 0).count() == 0


def test_split_sizes_and_order(ids):
    df = sampling.assign_split(ids, train=0.8, val=0.1, test=0.1).collect()
    order = sorted(range(500), key=lambda i: key(42, i))
    want = {i: "train" if r < 400 else "val" if r < 450 else "test" for r, i in enumerate(order)}
    assert {r.doc_id: r.split for r in df} == want


def test_split_truncates(spark):
    df = sampling.assign_split(spark.range(7).withColumnRenamed("id", "doc_id"))
    assert {r.split: r["count"] for r in df.groupBy("split").count().collect()} == {"train": 5, "test": 2}


def test_extreme_ratios(ids):
    assert {r.split for r in sampling.assign_split(ids, train=1.0, val=0.0, test=0.0).collect()} == {"train"}
    assert {r.split for r in sampling.assign_split(ids, train=0.0, val=0.0, test=1.0).collect()} == {"test"}
    with pytest.raises(ValueError, match="sum to 1"):
        sampling.assign_split(ids, train=0.5)
    with pytest.raises(ValueError, match="mode"):
        sampling.assign_split(ids, mode="random")


def test_empty_input(spark):
    empty = spark.range(0).withColumnRenamed("id", "doc_id")
    assert sampling.assign_split(empty).count() == 0
    assert sampling.sample_reviews(empty, 3).count() == 0


def test_selected_rows(ids):
    df = sampling.select_test(sampling.assign_split(ids), 20)
    chosen = df.filter("selected")
    assert chosen.count() == 20
    sampling.assert_subset(chosen, df.filter("split = 'test'"))
    with pytest.raises(AssertionError):
        sampling.assert_subset(chosen, df.filter("split = 'train'"))
    assert sampling.select_test(sampling.assign_split(ids), 100).filter("selected").count() == 50


def test_take_split_needs_keys(ids):
    with pytest.raises(ValueError, match="required"):
        sampling.take_split(ids, None)
    assert sampling.take_split(ids, ids.limit(5)).count() == 5


def test_hash_split_is_close(ids):
    counts = {r.split: r["count"] for r in sampling.assign_split(ids, mode="hash").groupBy("split").count().collect()}
    assert 350 < counts["train"] < 450 and sum(counts.values()) == 500


def test_epoch_order_is_a_permutation(ids):
    one = {r.doc_id: r.position for r in sampling.epoch_order(ids, 42, 0).collect()}
    two = {r.doc_id: r.position for r in sampling.epoch_order(ids, 42, 1).collect()}
    assert sorted(one.values()) == list(range(500)) and one != two


def test_dense_ranks(spark, ids):
    uneven = ids.withColumn("at", (F.col("doc_id") * F.col("doc_id") * F.col("doc_id")).cast("decimal(38,0)")).repartition(7)
    assert all(r.doc_id == r.rank for r in dense_rank_rows(uneven, "at").collect())
    order = sorted(range(500), key=lambda i: key("x", i))
    assert {r.doc_id: r.rank for r in seeded_rank(ids, "x").collect()} == {i: r for r, i in enumerate(order)}


@pytest.mark.parametrize("hot_rows", [1, 5, 1_000])
def test_lookup_is_the_left_join(spark, hot_rows):
    """Whatever part of the keys is broadcast, the rows are those of the plain left join."""
    facts = spark.range(3_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("token")
    )
    rows = [("hot", 7, 1_000)] + [(f"k{i}", i, 40) for i in range(45)]
    table = materialise(spark.createDataFrame(rows, "token STRING, id2 INT, cnt LONG"), "lookup-test")
    got = lookup(facts, table, ["token"], spread=salt_of("id"), hot_rows=hot_rows)
    want = facts.join(table, "token", "left")
    assert sorted(got.select("id", "token", "id2", "cnt").collect(), key=lambda r: r.id) == sorted(
        want.select("id", "token", "id2", "cnt").collect(), key=lambda r: r.id
    )


def test_lookup_spreads_heavy_keys(spark):
    """A missing word and a null hold a third of the rows each; no join key keeps more than its share."""
    token = F.when(F.col("id") % 3 == 0, "missing").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    facts = spark.range(3_000).select("id", token.alias("token"))
    table = materialise(spark.createDataFrame([(f"k{i}", i) for i in range(45)], "token STRING, id2 INT"), "lookup-test")
    got = lookup(facts, table, ["token"], spread=salt_of("id"), hot_rows=5)
    want = facts.join(table, "token", "left")
    assert sorted(map(tuple, got.select("id", "token", "id2").collect())) == sorted(map(tuple, want.select("id", "token", "id2").collect()))

    # the salted keys that reach the last join, read from its left side
    counts = facts.groupBy("token").count().orderBy(F.desc("count"), "token").limit(5)
    seen = [r.token for r in counts.collect()]
    assert "missing" in seen
    settled = F.col("token").isNull() | F.col("token").isin([t for t in seen if t])
    shares = facts.groupBy("token", F.when(settled, salt_of("id")).otherwise(0).alias("salt")).count()
    assert shares.agg(F.max("count")).first()[0] <= 3_000 // 3 // 10


def test_lookup_counts_nothing_while_planning(spark, monkeypatch):
    facts = spark.range(10).select("id", F.lit("a").alias("token"))
    table = spark.createDataFrame([("a", 1)], "token STRING, id2 INT")
    monkeypatch.setattr(type(facts), "count", None)
    monkeypatch.setattr(type(facts), "collect", None)
    lookup(facts, table, ["token"], spread=salt_of("id"))


def test_cuts_in_divided_buckets(spark, ids, monkeypatch):
    """Buckets above the limit are divided until one task can sort them."""
    from corpuslens.operators import ordering

    want = ordering.seeded_cuts(ids, "x", lambda n: {"a": n // 3, "b": n - 1, "past": n})
    monkeypatch.setattr(ordering, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(ordering, "BUCKET_ROWS", 4)
    assert ordering.seeded_cuts(ids, "x", lambda n: {"a": n // 3, "b": n - 1, "past": n}) == want and set(want) == {"a", "b"}
