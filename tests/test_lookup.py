"""Lookups with dominating keys, and arrays translated through dictionaries."""

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import lookup as lk


def test_lookup_of_hot_rare_missing_and_null_keys(spark):
    facts = [(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(900, None), (901, "none"), (902, "none")]
    facts = spark.createDataFrame(facts, "id LONG, k STRING")
    table = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 300, 6)]], "k STRING, v INT")
    plain = sorted(map(tuple, facts.join(table, "k", "left").select("id", "k", "v").collect()), key=repr)
    for counts in (None, facts.groupBy("k").agg(F.count("*").alias("cnt"))):
        for hot in (1, 5, 1000):
            got = lk.lookup(facts, table, ["k"], spread=lk.salt_of("id"), hot_rows=hot, counts=counts)
            assert sorted(map(tuple, got.collect()), key=repr) == plain


def test_facts_are_computed_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    facts = spark.range(50).mapInPandas(touch, "id LONG")
    table = spark.range(50).select("id", (F.col("id") * 2).alias("v"))
    assert lk.lookup(facts, table, ["id"], spread=lk.salt_of("id")).agg(F.sum("v")).first()[0] == 2450
    assert calls.value == 50


@pytest.mark.parametrize("chunk", [3, 1024])
def test_translate(spark, monkeypatch, chunk):
    monkeypatch.setattr(lk, "CHUNK", chunk)
    rows = [(1, ["a", "b", "a", None, "zz", "a"]), (2, []), (3, None), (4, ["b"] * 10), (5, [f"w{i % 7}" for i in range(50)])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id LONG, words ARRAY<STRING>, key STRING, value INT")
    names = {"a": 10, "b": 11, **{f"w{i}": i for i in range(6)}}
    table = spark.createDataFrame(list(names.items()), "key STRING, value INT")
    got = {r.doc_id: r.ids for r in lk.translate(df, table, array="words", out="ids", default=F.lit(1)).collect()}
    assert got == {i: [names.get(w, 1) for w in words or []] for i, words in rows}


def test_translate_shuffles_no_row_per_position(spark):
    df = spark.createDataFrame([(i, ["same"] * 1000) for i in range(20)], "doc_id LONG, words ARRAY<STRING>")
    table = spark.createDataFrame([("same", [1, 2])], "key STRING, value ARRAY<INT>")
    nothing = F.array().cast("array<int>")
    out = lk.translate(df, table, array="words", out="parts", default=nothing)
    assert all(r.parts == [[1, 2]] * 1000 for r in out.collect())
    text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "array_distinct" in text and "posexplode" not in text


def test_translate_searches_a_drawer_of_the_dictionary(spark):
    words = [f"w{i}" for i in range(900)]
    df = spark.createDataFrame([(1, words), (2, [None, "lost"])], "doc_id LONG, words ARRAY<STRING>")
    table = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "key STRING, value INT")
    out = lk.translate(df, table, array="words", out="ids", default=F.lit(-1))
    assert {r.doc_id: r.ids for r in out.collect()} == {1: list(range(900)), 2: [-1, -1]}
    text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "pmod(hash(" in text
