from pyspark.sql import functions as F

from corpuslens.llm import jaccard, narrowing, pii


def test_no_key_is_missed_and_few_others_are_taken(spark):
    keys = spark.createDataFrame([(i * 7 - 700, f"t{i}") for i in range(300)] + [(None, "t"), (5, None)], "k LONG, t STRING")
    rows = spark.range(-2_000, 8_000).select(F.col("id").alias("a"), F.concat(F.lit("t"), ((F.col("id") + 700) / 7).cast("int")).alias("b"), F.lit("x").alias("more"))
    rows = rows.unionByName(spark.createDataFrame([(None, "t", "y"), (5, None, None), (None, None, "z")], "a LONG, b STRING, more STRING"))
    out, maybe = narrowing.parted(rows, [F.col("a"), F.col("b")], keys, ["k", "t"])
    assert out.columns == maybe.columns == rows.columns and out.count() + maybe.count() == rows.count()
    equal = lambda df: df.join(keys, df.a.eqNullSafe(keys.k) & df.b.eqNullSafe(keys.t), "left_semi").count()
    assert equal(out) == 0 and equal(maybe) == equal(rows) == 302
    assert maybe.count() < 302 + 0.1 * rows.count()


def test_no_keys(spark):
    keys = spark.createDataFrame([], "k LONG")
    out, maybe = narrowing.parted(spark.range(10), [F.col("id")], keys, ["k"])
    assert out.count() == 10 and maybe.count() == 0


def test_more_keys_than_places_spare_less(spark, monkeypatch):
    monkeypatch.setattr(narrowing, "MOST_BITS", 15)
    out, maybe = narrowing.parted(spark.range(200_000), [F.col("id")], spark.range(100_000), ["id"])
    assert maybe.filter("id < 100000").count() == 100_000 and out.count() + maybe.count() == 200_000


def watched(monkeypatch, module):
    seen = []

    def parted(*given):
        seen.append(narrowing.parted(*given))
        return seen[-1]

    monkeypatch.setattr(module, "parted", parted)
    return seen


def test_texts_without_spans_are_not_exchanged(spark, monkeypatch):
    seen = watched(monkeypatch, pii)
    rows = [(i, "mail a@b.org now" if i % 20 == 0 else f"{i} words of 2024 and no more", 9) for i in range(2_000)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_chars INT")
    out = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(df).collect()}
    assert out == {i: ("mail [EMAIL] now", 16) if i % 20 == 0 else (t, 9) for i, t, _ in rows}
    ((clean, moved),) = seen
    assert clean.count() > 1_700 and 100 <= moved.count() < 300


def test_single_texts_are_not_exchanged_and_a_set_is_made_once(spark, monkeypatch):
    seen = watched(monkeypatch, jaccard)
    group = [f"g{i}" for i in range(60)]
    near = [(i, " ".join([*group, f"n{i // 10}"])) for i in range(100)]  # ten texts, ten copies each
    rows = near + [(1_000 + i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(2_000)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    kept = sorted(r.doc_id for r in jaccard.one_of_each(df).collect())
    assert kept == [0, *range(1_000, 3_000)]
    *sets, (single, moved) = seen
    assert single.count() > 1_700 and moved.count() < 400
    for _, made in sets:  # a copy is not made again
        assert made.filter("doc_id < 1000").count() < 20
