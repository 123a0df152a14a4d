import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import ngram
from corpuslens.schema import BOS, EOS
from corpuslens.sources import files


@pytest.fixture
def f2(docs):
    return docs([["a", "b"], ["a", "c"]])


def ppl(model, df):
    return {r.n: (r.events, r.perplexity) for r in ngram.perplexity(model, df).collect()}


def test_events(docs):
    got = ngram.events(docs([["a", "b"], []]), (2, 3), "doc_id").collect()
    assert {(r.doc_id, r.n, tuple(r.context), r.word) for r in got} == {
        (0, 2, ("<s>",), "a"), (0, 2, ("a",), "b"), (0, 2, ("b",), "</s>"), (1, 2, ("<s>",), "</s>"),
        (0, 3, ("<s>", "<s>"), "a"), (0, 3, ("<s>", "a"), "b"), (0, 3, ("a", "b"), "</s>"), (1, 3, ("<s>", "<s>"), "</s>"),
    }
    one = ngram.events(docs([["a", "b"]]), (1,)).collect()
    assert [(r.context, r.word) for r in one] == [([], "a"), ([], "b"), ([], "</s>")]


def test_probabilities(spark, f2):
    model = ngram.fit(f2, (2,))
    assert model.vocabulary.first().v == 4
    wanted = spark.createDataFrame(
        [(2, ["<s>"], "a"), (2, ["a"], "b"), (2, ["b"], "</s>"), (2, ["zz"], "a")], "n INT, context ARRAY<STRING>, word STRING"
    )
    got = {(r.context[0], r.word): r.p for r in ngram.probabilities(model, wanted).collect()}
    assert got == {("<s>", "a"): 1 / 2, ("a", "b"): 1 / 3, ("b", "</s>"): 2 / 5, ("zz", "a"): 1 / 4}
    plain = ngram.fit(f2, (2,), laplace=False)
    got = {(r.context[0], r.word): r.p for r in ngram.probabilities(plain, wanted).collect()}
    assert got == {("<s>", "a"): 1.0, ("a", "b"): 0.5, ("b", "</s>"): 1.0, ("zz", "a"): 0.0}


def test_probabilities_sum_to_one(f2):
    model = ngram.fit(f2, (2,))
    words = model.counts.select("word").distinct()
    every = model.totals.select("n", "context").join(words, F.lit(True))
    sums = ngram.probabilities(model, every).groupBy("context").agg(F.sum("p").alias("p")).collect()
    assert all(r.p == pytest.approx(1.0) for r in sums)


def test_perplexity_fixture(docs, f2):
    model, plain = ngram.fit(f2, (2,)), ngram.fit(f2, (2,), laplace=False)
    assert ppl(model, docs([["a", "b"]]))[2] == (3, pytest.approx(2.466212, abs=1e-6))
    assert ppl(plain, docs([["a", "b"]]))[2] == (3, pytest.approx(1.259921, abs=1e-6))
    assert ppl(plain, docs([["b"]]))[2] == (2, math.inf)
    assert ppl(model, docs([[]]))[2] == (1, pytest.approx(6.0))
    assert ppl(model, docs([["a"]]).filter("false"))[2] == (0, math.inf)


def brute_perplexity(train, test, n):
    grams, totals, vocab = defaultdict(Counter), Counter(), set()
    for doc in train:
        padded = [BOS] * (n - 1) + doc + [EOS]
        for i in range(len(padded) - n + 1):
            grams[tuple(padded[i:i + n - 1])][padded[i + n - 1]] += 1
            totals[tuple(padded[i:i + n - 1])] += 1
            vocab.add(padded[i + n - 1])
    logs = []
    for doc in test:
        padded = [BOS] * (n - 1) + doc + [EOS]
        for i in range(len(padded) - n + 1):
            c = tuple(padded[i:i + n - 1])
            logs.append(math.log((grams[c][padded[i + n - 1]] + 1) / (totals[c] + len(vocab))))
    return math.exp(-sum(logs) / len(logs))


def test_perplexity_against_brute_force(docs):
    rng = random.Random(5)
    train = [[rng.choice("aaaabcd") for _ in range(rng.randrange(9))] for _ in range(40)]
    test = [[rng.choice("aabcde") for _ in range(rng.randrange(9))] for _ in range(15)]
    got = ppl(ngram.fit(docs(train), (1, 2, 3)), docs(test))
    for n in (1, 2, 3):
        assert got[n][1] == pytest.approx(brute_perplexity(train, test, n))


def test_successors(docs):
    model = ngram.fit(docs([["a", "b"], ["a", "c"], ["a", "c"]]), (2,))
    got = ngram.successors(model, k=1).filter("context = array('a')").first()
    assert (got.word, got.cnt) == ("c", 2)
    assert ngram.successors(model).count() == model.counts.count()


def test_sharpened(docs):
    model = ngram.fit(docs([["a"], ["a"], ["a"], ["b"]]), (2,))
    got = {r.word: r.q for r in ngram.sharpened(model, 0.5).filter("context = array('<s>')").collect()}
    assert got == {"a": pytest.approx(16 / 20), "b": pytest.approx(4 / 20)}


@pytest.mark.parametrize("temperature", [1.0, 0.7])
def test_draw_table_covers_every_weight(docs, temperature):
    model = ngram.fit(docs([[w] for w in "aaaaaaabbbcccdefghijk"]), (2,))
    table = ngram.draw_table(model, 2, temperature)
    mass = {tuple(r.context): r.mass for r in table.contexts.collect()}
    ranges = defaultdict(set)
    for r in table.cells.collect():
        ranges[tuple(r.context)] |= {(s.lo, s.hi) for s in r.steps}
    for context, found in ranges.items():
        at = 0
        for lo, hi in sorted(found):
            assert lo == at and hi > lo
            at = hi
        assert at == mass[context]


def test_draws_follow_the_weights(spark, docs):
    model = ngram.fit(docs([["a"]] * 7 + [["b"]] * 2), (2,))  # weights 8 and 3
    states = spark.range(4_000).select(F.col("id").alias("sent_id"), F.lit(2).alias("n"), F.array(F.lit("<s>")).alias("context"))
    out = ngram.draw(ngram.draw_table(model, 2), states, (F.col("sent_id") + 0.5) / 4_000)
    assert out.count() == 4_000
    share = out.filter("word = 'a'").count() / 4_000
    assert share == pytest.approx(8 / 11, abs=0.001)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_generated_sentences_follow_seen_grams(spark, docs, n):
    rng = random.Random(n)
    train = [[rng.choice("abcdef") for _ in range(rng.randrange(1, 6))] for _ in range(30)]
    model = ngram.fit(docs(train), (n,))
    seeds = spark.range(60).withColumnRenamed("id", "sent_id")
    out = ngram.generate(model, seeds, n, max_length=8).collect()
    assert len(out) == 60 and len({r.sent_id for r in out}) == 60
    seen = set()
    for doc in train:
        padded = [BOS] * (n - 1) + doc + [EOS]
        seen |= {tuple(padded[i:i + n]) for i in range(len(padded) - n + 1)}
    for r in out:
        ended = [EOS] if len(r.words) < 8 else []
        padded = [BOS] * (n - 1) + list(r.words) + ended
        assert all(tuple(padded[i:i + n]) in seen for i in range(len(padded) - n + 1))
        assert r.sentence == " ".join(r.words)
    again = ngram.generate(model, seeds, n, max_length=8).collect()
    assert {(r.sent_id, r.sentence) for r in again} == {(r.sent_id, r.sentence) for r in out}


def test_model_round_trip(spark, f2, docs, tmp_path):
    model = ngram.fit(f2, (2, 3))
    files.save_ngram_model(model, str(tmp_path / "m"))
    back = files.load_ngram_model(spark, str(tmp_path / "m"))
    assert back.sizes == (2, 3)
    assert ppl(back, docs([["a", "b"]])) == ppl(model, docs([["a", "b"]]))


def test_unsmoothed_model_comes_back_unsmoothed(spark, f2, tmp_path):
    model = ngram.fit(f2, (2,), laplace=False)
    files.save_ngram_model(model, str(tmp_path / "m"))
    back = files.load_ngram_model(spark, str(tmp_path / "m"))
    assert back.laplace is False and back.sizes == (2,) and ppl(back, f2) == ppl(model, f2)


def test_tokens_with_blanks(spark, docs):
    """Two documents whose contexts read alike when written as text."""
    df = docs([["a b", "c", "x"], ["a", "b c", "y"]])
    model = ngram.fit(df, (3,))
    counted = {(tuple(r.context), r.word): r.cnt for r in model.counts.collect()}
    assert counted[("a b", "c"), "x"] == 1 and counted[("a", "b c"), "y"] == 1
    assert {tuple(r.context): r.total for r in model.totals.collect()}[("a b", "c")] == 1
    wanted = model.counts.select("n", "context", "word")
    assert {r.total for r in ngram.probabilities(model, wanted).collect()} == {1, 2}
    seeds = spark.range(50).withColumnRenamed("id", "sent_id")
    out = ngram.generate(model, seeds, 3).collect()
    assert len(out) == 50 and {tuple(r.words) for r in out} == {("a b", "c", "x"), ("a", "b c", "y")}


def test_sentences_from_a_start_token(spark, docs):
    model = ngram.fit(docs([["a", "b", "c"], ["b", "d"]]), (2,))
    seeds = spark.createDataFrame([(i, "b") for i in range(40)], "sent_id LONG, start STRING")
    out = ngram.generate(model, seeds, 2, max_length=6, start_col="start").collect()
    assert len(out) == 40 and {tuple(r.words) for r in out} == {("b", "c"), ("b", "d")}
    lost = spark.createDataFrame([(1, "b"), (2, "never seen")], "sent_id LONG, start STRING")
    with pytest.raises(ValueError, match="1 sentences"):
        ngram.generate(model, lost, 2, start_col="start")


def test_low_temperature_draws_follow_the_distribution(spark, docs):
    """Rare successors keep their tiny share instead of a floor."""
    model = ngram.fit(docs([["a"]] * 99 + [["b"]]), (2,), laplace=False)
    table = ngram.draw_table(model, 2, 0.1)
    entries = {s.word: s.hi - s.lo for r in table.cells.filter("context = array('<s>')").collect() for s in r.steps}
    q = {r.word: r.q for r in ngram.sharpened(model, 0.1).filter("context = array('<s>')").collect()}
    total = sum(entries.values())
    assert entries.get("b", 0) / total == pytest.approx(q["b"], abs=2**-52)


@pytest.mark.parametrize("laplace", [True, False])
def test_perplexity_of_counted_events(docs, laplace):
    df = docs([["a", "b", "a"], ["a", "c"], []])
    model = ngram.fit(df, (2, 3), laplace=laplace)
    given = {r.n: (r.events, r.perplexity) for r in ngram.perplexity(model, df, scored=model.counts).collect()}
    assert given == {n: (events, pytest.approx(value)) for n, (events, value) in ppl(model, df).items()}


def test_perplexity_without_word_arrays(spark, docs):
    """A NULL array is one event without a word, which no model gives a probability."""
    df = docs([["a"], ["b"]]).unionByName(spark.createDataFrame([(9, None, "positive")], "doc_id LONG, _words ARRAY<STRING>, sentiment STRING"))
    got = ppl(ngram.fit(df, (2,), laplace=False), df)
    assert got[2] == (5, math.inf)


def test_perplexity_meets_the_counts_in_one_exchange_without_sorts(docs):
    df = docs([["a", "b"]])
    model = ngram.fit(df, (2, 3), laplace=False)
    text = ngram.perplexity(model, df, scored=model.counts)._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan =="):]
    assert "Join" not in physical and "Sort" not in physical
    assert len([line for line in physical.splitlines() if "hashpartitioning(" in line and "context#" in line]) == 1


def sentences(model, seeds, sizes, **more):
    return {(r.n, r.sent_id, r.sentence) for r in ngram.generate(model, seeds, sizes, max_length=8, **more).collect()}


@pytest.mark.parametrize("temperature", [1.0, 0.8])
def test_sentences_are_the_same_however_contexts_are_cut_and_draws_are_dealt(spark, docs, monkeypatch, temperature):
    rng = random.Random(3)
    model = ngram.fit(docs([[rng.choice("abcdefghijklmn") for _ in range(rng.randrange(1, 9))] for _ in range(60)]), (2, 3))
    seeds = spark.range(80).withColumnRenamed("id", "sent_id")
    expected = sentences(model, seeds, (2, 3), temperature=temperature)
    assert len(expected) == 160
    monkeypatch.setattr(ngram, "SUCCESSORS_HELD", 4)
    table = ngram.draw_table(model, 2, temperature)
    assert table.parts.count() > 10
    for r in table.contexts.collect():
        steps = [s for c in table.cells.filter(F.col("context") == F.array(*map(F.lit, r.context))).collect() for s in c.steps]
        assert sum(s.hi - s.lo for s in steps) == r.mass == max(s.hi for s in steps)
    assert sentences(model, seeds, (2, 3), temperature=temperature) == expected
    monkeypatch.setattr(ngram, "DRAWS_BROADCAST", 0)
    assert sentences(model, seeds, (2, 3), temperature=temperature) == expected


def physical(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan =="):]


def test_a_draw_table_exchanges_the_counts_once_and_stays_where_it_is(spark, docs, monkeypatch):
    model = ngram.fit(docs([["a", "b", "c"], ["b", "d"]]), (2, 3))
    seen, write = [], ngram.materialise_bucketed
    monkeypatch.setattr(ngram, "materialise_bucketed", lambda df, *more: seen.append(physical(df)) or write(df, *more))
    table = ngram.draw_table(model, (2, 3))
    assert seen[0].count("hashpartitioning(") == 1
    states = ngram.materialise(spark.range(40).selectExpr("id AS sent_id", "2 AS n", "array('b') AS context"), "some-states")
    many = physical(ngram._step(table, states, F.lit(0.5), ngram.DRAWS_BROADCAST + 1))
    assert "ShuffledHashJoin" in many
    assert all("_place" in line for line in many.splitlines() if "hashpartitioning(" in line)


def test_keys_tell_contexts_apart(spark):
    contexts = [["a\x01b", "c"], ["a", "b\x01c"], ["\x02a", ""], ["\x01", ""], ["\x02n", "x"], [None, "x"], ["", "x"], ["\x02", "\x02b"], ["a b", "c"]]
    df = spark.createDataFrame([(3, c) for c in contexts], "n INT, context ARRAY<STRING>").withColumn("key", ngram._key(2))
    assert df.select("key").distinct().count() == len(contexts)
    assert df.filter(~F.col("context").eqNullSafe(ngram._context_of())).isEmpty()


def moved_by(df, column):
    text = df._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan =="):]
    return [line for line in physical.splitlines() if "Exchange" in line and f"{column}#" in line]


def test_counts_of_the_text_and_of_a_saved_model_stay_in_their_buckets(spark, docs, tmp_path):
    rng = random.Random(7)
    df = docs([[rng.choice("abcde") for _ in range(rng.randrange(9))] for _ in range(50)])
    for laplace in (True, False):
        model = ngram.fit(df, (2, 3), laplace=laplace)
        files.save_ngram_model(model, str(tmp_path / f"m{laplace}"))
        back = files.load_ngram_model(spark, str(tmp_path / f"m{laplace}"))
        want = {n: (events, pytest.approx(value)) for n, (events, value) in ppl(model, df).items()}
        for known, scored in ((model, model), (model, model.counts), (back, model), (back, back)):
            out = ngram.perplexity(known, df, scored=scored)
            if not laplace:  # what moves are the sums of the parts of short contexts
                assert not moved_by(out, "word") and len(moved_by(out, "context")) == 1
            assert {r.n: (r.events, r.perplexity) for r in out.collect()} == want
        for table, keys in (("counts", ["n", "context", "word"]), ("totals", ["n", "context"])):
            pairs = zip(*[getattr(m, table).orderBy(*keys).collect() for m in (model, back)], strict=True)
            assert all(a.asDict() == b.asDict() for a, b in pairs)
    long = ngram.fit(df, (3,), laplace=False)
    assert not moved_by(ngram.perplexity(long, df, scored=long.counts), "context")


def test_counts_are_those_of_any_words(spark, monkeypatch):
    """Words of control characters, empty ones and none at all, and contexts of many parts; a task combines equal events."""
    monkeypatch.setattr(ngram, "PARTS", 3)
    schema = ngram.pa.schema({"gram": ngram.pa.string()})
    batches = [ngram.pa.RecordBatch.from_pydict({"gram": grams}, schema) for grams in (["a", "b", "a"], [], ["a"])]
    combined = [dict(zip(*b.to_pydict().values(), strict=True)) for b in ngram._combined(iter(batches))]
    assert combined == [{"a": 3, "b": 1}] and list(ngram._combined(iter([]))) == []
    rng = random.Random(3)
    words = ["a", "\x01", "\x02", "\x02n", "a\x01b", "", "é", None]
    rows = [(i, [rng.choice(words) for _ in range(rng.randrange(7))]) for i in range(40)] + [(40, None), (41, [])]
    df = spark.createDataFrame(rows, "doc_id LONG, _words ARRAY<STRING>")
    model = ngram.fit(df, (1, 2, 3))

    def table(counts):
        return Counter({(r.n, tuple(r.context), r.word): r.cnt for r in counts.collect()})

    assert table(model.counts) == table(ngram.event_counts(df, (1, 2, 3)))
    per_context = Counter()
    for (n, context, _), cnt in table(model.counts).items():
        per_context[n, context] += cnt
    assert {(r.n, tuple(r.context)): r.total for r in model.totals.collect()} == per_context


def test_a_model_saved_without_buckets_is_read(spark, f2, tmp_path):
    model, path = ngram.fit(f2, (2,), laplace=False), str(tmp_path / "old")
    model.counts.write.partitionBy("n").parquet(f"{path}/counts")
    model.totals.write.partitionBy("n").parquet(f"{path}/totals")
    spark.createDataFrame([([2], False)], "sizes ARRAY<INT>, laplace BOOLEAN").write.parquet(f"{path}/settings")
    back = files.load_ngram_model(spark, path)
    assert back.dealt is None and ppl(back, f2) == ppl(model, f2)
    scored = {r.n: r.perplexity for r in ngram.perplexity(back, f2, scored=model).collect()}
    assert scored == {2: pytest.approx(ppl(model, f2)[2][1])}
    files.save_ngram_model(back, str(tmp_path / "new"))
    again = files.load_ngram_model(spark, str(tmp_path / "new"))
    assert again.dealt and ppl(again, f2) == ppl(model, f2)
    with pytest.raises(Exception, match="read"):
        files.save_ngram_model(again, str(tmp_path / "new"))
