import pytest
from pyspark.sql import functions as F

from corpuslens.functions import labels, text
from corpuslens.functions.stem import porter
from corpuslens.operators import wordforms
from corpuslens.operators.corpus import load_corpus, tokenise


def column(spark, value, fn):
    return spark.createDataFrame([(value,)], "c STRING").select(fn(F.col("c")).alias("out")).first().out


def test_cleaning_fixture(f1):
    steps = text.remove_stop_words(text.expand_contractions(text.lowercase(text.remove_breaks(F.col("review")))), ["i", "the"])
    rows = f1.select("doc_id", steps.alias("p4")).withColumn("p5", text.strip_punctuation(F.col("p4"))).orderBy("doc_id").collect()
    assert [r.p4 for r in rows] == ["great film! cannot wait, end.", "bad<br>plot_line 42%", "", "ok ok", "the,"]
    assert [r.p5 for r in rows] == ["great film cannot wait end", "badbrplot_line 42", "", "ok ok", "the"]


def test_word_tokens(f1):
    rows = tokenise(f1, stop_words=["i", "the"]).orderBy("doc_id").collect()
    assert [r._words for r in rows] == [
        ["great", "film", "cannot", "wait", "end"], ["badbrplot_line", "42"], [], ["ok", "ok"], ["the"],
    ]
    assert [r._word_count for r in rows] == [5, 2, 0, 2, 1]
    assert rows[0]._char_len == len("great film cannot wait end")
    first = tokenise(f1, stop_words=["i", "the"], treebank=True).orderBy("doc_id").first()
    assert first._words == ["great", "film", "can", "not", "wait", "end"]


def test_word_punct_tokens(spark):
    assert column(spark, "don't déjà_vu, ok!", text.word_punct_tokens) == ["don", "'", "t", "déjà_vu", ",", "ok", "!"]


@pytest.mark.parametrize(
    "short, full",
    [
        ("won't", "will not"), ("can’t", "cannot"), ("couldn't've", "could not have"), ("they're", "they are"),
        ("i'll", "i will"), ("she'd", "she would"), ("i'm", "i am"), ("it's", "it is"), ("film's", "film's"),
        ("gonna", "going to"), ("plain text", "plain text"),
    ],
)
def test_contractions(spark, short, full):
    assert column(spark, short, text.expand_contractions) == full


def test_unicode_spaces_separate_words(spark):
    assert column(spark, "a b c\u000bd", lambda c: text.word_tokens(text.strip_punctuation(c))) == ["a", "b", "c", "d"]
    assert column(spark, "naïve Café-bar", text.strip_punctuation) == "naïve Cafébar"


def test_labels(spark):
    df = spark.createDataFrame([("negative",), ("positive",), ("mixed",), (None,)], "s STRING")
    codes = [r[0] for r in df.select(labels.encode_label(F.col("s"))).collect()]
    assert codes == [0, 1, None, None]
    back = spark.createDataFrame([(0,), (1,), (2,)], "k INT").select(labels.decode_label(F.col("k"))).collect()
    assert [r[0] for r in back] == ["negative", "positive", None]


def test_argmax_and_loss(spark):
    df = spark.createDataFrame([([0.5, 0.5], 1), ([0.1, 0.9], 1), ([1.0, 0.0], 1)], "p ARRAY<DOUBLE>, g INT")
    rows = df.select(labels.argmax(F.col("p")).alias("a"), labels.cross_entropy(F.col("p"), F.col("g")).alias("l")).collect()
    assert [r.a for r in rows] == [0, 1, 0]
    assert rows[1].l == pytest.approx(0.1053605)
    assert rows[2].l == float("inf")


def test_preview_and_nulls(spark):
    assert column(spark, "x" * 150, text.preview) == "x" * 100 + "..."
    df = spark.createDataFrame([(["a", None, "b"],)], "w ARRAY<STRING>")
    assert df.select(text.drop_nulls(F.col("w"))).first()[0] == ["a", "b"]


def test_tokenizer_names():
    for kind in ("unigram", "wordpiece"):
        with pytest.raises(ValueError, match="piece table"):
            text.tokenizer(kind)
    with pytest.raises(ValueError, match="unsupported"):
        text.tokenizer("char")


def test_sample_comes_before_the_text_work(f1):
    assert load_corpus(f1, sample_size=2).count() == 2
    assert load_corpus(f1, sample_size=50).count() == 5


# Published examples of the algorithm.
@pytest.mark.parametrize(
    "word, stem",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"),
        ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"),
        ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"), ("filing", "file"),
        ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"),
        ("digitizer", "digit"), ("vietnamization", "vietnam"), ("hopefulness", "hope"), ("formality", "formal"),
        ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"), ("revival", "reviv"),
        ("allowance", "allow"), ("adjustable", "adjust"), ("replacement", "replac"), ("adoption", "adopt"),
        ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"),
        ("generalizations", "gener"), ("oscillators", "oscil"), ("is", "is"),
    ],
)
def test_porter(word, stem):
    assert porter(word) == stem


def test_stem_and_lemma_rewrite(spark, docs):
    df = docs([["running", "ponies", "ran"], []])
    df = df.withColumn("review", F.array_join("_words", " ")).withColumn("_word_count", F.size("_words"))
    stemmed = wordforms.stem(df).orderBy("doc_id").collect()
    assert [r._words for r in stemmed] == [["run", "poni", "ran"], []]
    assert stemmed[0].review == "run poni ran" and stemmed[0]._char_len == 12
    lemmas = spark.createDataFrame([("ran", "run"), ("ponies", "pony")], "form STRING, lemma STRING")
    assert [r._words for r in wordforms.lemmatise(df, lemmas).orderBy("doc_id").collect()] == [["running", "pony", "run"], []]


def test_lemmas_by_rules(spark, docs):
    words = ["cats", "cat", "churches", "church", "ponies", "pony", "running", "run", "runn", "hoped", "hope", "hop", "bus", "women", "s",
             "taller", "tall", "was", "glasses", "glass", "class"]
    counted = spark.createDataFrame([(w, 1) for w in words], "token STRING, cnt LONG")
    nouns = {r.form: r.lemma for r in wordforms.lemmas_by_rules(counted).collect()}
    assert nouns == {"cats": "cat", "churches": "church", "ponies": "pony", "women": "woman", "glasses": "glass"}
    every = {r.form: r.lemma for r in wordforms.lemmas_by_rules(counted, ("noun", "verb", "adjective")).collect()}
    assert every == nouns | {"running": "runn", "hoped": "hop", "taller": "tall", "was": "be"}
    lexicon = spark.createDataFrame([("hope",), ("bu",)], "token STRING")
    some = {r.form: r.lemma for r in wordforms.lemmas_by_rules(counted, ("verb",), lexicon).collect()}
    assert some == {"hoped": "hope", "bus": "bu", "was": "be"}
    df = wordforms.lemmatise(docs([["cats", "cat", "was"], []]), parts=("noun",))
    assert [r._words for r in df.orderBy("doc_id").collect()] == [["cat", "cat", "was"], []]
