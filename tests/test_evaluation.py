import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuslens.functions import labels
from corpuslens.operators import agreement, classify, judge, metrics
from corpuslens.plans.evaluation import evaluate_classifier

P, N = "positive", "negative"
F4 = [
    (1, P, P, P, P), (2, P, N, N, ""), (3, N, N, P, N), (4, N, P, P, None), (5, P, P, " ", P), (6, N, N, N, N), (7, P, N, None, None),
]


@pytest.fixture(scope="module")
def f4(spark):
    return spark.createDataFrame(F4, "doc_id LONG, gold_label STRING, model_prediction STRING, llm_judge STRING, human_rating STRING").withColumn(
        "review", F.lit("x" * 120)
    )


@pytest.fixture(scope="module")
def coded(f4):
    return f4.select(
        "doc_id", "review",
        labels.encode_label(F.col("gold_label")).alias("label"), labels.encode_label(F.col("model_prediction")).alias("prediction"),
    )


def test_metrics(coded):
    row = metrics.evaluate(coded.withColumn("loss", F.lit(0.5))).first()
    assert row.samples == 7 and row.accuracy == pytest.approx(4 / 7) and row.f1 == pytest.approx(4 / 7)
    assert row.perplexity == pytest.approx(math.exp(0.5))
    cells = {(r.label, r.prediction): r.cnt for r in metrics.confusion(coded).collect()}
    assert cells == {(0, 0): 2, (0, 1): 1, (1, 0): 2, (1, 1): 2}


def test_f1_without_positives(spark):
    df = spark.createDataFrame([(0, 0)], "prediction INT, label INT")
    assert df.agg(metrics.binary_f1().alias("f")).first().f == 0.0
    assert {r.cnt for r in metrics.confusion(df).collect()} == {0, 1}


def test_agreement(f4):
    got = {r.pair: (r.agree, r.total) for r in agreement.pairwise_agreement(f4).collect()}
    assert got == {
        "model_gold": (4, 7), "llm_gold": (2, 7), "model_llm": (4, 7), "human_gold": (4, 7), "human_model": (4, 7), "human_llm": (2, 7),
    }
    rated = {r.pair: r.total for r in agreement.pairwise_agreement(f4, "rated").collect()}
    assert rated["human_gold"] == 4 and rated["llm_gold"] == 5 and rated["human_llm"] == 3
    with pytest.raises(ValueError, match="denominator"):
        agreement.pairwise_agreement(f4, "some")


def test_unrated_pairs_are_left_out(f4):
    silent = f4.withColumn("human_rating", F.lit(""))
    assert {r.pair for r in agreement.pairwise_agreement(silent).collect()} == {"model_gold", "llm_gold", "model_llm"}
    assert {r.rater: r.available for r in agreement.rating_availability(silent).collect()} == {"human_rating": False, "llm_judge": True}
    assert {r.pair for r in agreement.pairwise_agreement(f4.drop("llm_judge")).collect()} == {"model_gold", "human_gold", "human_model"}


def test_disagreements(f4):
    assert [r.doc_id for r in agreement.both_wrong(f4).orderBy("doc_id").collect()] == [2, 4, 7]
    assert [r.doc_id for r in agreement.agree_but_wrong(f4).orderBy("doc_id").collect()] == [2, 4]
    shown = agreement.examples(agreement.both_wrong(f4), 2).collect()
    assert [r.doc_id for r in shown] == [2, 4] and shown[0].preview == "x" * 100 + "..."


@pytest.mark.parametrize(
    "answer, label",
    [
        ("Positive.", P), ("not positive", P), ("NEGATIVE!", N), ("pos", P), ("unsure", N), ("", N), ("neg, then positive", P),
        (" Posh negative", N), (None, N),
    ],
)
def test_answers(spark, answer, label):
    df = spark.createDataFrame([(answer,)], "a STRING")
    assert df.select(labels.parse_answer(F.col("a"))).first()[0] == label


def test_response_log(spark):
    body = '{"choices":[{"message":{"content":"positive"}}]}'
    log = [
        (1, 1, 429, None), (1, 2, 200, body), (2, 1, 429, None), (2, 2, 429, None), (2, 3, 429, None), (3, 1, 500, None),
        (4, 1, 402, None), (5, 1, None, None), (6, 1, 429, None), (7, 1, 200, "not json"), (2, 4, 200, body),
    ]
    df = spark.createDataFrame(log, "doc_id LONG, attempt INT, status INT, body STRING")
    got = {r.doc_id: (r.llm_judge, r.defaulted, r.next_wait_s) for r in judge.resolve_responses(df).collect()}
    assert got == {
        1: (P, False, None), 2: (N, True, None), 3: (N, True, None), 4: (N, True, None), 5: (N, True, None), 6: (N, True, 5), 7: (N, True, None),
    }


def test_judge(spark, f4):
    with pytest.raises(ValueError, match="model_type"):
        judge.judge(f4, "oracle", judge_fn=len)
    with pytest.raises(ValueError, match="either"):
        judge.judge(f4)
    out = judge.judge(f4, judge_fn=lambda reviews: pd.Series([P] * len(reviews)))
    assert {r.llm_judge for r in out.collect()} == {P}
    verdicts = spark.createDataFrame([(1, N)], "doc_id LONG, llm_judge STRING")
    got = {r.doc_id: r.llm_judge for r in judge.judge(f4, "openrouter", judgments=verdicts).collect()}
    assert got[1] == N and got[2] is None and len(got) == 7


def test_prompts(f4):
    prompt = judge.prompts(f4).first().prompt
    assert "x" * 120 in prompt and "{review}" not in prompt


def test_evaluation_plan(spark, coded):
    scored = coded.withColumn("split", F.when(F.col("doc_id") < 5, "train").otherwise("test")).withColumn(
        "selected", F.col("doc_id") >= 5
    ).withColumn("loss", F.lit(0.0))
    human = spark.createDataFrame([(5, P), (6, P)], "doc_id LONG, human_rating STRING")
    out = evaluate_classifier(scored, human=human)
    assert {r.split for r in out.split_metrics.collect()} == {"train", "test"}
    assert out.split_confusion.count() == 8
    assert out.subsample_metrics.first().accuracy == pytest.approx(2 / 3)
    assert {r.pair: r.agree for r in out.agreement.collect()} == {"model_gold": 2, "human_gold": 1, "human_model": 1}
    assert out.frame.columns[:4] == ["doc_id", "review", "model_prediction", "gold_label"]


def test_classifier_learns(spark, tmp_path):
    from corpuslens.sources import files

    rows = [(i, ["good", "fun"] if i % 2 else ["bad", "dull"], P if i % 2 else N, "train" if i < 30 else "test") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id LONG, _words ARRAY<STRING>, sentiment STRING, split STRING")
    models, table = classify.compare_tokenisations(df.filter("split = 'train'"), df, {"word": "_words"}, features=256, iterations=5)
    assert all(r.accuracy == 1.0 and r.f1 == 1.0 and r.tokenizer == "word" for r in table.collect())
    files.save_classifier(models["word"], str(tmp_path / "c"))
    again = classify.predict(files.load_classifier(str(tmp_path / "c")), df)
    assert again.filter("prediction <> label").count() == 0
    assert set(again.columns) >= {"probabilities", "loss", "label", "prediction"}


def test_external_model(spark):
    def load():
        return lambda batch: [[0.2, 0.8] if "good" in t else [0.5, 0.5] for t in batch]

    df = spark.createDataFrame([(1, "good"), (2, "so so")], "doc_id LONG, review STRING")
    assert {r.doc_id: r.prediction for r in classify.score_external(df, load).collect()} == {1: 1, 2: 0}
