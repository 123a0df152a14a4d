import pytest

from corpuslens.operators.corpus import length_summary, tokenise
from corpuslens.schema import REVIEWS
from corpuslens.sources import files

TRICKY = [
    (1, 'She said "so, so"\nand left.\r\nEnd', "positive"),
    (2, "  outer blanks kept  ", "negative"),
    (3, "", "positive"),
    (4, None, None),
    (5, 'ends in a quote"', "negative"),
    (6, "back\\slash, comma", "positive"),
]


def test_review_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, REVIEWS).repartition(2)
    files.write_reviews(df, str(tmp_path / "r"))
    assert sorted(map(tuple, files.read_reviews(spark, str(tmp_path / "r")).collect())) == TRICKY


def test_plain_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text('review,sentiment\n"two\nlines, ""quoted""",positive\nplain,negative\n')
    got = files.read_csv(spark, str(tmp_path / "r.csv"), REVIEWS[1:]).collect()
    assert [tuple(r) for r in got] == [('two\nlines, "quoted"', "positive"), ("plain", "negative")]


@pytest.mark.parametrize("size", [40, 97, 1 << 20])
def test_one_file_read_in_splits(spark, tmp_path, size):
    """Cuts fall inside of quotes, of multi-line records, and between records."""
    rows = [(10 * k + i, None if text is None else text * (1 + k % 3), label) for k in range(40) for i, text, label in TRICKY]
    rows += [(9000, '"\n\n"\n' * 60, "negative"), (9001, "\n" * 90 + "x", "positive"), (9002, '""', None)]
    files.write_reviews(spark.createDataFrame(rows, REVIEWS).coalesce(1), str(tmp_path / "r"))
    files.write_reviews(spark.createDataFrame(rows[:7], REVIEWS).coalesce(1), str(tmp_path / "r"), mode="append")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        parts = spark.read.option("lineSep", "\n").text(str(tmp_path / "r")).rdd.getNumPartitions()
        got = files.read_reviews(spark, str(tmp_path / "r"), in_splits=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert parts > 20 or size > 1000
    assert sorted(map(tuple, got), key=repr) == sorted([*rows, *rows[:7]], key=repr)


@pytest.mark.parametrize("as_text", [True, False])
def test_processed_corpus_round_trip(spark, f1, tmp_path, as_text):
    df = tokenise(f1)
    files.save_corpus(df, str(tmp_path / "p"), words_as_text=as_text)
    back = files.load_corpus(spark, str(tmp_path / "p"))
    cols = ["doc_id", "review", "sentiment", "_char_len", "_word_count", "_words"]
    assert back.select(cols).orderBy("doc_id").collect() == df.select(cols).orderBy("doc_id").collect()
    with pytest.raises(ValueError):
        files.save_corpus(None, str(tmp_path / "q"))
    with pytest.raises(ValueError, match="_char_len"):
        files.save_corpus(f1, str(tmp_path / "q"))


def test_annotation_sheet(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, "a", "positive", "positive", None, None), (2, "b", "negative", "positive", None, None)],
        "doc_id LONG, review STRING, model_prediction STRING, gold_label STRING, human_rating STRING, llm_judge STRING",
    )
    files.write_annotation_sheet(frame, str(tmp_path / "s"))
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_annotation_sheet(frame, str(tmp_path / "s"))
    assert files.read_annotation_sheet(spark, str(tmp_path / "s")).filter("human_rating IS NOT NULL").isEmpty()
    rated = spark.createDataFrame([(1, " "), (2, "negative")], "doc_id LONG, human_rating STRING")
    files.write_annotation_sheet(frame.drop("human_rating").join(rated, "doc_id").select(frame.columns), str(tmp_path / "t"))
    merged = files.merge_ratings(frame, files.read_annotation_sheet(spark, str(tmp_path / "t")))
    assert {r.doc_id: r.human_rating for r in merged.collect()} == {1: None, 2: "negative"}


def test_length_summary(f1):
    got = length_summary(tokenise(f1)).first()
    assert (got.samples, got.max_len) == (5, 7) and got.avg_len == pytest.approx(14 / 5)
