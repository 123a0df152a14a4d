"""How rows of a table are dealt to tasks."""

from corpuslens.sources import tables
from workload import queries


def test_tasks_grow_with_the_table(spark, tmp_path, monkeypatch):
    rows = [(k, f"text {k} " * 50, "en", "a", 9) for k in range(400)]
    spark.createDataFrame(rows, tables.SCHEMAS["documents"]).write.parquet(f"file://{tmp_path}/documents.parquet")
    labels = [(k, k % 2, 0) for k in range(400)]
    spark.createDataFrame(labels, tables.SCHEMAS["labels"]).write.parquet(f"file://{tmp_path}/labels.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert tables.parts_of(spark, f"file://{tmp_path}", "documents") == cores
    monkeypatch.setattr(tables, "PART_BYTES", 256)
    parts = tables.parts_of(spark, f"file://{tmp_path}/", "documents")
    assert parts > 3 * cores
    dealt = queries.reviews(spark, f"file://{tmp_path}")
    assert dealt.rdd.getNumPartitions() == parts and dealt.count() == 400
