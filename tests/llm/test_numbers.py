"""Row numbers stay the same when a later job splits the same files otherwise."""

import pytest

import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("number, column", [
    (queries.numbered, "row"), (corpus_pipeline._numbered, corpus_pipeline._ROW)])
def test_numbers_do_not_depend_on_splits(spark, tmp_path, number, column):
    path = str(tmp_path / "documents")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(4).write.parquet(path)
    docs = number(spark.read.parquet(path))
    found = []
    for most in ("128m", "64k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", "4m" if most == "128m" else "1k")
        try:
            rows = docs.select(column, "doc_id", "text").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len({r[column] for r in rows}) == len(rows)
        found.append(sorted(rows, key=lambda r: r[column]))
    assert found[0] == found[1]
