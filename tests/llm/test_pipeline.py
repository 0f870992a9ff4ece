"""The pipeline's stages on a small table, against plain versions of what they decide."""

from conftest import AWKWARD
from test_text_dedup import kept_by_force, planted
from pyspark.sql import functions as F

import corpus_pipeline as p


def test_stages_in_order(spark, documents, tmp_path):
    rows = planted() + [(500 + i, "JUNK!! " * 40 + f"N{i}!!") for i in range(8)] + AWKWARD
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(not t or "JUNK" not in t), 0) for i, t in rows if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert [n for n, _ in p.STAGES][0] == "quality classifier" and len(p.STAGES) == 5
    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(p.STAGES):
        made = stage(spark, before, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert after.columns == docs.columns
            assert after.where("n_chars <> length(text)").count() == 0
        if k == 0:
            assert after.where(F.col("text").contains("JUNK!! JUNK!!")).count() == 0
            assert after.where(~F.coalesce("text", F.lit("")).contains("JUNK")).count() == (
                before.where(~F.coalesce("text", F.lit("")).contains("JUNK")).count())
        if k == 1:
            own = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = [(i, None if t is None else "\n".join(
                line for no, line in enumerate(t.split("\n"))
                if not line.strip() or no in kept)) for (i, t), kept in zip(
                    own, [kept_by_force(own)[j] for j in range(len(own))])]
            assert sorted(map(repr, want)) == sorted(
                repr((r["doc_id"], r["text"])) for r in after.collect())
        if k == 2:
            assert after.count() == after.select("text").distinct().count()
        if k == 3:
            assert after.count() == before.count()
        before = after
    ids = {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    assert {r["doc_id"] for r in before.collect()} == ids


def test_run(spark):
    out = p.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                           "offset"]
    assert out.count() > 0 and p.ORACLE_SQL is None


def test_run_removes_what_stages_leave(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("tidemark.llm.common.shared_dir", lambda _: str(tmp_path))
    out = p.run(spark, "/root/testdata/sf0.001")
    left = {x.name.rsplit("-", 1)[0] for x in tmp_path.iterdir()}
    assert "suffix-array-dedup" in left and "numbered" not in left
    assert not left & {name.replace(" ", "-") for name, _ in p.STAGES[:3]}
    assert out.count() > 0
