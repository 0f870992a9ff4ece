"""Samples that models are fitted on hold a bounded number of rows, also where an id is repeated."""

from tidemark.llm import html_text
from tidemark.llm.common import is_held_out, labelled_sample


def test_a_repeated_id_gives_one_row(spark):
    rows = [(i, f"text {i}") for i in range(40)]
    ids = spark.createDataFrame(rows, "doc_id long, text string")
    hot = ids.where(~is_held_out(ids["doc_id"])).first()["doc_id"]
    rows += [(hot, f"copy {k}") for k in range(300)]
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")

    def sample(part):
        docs = spark.createDataFrame(part, "doc_id long, text string").repartition(5)
        return sorted(map(tuple, labelled_sample(docs, labels, "quality", 1000).collect()))

    found = sample(rows)
    assert found == sample(rows[::-1])
    assert len(found) == len({i for i, _, _ in found}) > 20
    assert hot in {i for i, _, _ in found} and set(found) <= {(i, t, 1) for i, t in rows}


def test_a_repeated_page_id_gives_one_page(spark, monkeypatch, tmp_path):
    path = tmp_path / "seen"

    def train(pages):
        path.write_text(str(len(pages)))
        return html_text.Lstm.fresh()

    monkeypatch.setattr(html_text, "train", train)
    rows = [(i % 3, f"<p>page {i}</p>") for i in range(200)]
    html_text.fit(spark.createDataFrame(rows, "page_id long, html string"))
    assert path.read_text() == "3"
