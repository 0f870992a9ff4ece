"""Quality and toxicity: held-out accuracy, and awkward rows."""

import zlib

import numpy as np
import pytest
from conftest import AWKWARD  # noqa: F401  (tests/llm/conftest.py)

from tidemark.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def labelled(column):
    import duckdb

    rows = duckdb.sql(
        f"SELECT d.doc_id, coalesce(text, ''), {column} FROM '{SF}/documents.parquet' d "
        f"JOIN '{SF}/labels.parquet' USING (doc_id)").fetchall()
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows]
    return ([r for r, h in zip(rows, held) if not h], [r for r, h in zip(rows, held) if h])


def test_quality_held_out():
    learn, check = labelled("quality")
    p = quality.score_texts(quality.train(learn), [r[1] for r in check])
    assert np.mean((p >= quality.THRESHOLD) == [r[2] for r in check]) > 0.95


def test_quality_is_the_same_in_any_order():
    learn, _ = labelled("quality")
    assert (quality.train(learn[:60]) == quality.train(learn[:60][::-1])).all()


@pytest.mark.parametrize("word, form", [
    ("then", "a"), ("Then,", "Aa,"), ("THEN!!", "A!"), ("a1b", "a0a"), ("x***", "a*"), ("", "")])
def test_word_form(word, form):
    assert quality.word_form(word) == form


def test_toxicity_finds_planted_words():
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("aeiou"), 1)) + "".join(rng.choice(list("bcdfglmnprst"), 3))
             for _ in range(300)]
    rows = []
    for i in range(1200):
        words = list(rng.choice(plain, 60))
        if bad := i % 4 == 0:
            for at in rng.integers(0, 60, 4):
                words[at] = ("vexilthrop", "quonkard", "zzyblat")[rng.integers(3)]
        rows.append((i, " ".join(words), int(bad)))
    model = toxicity.train(rows[:900])
    p = model.score([r[1] for r in rows[900:]])
    assert np.mean((p >= 0.5) == [r[2] for r in rows[900:]]) > 0.95


def test_toxicity_without_both_labels():
    assert toxicity.train([]).score(["a", None]).tolist() == [0, 0]
    assert toxicity.train([(1, "a", 1), (2, "b", 1)]).score(["a"]).tolist() == [1]


def test_windows_keep_every_word_whole():
    text = " ".join(f"word{i}" for i in range(400))
    seen = b"|".join(toxicity.windows(text)).decode()
    assert all(f" word{chr(97)}" or w in seen for w in toxicity.words_of(text).split())


def test_long_words_are_whole_in_a_window():
    rng = np.random.default_rng(6)
    for letters in ("abcdefgh", "абвгдежз", "あいうえお", "a"):
        words = ["".join(rng.choice(list(letters), n)) for n in rng.integers(1, 42, 600)]
        made = toxicity.windows(" ".join(words))
        assert all(any(w.encode() in one for one in made) for w in words)
        assert max(map(len, made)) <= toxicity.WINDOW
    long = "".join(rng.choice(list("abcdefgh"), 3000))
    made = toxicity.windows(f"one {long} two")
    assert all(any(long[i : i + 64].encode() in one for one in made) for i in range(2936))
    assert made[-1].endswith(b" two ") and toxicity.windows(None) == [b"  "]


def test_awkward_rows(spark, documents):
    docs = documents(AWKWARD)
    weights = np.zeros(1 << quality.BITS, np.float32)
    out = quality.score(docs, weights).collect()
    assert len(out) == len(AWKWARD) and {r["score"] for r in out} == {0.5}
    model = toxicity.Model(b" bad ", b" good ", np.array([1, 0, 0, 0, -1.0]))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(AWKWARD)
    by_text = {}
    for r in out:
        assert by_text.setdefault(r["text"], r["score"]) == r["score"]
    assert quality.score(docs.limit(0), weights).collect() == []
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, labels.limit(0)).any() == False  # noqa: E712
    assert quality.fit(docs, labels).shape == (1 << quality.BITS,)
    assert toxicity.fit(docs.limit(0), labels).score(["x"]).tolist() == [0]
