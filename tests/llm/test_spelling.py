"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from conftest import AWKWARD

from tidemark.llm import spelling


def plain_words(rows):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_force(rows):
    n = plain_words(rows)
    form, count = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        count[w] = len(others)
        form[w] = best if others and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def edited(word, rng):
    at = rng.randrange(len(word))
    letter = rng.choice("abcdeéÀÿz")
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :],
                       word[:at] + letter + word[at + 1 :]])


def corpus(seed=1):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeé", k=rng.randint(7, 12))) for _ in range(12)]
    base += ["abcdefgh", "hgfedcba", "a" * 9, "a" * 10, "÷×àßÿÞ÷×", "e" * 700 + "a"]
    words = []
    for k, word in enumerate(base):
        words += [word] * rng.choice([2, 25, 400])
        for _ in range(12):
            other = edited(word, rng)
            words += [other] * rng.choice([1, 2, 3, 30])
            words += [edited(other, rng)] * rng.choice([1, 2])
    rng.shuffle(words)
    rows = [(i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w
                         for w in words[i::40])) for i in range(40)]
    return rows + [(100 + (i or 0), t) for i, t in AWKWARD] + rows[:2] + [(None, rows[3][1])]


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def found(docs):
    return sorted((tuple(r[c] for c in COLUMNS) for r in spelling.variants(docs).collect()),
                  key=repr)


def test_variants(documents):
    rows = corpus()
    want = by_force(rows)
    assert sum(f is not None for _, f, *_ in want) > 20
    assert any(root != form for _, form, root, *_ in want if form)
    assert found(documents(rows)) == want


def test_variants_over_many_cells_and_parts(documents, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 4)
    monkeypatch.setattr(spelling, "LEAST_SAMPLE", 2)
    monkeypatch.setattr(spelling, "SAMPLE", 150)
    monkeypatch.setattr(spelling, "_HELD", 50)
    made = spelling.Cells.made

    def split(sample, total):
        cells = made(sample, total)
        cells.parts = {k: [3] * len(v) for k, v in cells.parts.items()}
        assert any(len(v) > 3 for v in cells.parts.values())
        return cells

    monkeypatch.setattr(spelling.Cells, "made", staticmethod(split))
    rows = corpus(2)
    assert found(documents(rows)) == by_force(rows)


@pytest.mark.parametrize("letters, length", [("ab", 8), ("abcdefghij", 9), ("aé", 16), ("abc", 7)])
def test_near_words_of_a_part(letters, length):
    rng = random.Random(length)
    points = sorted({"".join(rng.choices(letters, k=length)).encode("latin-1")
                     for _ in range(400)})
    import numpy as np

    part = spelling.Near(length, np.array(points, object), np.arange(len(points)))
    for same in (True, False):
        size = length if same else length - 1
        queries = sorted({"".join(rng.choices(letters, k=size)).encode("latin-1")
                          for _ in range(300)})
        got = set(zip(*(x.tolist() for x in part.found(np.array(queries, object), same))))
        assert got == {(i, j) for i, q in enumerate(queries) for j, p in enumerate(points)
                       if near(q, p)}


def test_counts_of_very_long_words():
    letters = spelling.letters_of(pa.array([b"a" * 70_000, b"ab" * 35_000], pa.binary()), 70_000)
    assert spelling.counts_of(letters)[:, :2].tolist() == [[255, 0], [255, 255]]


def test_forms_are_followed_to_the_last(spark):
    chain = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(11)],
                                  "word binary, form binary")
    got = {bytes(r["word"]): bytes(r["root"]) for r in spelling.roots(chain, 4).collect()}
    assert got == {bytes([i]): bytes([11]) for i in range(11)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, word string, n string")
    assert spelling.variants(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "short words")], "doc_id long, text string")
    assert spelling.variants(docs).collect() == []
