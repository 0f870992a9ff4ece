"""The filter audit against a plain count."""

import random
import re
from collections import Counter
from itertools import permutations

from conftest import AWKWARD
from test_text_dedup import planted

from tidemark.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
           "good_lost", "toxic_lost", "shapley"]


def plain_failures(rows):
    """The failed filters of each (id, text)."""
    out = []
    for i, text in rows:
        text = text or ""
        words = re.findall("[^\\x20\\x09-\\x0D]+", text)
        copies = [j for j, other in rows if (other or "") == text and j is not None]
        out.append("".join(f for f, fails in zip("ABCDE", (
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search("[#$%&*|]", text),
            any(i is None or j < i for j in copies))) if fails))
    return out


def by_force(rows, parts, labels):
    failed = plain_failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for part in sorted({p or "" for p in parts}):
        own = [(i, f) for (i, _), p, f in zip(rows, parts, failed) if (p or "") == part]
        shapley, found = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(gone)
                found.append((part, order, step, len(left), len(gone),
                              sum(name in f for _, f in own) - len(gone),
                              sum(f == name for _, f in own), sum(i in good for i, _ in gone),
                              sum(i in toxic for i, _ in gone)))
        out += [(*f, shapley[f[1][f[2] - 1]]) for f in found]
    return sorted(out)


def documents_and_labels():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = planted() + AWKWARD
    for i in range(300, 360):
        words = rng.sample(vocabulary, rng.choice([50, 99, 100, 150, 200]))
        if i % 3 == 0:
            words += words[: len(words) // rng.choice([2, 4, 5])]
        if i % 4 == 0:
            words = [w.upper() + "ABCDE" * (i % 8) for w in words]
        if i % 5 == 0:
            words.insert(3, rng.choice("#$%&*|"))
        rows.append((i, " ".join(words)))
    rows += [(1000 - i, rows[i][1]) for i in range(0, len(rows), 3)]
    rows += [(None, rows[5][1]), (None, rows[5][1]), (7, rows[7][1]), (None, "only without an id"),
             (400, "pre" * 2000 + "a"), (401, "pre" * 2000 + "b"), (402, "pre" * 2000),
             (403, "pre" * 2000)]
    parts = [("en", "de", None, "", "fr")[i % 5] for i in range(len(rows))]
    labels = [(i, i % 2, i % 3 % 2) for i in range(380)] + [(5, None, 1), (None, 1, 1), (6, 1, None)]
    return rows, parts, labels


def frames(spark, rows, parts, labels, splits):
    docs = spark.createDataFrame([(i, t, p, 1, "x") for (i, t), p in zip(rows, parts)],
                                 "doc_id long, text string, lang string, n int, part string")
    return docs.repartition(splits), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")


def collected(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_audit(spark):
    rows, parts, labels = documents_and_labels()
    want = by_force(rows, parts, labels)
    assert len(want) == 4 * 600 and len({"".join(f) for f in plain_failures(rows)}) > 12
    for splits in (1, 5):
        docs, known = frames(spark, rows, parts, labels, splits)
        assert collected(filter_audit.interactions(docs, known)) == want


def test_many_ranges_and_handed_on_tries(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE_BYTES", 2000)
    monkeypatch.setattr(filter_audit, "HELD_BYTES", 3000)
    monkeypatch.setattr(filter_audit, "DEPTH", 40)
    made = filter_audit.Ranges.made
    seen = []

    def kept(*given):
        seen.append(made(*given))
        return seen[-1]

    monkeypatch.setattr(filter_audit.Ranges, "made", staticmethod(kept))
    rows, parts, labels = documents_and_labels()
    docs, known = frames(spark, rows, parts, labels, 3)
    assert collected(filter_audit.interactions(docs, known)) == by_force(rows, parts, labels)
    assert len(seen[0].bounds) > 5 and max(seen[0].parts) > 1
    assert sorted(seen[0].bounds) == seen[0].bounds


def test_trie():
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 9))) + b"c" * rng.choice([0, 0, 300, 301])
             for _ in range(400)]
    trie = filter_audit.Trie()
    for i, text in enumerate(texts):
        node = trie.terminal(text)
        node.least = min(i, i if node.least is None else node.least)
    got = {text: node.least for text, node in trie.terminals()}
    assert got == {t: texts.index(t) for t in texts}


def test_empty_tables(spark):
    docs, labels = frames(spark, [], [], [], 1)
    assert filter_audit.interactions(docs, labels).collect() == []
    docs, labels = frames(spark, [(1, "a"), (None, None)], [None, "de"], [], 2)
    assert collected(filter_audit.interactions(docs, labels)) == by_force(
        [(1, "a"), (None, None)], [None, "de"], [])
