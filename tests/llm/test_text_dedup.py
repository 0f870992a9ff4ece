"""Suffix dedup, line dedup and near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import AWKWARD, numbered

from tidemark.llm import jaccard_join, line_dedup, suffix_dedup

random.seed(3)
WORDS = ["".join(random.choices("abcdefghij", k=random.randint(2, 7))) for _ in range(400)]


def prose(n, rng):
    return " ".join(rng.choices(WORDS, k=n))


def planted(seed=1):
    """Documents with shared passages, edited copies, repeated lines and runs of one byte."""
    rng = random.Random(seed)
    passage, line = prose(60, rng), prose(20, rng)
    rows = []
    for i in range(40):
        parts = [prose(rng.randint(5, 120), rng) for _ in range(rng.randint(1, 4))]
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), passage)
        if i % 4 == 0:
            words = line.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            parts.append(" ".join(words))
        rows.append((i, "\n".join(parts)))
    for i in range(40, 55):  # near copies
        words = rows[rng.randrange(4)][1].split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((i, " ".join(words)))
    rows += [(60, "x" * 450), (61, "é" * 150 + passage), (62, "ab" * 200), (63, rows[0][1])]
    return rows + [(100 + (i or 0), t) for i, t in AWKWARD]


def removed_bytes(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        yield gone


def test_suffix_dedup(documents):
    rows = planted() + planted(2)[:9]
    docs = numbered(documents(rows))
    got = {r["__row"]: r for r in docs.select("__row", "text").join(
        suffix_dedup.digests(docs, "__row").withColumnRenamed("row", "__row"), "__row").collect()}
    assert len(got) == len(rows)
    order = list(got.values())
    texts = [(r["text"] or "").encode() for r in order]
    for r, t, gone in zip(order, texts, removed_bytes(texts, 200)):
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def test_suffix_dedup_of_long_texts_in_pieces(monkeypatch):
    import numpy as np

    data = np.frombuffer(("ab" * 300 + prose(900, random.Random(5))).encode(), np.uint8)
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 257)
    for a, b in zip(whole, suffix_dedup.anchors(data)):
        assert (a == b).all()


def test_removed_text(documents):
    docs = numbered(documents(planted()))
    out = suffix_dedup.removed_text(docs, "__row")
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(planted())
    assert [r["text"] for r in rows if r["doc_id"] == 101] == [None]
    assert suffix_dedup.removed_text(docs.limit(0), "__row").collect() == []


def line_sets(rows):
    for place, (doc_id, text) in enumerate(rows):
        for no, line in enumerate((text or "").split("\n")):
            if words := frozenset(line.split()):
                yield (doc_id is None, doc_id or 0, place, no), words


def kept_by_force(rows, t=0.8):
    lines = sorted(line_sets(rows), key=lambda x: x[0])
    kept = defaultdict(list)
    for k, (place, words) in enumerate(lines):
        if not any(len(words & w) >= t * len(words | w) - 1e-9 for _, w in lines[:k]):
            kept[place[2]].append(place[3])
    return kept


@pytest.mark.parametrize("group", [512, 2])
def test_line_dedup(documents, group):
    rows = planted()
    docs = numbered(documents(rows))
    place = {r["__row"]: i for i, r in enumerate(docs.select("__row").orderBy("__row").collect())}
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("__row").collect()]
    got = {place[r["row"]]: r["kept"]
           for r in line_dedup.kept_lines(docs, "__row", group=group).collect()}
    assert got == dict(kept_by_force(rows))


def crowded(seed=4):
    """Lines most of which hold two words that sort before others by chance of their counts, one
    word in a third of all lines, families of variants, and lines of one and two words."""
    rng = random.Random(seed)
    rows = []
    for i in range(90):
        words = [f"own{i}x{j}" for j in range(rng.randint(3, 9))] + rng.choices(WORDS, k=4)
        if i % 3 == 0:
            words.append("everywhere")
        rows.append((i, " ".join(words)))
    for f in range(3):
        base = [f"family{f}x{j}" for j in range(12)]
        for i in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(12)] = rng.choice(WORDS)
            rows.append((100 + 30 * f + i, " ".join(words)))
    long = rng.choices([f"l{j}" for j in range(900)], k=150)
    for i in range(12):
        words = list(long)
        for _ in range(rng.randint(0, 30)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((300 + i, " ".join(words[: rng.randint(50, 150)])))
    rows += [(400 + i, " ".join(p)) for i, p in enumerate([["a"], ["a", "b"], ["b"], ["b", "a"],
                                                            ["c", "a"], ["a", "b", "c"]])]
    return rows


@pytest.mark.parametrize("threshold, group", [(0.8, 512), (0.8, 3), (0.5, 2)])
def test_line_dedup_of_frequent_words(documents, threshold, group):
    docs = numbered(documents(crowded()))
    rows = [(r["__row"], r["doc_id"], r["text"]) for r in docs.orderBy("__row").collect()]
    place = {row: i for i, (row, _, _) in enumerate(rows)}
    got = {place[r["row"]]: r["kept"] for r in line_dedup.kept_lines(
        docs, "__row", threshold=threshold, group=group).collect()}
    want = dict(kept_by_force([r[1:] for r in rows], threshold))
    assert len(want) < len(rows) and got == want


def test_line_dedup_pairs_of_long_lines_are_few(documents):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(1500)]
    docs = numbered(documents([(i, " ".join(rng.sample(words, 160))) for i in range(400)]))
    _, sets = line_dedup.classes(docs, "__row", "doc_id", "text", 0.8)
    pairs, many = line_dedup.candidates(sets, 0.8, 512)
    # a prefix has 34 of the words, so about half of the 79,800 pairs meet; none is similar
    assert pairs.count() < 100 and many.count() == 0


def test_line_dedup_leaves_sets_with_frequent_words_in_place(documents, monkeypatch):
    """Words of many sets are joined with the prefixes, not each set again by its id."""
    seen = []

    def watched(df, name):
        seen.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(df, name)

    stored = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", watched)
    docs = numbered(documents(crowded()))
    _, sets = line_dedup.classes(docs, "__row", "doc_id", "text", 0.8)
    _, many = line_dedup.candidates(sets, 0.8, 3)
    assert many.count() > 0
    plans = [plan for name, plan in seen if name == "pairs"]
    assert len(plans) == 2 and not any(re.search(r"Join Inner, \(id#\d+L = id#\d+L\)", p)
                                       for p in plans)


def test_lines_with_words(spark):
    lines = ["", " ", "\t \r", "\x0b\x0c", " a", "\tb ", "\u00a0", "é"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in df.select(line_dedup.has_words(df["line"])).collect()] == [
        False, False, False, False, True, True, True, True]


def test_line_dedup_texts(documents):
    docs = numbered(documents([(2, "a b c\n\nd e f"), (1, "d e f\nx"), (3, None), (4, "a b c")]))
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup(docs, "__row").collect()}
    assert out == {1: "d e f\nx", 2: "a b c\n", 3: None, 4: ""}
    assert line_dedup.dedup(docs.limit(0), "__row").collect() == []


def grams(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_near_duplicates(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP_BLOCK", 3)  # so that groups are dealt in blocks
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", 4)
    docs = numbered(documents(planted()))
    got = jaccard_join.near_duplicates(docs, "__row").collect()
    texts = {r["__row"]: r["text"] or "" for r in docs.collect()}
    assert len(got) == len(texts)
    distinct = sorted(set(texts.values()))
    sets = [grams(t) for t in distinct]
    links = {a: [b for b in range(len(sets)) if a != b and sets[a] and sets[b]
                 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
             for a in range(len(sets))}
    assert sum(map(len, links.values())) > 20
    group = {}
    for a in links:
        if a not in group:
            stack, own = [a], set()
            while stack:
                x = stack.pop()
                if x not in own:
                    own.add(x)
                    stack += links[x]
            group |= dict.fromkeys(own, min(own))
    roots = {}
    for r in got:
        k = distinct.index(texts[r["row"]])
        assert r["n_links"] == len(links[k])
        assert r["n_copies"] == sum(t == distinct[k] for t in texts.values())
        assert roots.setdefault(group[k], r["root"]) == r["root"]
    assert len(set(roots.values())) == len(roots)
    assert jaccard_join.near_duplicates(docs.limit(0), "__row").collect() == []


def test_pruning_keeps_what_is_likely():
    for n in (15, 60, 150):
        least = jaccard_join.fewest_matches(n, 0.8, 1e-6)
        assert 0 < least < 0.8 * n
