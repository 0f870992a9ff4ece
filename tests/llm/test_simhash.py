"""SimHash fingerprints, Golay keys and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import AWKWARD, LONG
from pyspark.sql import functions as F
from test_text_dedup import planted

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.spread import join_spread


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\\x20\\x09-\\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def by_force(rows):
    """(id, fingerprint, smallest id in reach) of each row."""
    prints = [plain_fingerprint(t) for _, t in rows]
    known = sorted(set(prints))
    group = {p: {p} for p in known}
    for i, p in enumerate(known):
        for q in known[i + 1 :]:
            if (p ^ q).bit_count() <= 2 and group[p] is not group[q]:
                group[p] |= group[q]
                for r in group[q]:
                    group[r] = group[p]
    out = []
    for (i, _), p in zip(rows, prints):
        ids = [j for (j, _), q in zip(rows, prints) if q in group[p] and j is not None]
        out.append((i, p, min(ids, default=None)))
    return sorted(out, key=repr)


def found(docs, **options):
    return sorted(((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"])
                   for r in simhash.near_duplicates(docs, **options).collect()), key=repr)


@pytest.mark.parametrize("text", [t for _, t in AWKWARD] + [
    "A", "a B\tC", "ÀÉ À x\x0bY\x0cz", "x y z " * 9, "nbsp stays one   word", "\x1c a \x85"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int64)
    code = words[simhash._syndromes(words) == 0]
    weights = np.bitwise_count(code)
    assert len(code) == 1 << 12 and weights[weights > 0].min() == 7
    patterns = simhash._PATTERNS
    assert (np.bitwise_count(patterns[:, 0]) <= 3).all()
    count = (patterns >= 0).sum(1)
    assert set(count) == {1, 6}
    some = np.random.default_rng(1).integers(0, 1 << 23, 50)
    for word, found_ in zip(some, simhash.indices(some)):
        near = code[np.bitwise_count(code ^ word) <= 4]
        assert sorted(near >> 11) == sorted(found_[found_ >= 0])


def test_all_pairs_two_bits_apart_share_a_key():
    rng = np.random.default_rng(2)
    for one in rng.integers(-(1 << 63), 1 << 63, 12):
        others = [one ^ np.uint64((1 << a) | (1 << b)).view(np.int64)
                  for a in range(64) for b in range(a, 64)]
        own = set(simhash.keys(np.array([one]))[0]) - {-1}
        for row in simhash.keys(np.array(others)):
            assert own & set(row.tolist())




@pytest.mark.parametrize("bucket", [512, 1])
def test_components_of_documents(documents, bucket):
    rng = random.Random(4)
    base = " ".join(f"t{rng.randrange(300)}" for _ in range(400)).split()
    rows = planted() + AWKWARD
    for i in range(60):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(400)] = f"t{rng.randrange(300)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(None, base[0]), (None, base[0]), (2000, LONG.upper())]
    want = by_force(rows)
    assert len({g for *_, g in want}) < len({p for _, p, _ in want})
    assert found(documents(rows), bucket=bucket) == want


@pytest.mark.parametrize("bucket", [512, 3])
def test_links_of_a_dense_group(spark, bucket):
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(-(1 << 63), 1 << 63, 40)}
    for _ in range(400):  # walks of one to three bits from known ones
        p = sorted(prints)[rng.integers(len(prints))]
        for b in rng.integers(0, 64, rng.integers(1, 4)):
            p ^= int(np.uint64(1 << int(b)).view(np.int64))
        prints.add(p)
    every = sorted(prints)
    nodes = spark.createDataFrame([(p,) for p in every], "fp long")
    got = simhash.links(nodes, bucket).collect()

    def groups(edges):
        root = {p: p for p in every}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for u, v in edges:
            a, b = sorted((top(u), top(v)))
            root[b] = a
        return {p: top(p) for p in every}

    linked = [(p, q) for i, p in enumerate(every) for q in every[i + 1 :]
              if ((p ^ q) % (1 << 64)).bit_count() <= 2]
    assert groups([(r["u"], r["v"]) for r in got]) == groups(linked)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, fp string, root long")
    assert simhash.near_duplicates(docs).collect() == []


def test_components_of_a_hub(spark):
    star = [(7, i) for i in range(8, 3000)] + [(i, i + 1) for i in range(5000, 5040)] + [(4, 4)]
    edges = spark.createDataFrame(star, "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 7 for i in range(7, 3000)}, **{i: 5000 for i in range(5000, 5041)}, 4: 4}


def test_join_spread(spark):
    rows = spark.createDataFrame([(i % 3 if i % 2 else 9, i) for i in range(3000)] + [(50, -1)],
                                 "k long, v long")
    side = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m")).where("k <> 1")
    got = join_spread(rows, side, "k", "n", 3001)
    want = rows.join(side.drop("n"), "k")
    assert got.columns == ["k", "v", "m"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
