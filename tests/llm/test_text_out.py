"""Fingerprints, pieces, packing, pages and vectors."""

import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import AWKWARD
from pyspark.sql import functions as F

from tidemark.llm import fingerprint, html_text, packing, pieces, rp_forest

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b", "a   b\n\n c ", "x \n y", "  ", "", "\n", " a", "don't 's <|endoftext|> x", "é b  c",
       "a\ta \t b\t\tc 12,5 !!! ab", "one.\nTwo three.\nFour", "x.\n y", "日本 ñ€😀 b"]


def test_fingerprints_of_equal_and_edited_texts():
    a = "One here. Two here.\nSecond line.\n\nNew section here. And more."
    assert fingerprint.fingerprint(a) == fingerprint.fingerprint(str(a))
    assert fingerprint.fingerprint(a) != fingerprint.fingerprint(a + " ")
    b = a.replace("Second", "Third")
    x, y = fingerprint.fingerprint(a), fingerprint.fingerprint(b)
    assert fingerprint.edits(x, y) == [(0, 1, 0)] and fingerprint.edits(x, x) == []
    assert 0 < fingerprint.likeness(x, y) < 1 == fingerprint.likeness(x, x)
    empty = fingerprint.fingerprint(None)
    assert empty == fingerprint.fingerprint("") and fingerprint.likeness(empty, x) == 0


def test_fingerprint_with_next(documents):
    docs = documents(AWKWARD + [(i, f"text {i} " * (i % 7)) for i in range(20, 90)])
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        e = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        a, b = fingerprint.fingerprint(t), fingerprint.fingerprint(u)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a,
                     fingerprint.likeness(a, fingerprint.fingerprint(e)),
                     fingerprint.likeness(a, b)))
    out = fingerprint.compared_with_next(docs).drop("edited_fingerprint").collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in out)
    assert fingerprint.compared_with_next(docs.limit(0)).collect() == []


def test_units_are_the_tokenizer_s_ids():
    units = packing.encoder(BPE)
    for text in ODD + [t for _, t in AWKWARD if t]:
        ids = units.tokenizer.encode(text, add_special_tokens=False).ids
        assert units.encode(text) == np.array(ids, "<u4").tobytes()


def test_units_in_mixed_white_space():
    units = packing.encoder(BPE)
    mixed = ["a \u00a0 \u00a0 b", "a\u00a0 ", " \u00a0 \u00a0 \u00a0 \u00a0 x", "a\n \u00a0b"]
    for text in mixed + ["".join(c) for n in range(1, 6)
                         for c in itertools.product("a \n.\u00a0\u3000", repeat=n)]:
        ids = units.tokenizer.encode(text, add_special_tokens=False).ids
        assert units.encode(text) == np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("length, parts", [(1024, 3), (64, 9)])
def test_packing(documents, monkeypatch, length, parts):
    monkeypatch.setattr(packing, "FAN_IN", 2)  # several rounds of leftovers
    rows = AWKWARD + [(100 + i, f"some text {i} " * (i % 40)) for i in range(120)]
    docs = documents(rows).repartition(parts)
    docs.write.mode("overwrite").parquet(path := packing.fresh_path(docs.sparkSession, "in"))
    docs = docs.sparkSession.read.parquet(path)
    out = packing.pack(docs, BPE, length=length, keep_ids=True).collect()
    at = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert at.get(r["sequence_id"], 0) == r["offset"]
        at[r["sequence_id"]] = r["offset"] + r["length"]
        assert len(r["ids"]) == 4 * r["length"] > 0
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
    assert max(at.values()) <= length
    assert sum(n < length for n in at.values()) <= packing.OPEN_WINDOWS
    encode = packing.encoder(BPE).encode
    whole = {}
    for r in sorted(out, key=lambda r: r["start"]):
        whole.setdefault(r["doc_id"], []).append(r)
    once = {i: t for i, t in rows if sum(j == i for j, _ in rows) == 1}
    for i, t in once.items():
        ids = encode(t or "") + bytes(4)
        assert b"".join(bytes(r["ids"]) for r in whole[i]) == ids
        assert {r["doc_tokens"] for r in whole[i]} == {len(ids) // 4}
        assert [r["start"] for r in whole[i]] == np.cumsum(
            [0, *[r["length"] for r in whole[i]]])[:-1].tolist()
    assert packing.pack(docs.limit(0), BPE).collect() == []


def every_path(v, text):
    """All segmentations with their scores, by recursion."""
    if not text:
        return [(0.0, b"")]
    out = []
    for i in range(1, min(len(text), v.longest) + 1):
        if (found := v.edges(text, 0, i)) is not None:
            out += [(found[0] + s, found[1] + ids) for s, ids in every_path(v, text[i:])]
    return out


@pytest.mark.parametrize("text", ["the cat", "a b", " a", "x,y.", "in  on", "né", "q", "theory"])
def test_n_best_against_all_paths(text):
    v = pieces.vocabulary(PIECES)
    paths = every_path(v, pieces.SPACE + text.replace(" ", pieces.SPACE))
    for n in (1, 4, 7):
        got = v.encode(text, n)
        assert [s for s, _ in got] == sorted((s for s, _ in paths), reverse=True)[:n]
        assert len({ids for _, ids in got}) == len(got)
        assert {ids for _, ids in got} <= {ids for _, ids in paths}
        assert all(v.decode(ids) == text for _, ids in got)


@pytest.mark.parametrize("text", ["▁international", "▁don't", "▁😀é日x", "▁", "zzzz▁▁ab"])
def test_two_best_reads_a_text_in_few_slices(text):
    class Counted(str):
        slices = 0

        def __getitem__(self, at):
            Counted.slices += isinstance(at, slice)
            return str.__getitem__(self, at)

    v = pieces.vocabulary(PIECES)
    paths = sorted((s for s, _ in every_path(v, text)), reverse=True)
    score, ids, loss = v.two_best(Counted(text))
    assert Counted.slices <= len(text)  # and not one for each beginning of a piece
    assert score == paths[0] and (score, ids) in every_path(v, text)
    assert loss == (paths[0] - paths[1] if len(paths) > 1 else float("inf"))


@pytest.mark.parametrize("unit", ["", "a", "▁the", "▁one.", "..a!?b", "▁日本 ñ€😀 b", "▁\0x"])
def test_parts_are_cut_where_no_piece_spans(unit):
    v = pieces.vocabulary(PIECES)
    cuts = [k for k in range(1, len(unit)) if unit[k - 1 : k + 1] not in v.joined]
    assert v.parts(unit) == [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]


def test_pieces_rows(documents):
    docs = documents(AWKWARD)
    out = pieces.encode(docs, PIECES)
    best = pieces.decode(out.where("rank = 1"), PIECES).collect()
    assert all(r["round_trip"] for r in best)
    assert sorted(r["text"] for r in best) == sorted(t or "" for _, t in AWKWARD)
    assert pieces.encode(docs.limit(0), PIECES).collect() == []


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy things.</div>
<article><h1>The title &amp; more</h1><p>First  paragraph
with <b>bold<br>words</b>.<p>Second &lt;one&gt;&nbsp;here. <!-- no --></article>
<section class="comments"><p>I like this article a lot.</p></section>
<script>var a = "</p>";</script><footer>&copy; 2020 somebody</footer></body></html>"""


def test_blocks_and_rule():
    read = html_text.blocks(PAGE)
    assert [b.text for b in read if html_text.rule(b)] == [
        "The title & more", "First paragraph with bold words.", "Second <one> here."]
    assert "Buy things." in [b.text for b in read] and "T" not in [b.text for b in read]
    assert html_text.blocks(None) == [] and html_text.blocks("<!-- open") == []


@pytest.mark.parametrize("between", [
    '<svg width="1"/>', '<math/>', '<svg><path d="M0"></svg>', '<svg><path d="M0">',
    '<svg><title>t</title><style/></svg>', '<svg><title/>', '<svg><script>1<2</script></svg>',
    '<object data="x">', '<canvas>', '<select>', '<template>', '<script>"</p><p>"</script>',
    '<title>no</title>', '<iframe src="x"><p>no</iframe>', '<textarea><p>no</textarea>',
    '<noscript><p>no</noscript >'])
def test_no_element_takes_the_rest_of_the_article(between):
    page = f"<article><p>one</p>{between}<p>two</p></article><footer><p>end</p></footer>"
    read = html_text.blocks(page)
    assert [b.text for b in read if html_text.rule(b)] == ["one", "two"]
    assert read[-1].path == ("footer", "p")


@pytest.mark.parametrize("inner, text", [
    ("a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b", "a x=1 b"),
    ("<object data='x'>instead</object> of", "instead of"),
    ("<canvas>drawn</canvas> by", "drawn by"), ("a <svg/> b", "a b"),
    ("<svg><text>axis</text><style>p{}</style></svg> is", "axis is")])
def test_text_of_embedded_elements_stays(inner, text):
    read = html_text.blocks(f"<article><p>{inner}</p></article>")
    assert [b.text for b in read if html_text.rule(b)] == [text]


def test_pages(spark):
    import duckdb

    html = [r[0] for r in duckdb.sql(
        "SELECT html FROM '/root/testdata/sf0.001/pages.parquet' ORDER BY page_id").fetchall()]
    rows = [(i, "u", p) for i, p in enumerate([*html, PAGE, None, "", html[0]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "text", F.lit(1))
    out = html_text.extract(pages, html_text.fit(pages)).orderBy("page_id").collect()
    want = ["\n\n".join(b.text for b in html_text.blocks(p) if html_text.rule(b))
            for _, _, p in rows]
    assert np.mean([r["text"] == w for r, w in zip(out, want)]) > 0.95
    assert out[0]["text"] == out[-1]["text"] and out[-3]["text"] == out[-2]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    model = html_text.fit(pages.limit(0))
    assert html_text.extract(pages.limit(0), model).collect() == []


def test_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 12)).astype(np.float32)
    x[50:90] = x[50]  # copies
    rows = [(i, [float(c) for c in v], "e") for i, v in enumerate(x)]
    rows += [(700, None, "e"), (701, [], "e"), (702, [0.0] * 12, "e"), (703, [1.0, None], "e"),
             (704, [float("nan")] * 12, "e"), (705, [float("inf")] * 12, "e"), (10, rows[10][1], "e")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    out = rp_forest.nearest(df, F.col("id") % 10 == 0).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 700, 10))
    hits = 0
    for q, got in found.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        best = sorted((d[i], i) for i in range(700) if i != q)[:10]
        hits += len({i for _, i in best} & {i for i, _ in got})
        assert len(got) == 10 and got == sorted(got, key=lambda g: (g[1], g[0]))
        assert all(abs(d[i] - s) < 1e-12 for i, s in got)
    assert hits >= 0.9 * 10 * len(found)
    assert rp_forest.nearest(df.limit(0), F.col("id") % 10 == 0).collect() == []
    few = rp_forest.nearest(df.where("vec_id < 3"), F.col("id") == 0).collect()
    assert [r["vec_id"] for r in few] and len(few) == 2
