"""HTML main text: a recurrent block labeller over the leaf blocks of a page.

A page is cut into blocks: runs of text between block-level tags, each with the path of the
elements around it. A bidirectional LSTM in numpy reads the blocks in page order, each as a vector
of its hashed tag path (tags, and words of class, id and role), its hashed words, its length and
the share of link text, and labels every block from the context of the whole page. The main text
is the blocks labelled as article.

There are no labels for pages, so a rule labels a bounded sample of them: text inside article or
main elements, but not inside menus, headers, footers, sidebars, forms, notices, adverts or
comments. From the sampled pages' blocks, training pages in other layouts are made, with other
containers, class names and insertions, so the model does not depend on one template.

Defined cases: null html counts as empty; a page without article blocks has empty text; unclosed
and stray tags, comments and character references are read as browsers do for text; scripts,
styles, titles, text areas, inline frames and noscript are not text; text in formulas, drawings,
objects, selects and templates is, and labelled like other text; nothing is dropped inside an
article block, whatever its length; equal pages have equal texts.
"""

from __future__ import annotations

import html
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, least_text

SAMPLE_PAGES = 384  # bound of the pages a model is fitted on
PATH, WORDS, NUMBERS, HIDDEN = 256, 24, 6, 16
EPOCHS, BATCH, RATE = 8, 32, 0.01

# Elements of HTML by their role in text.
_RAW = "script|style|noscript|textarea|title|iframe"  # no elements inside
_FOREIGN = {"svg", "math"}  # there, tags that end in "/>" are empty, and blocks end them
_IN_FOREIGN = {"foreignobject", "desc", "annotation-xml"}  # where html goes on
_IN_SELECT = {"option", "button", "div", "hr", "legend"}  # other blocks end a select
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
# Words by which the rule knows what is not the article.
_NOT_ARTICLE = set(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "cookie cookies consent disclaimer discussion footer form header login masthead menu modal "
    "nav navbar navigation newsletter notice notification pagination pager popup promo promoted "
    "promotion related replies reply respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe tags toolbar topbar widget widgets".split())
_NOT_TAGS = {"nav", "footer", "aside", "form", "button", "label", "dialog", "menu"}
_ARTICLE = {"article", "main"}

_INSIDE = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])(?P<rest>{_INSIDE}|[^>]*)>"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<of>{_INSIDE})>|<[!?/][^>]*>",
    re.S | re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in _RAW.split("|")}
_FOREIGN_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>|(?=</(?:svg|math)[\s/>])", re.I)
                for tag in _RAW.split("|")}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags from the root, each followed by its names as ".name"
    link: float = 0.0  # share of the text in links


def _names(attributes: str) -> list[str]:
    out = []
    for m in _NAMES.finditer(attributes):
        value = next(g for g in m.groups() if g is not None)
        out += _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return out


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked = 0
    path: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, path, min(1.0, linked / len(text))))
            pieces, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked, path
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not pieces and not text.isspace():
            path = tuple(n for tag, names in stack for n in (tag, *names))
        if pieces or not text.isspace():
            pieces.append(text)
            if any(tag == "a" for tag, _ in stack):
                linked += len(text.strip())

    def close(tags: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    def inside(tags: set[str], until: set[str]) -> int:
        """Place in the stack of the innermost element of `tags`, if none of `until` is in it."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in until:
                break
        return -1

    at = 0
    while m := _TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        raw = m["raw"]
        tag, attributes = (raw, m["rest"]) if raw else (m["tag"], m["of"])
        if tag is None:
            continue
        tag, empty = tag.lower(), attributes.rstrip().endswith("/")
        if raw:
            foreign = inside(_FOREIGN, _IN_FOREIGN) >= 0
            if foreign and empty:
                continue
            closed = (_FOREIGN_END if foreign else _RAW_END)[tag].search(page, at)
            if closed or not foreign:
                at = closed.end() if closed else len(page)
                continue
        if tag == "br":
            add(" ")
            continue
        if tag in _BLOCK:
            flush()
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in _BLOCK:
            if (i := inside(_FOREIGN, _IN_FOREIGN)) >= 0:
                del stack[i:]
            if tag not in _IN_SELECT and (i := inside({"select"}, _FOREIGN)) >= 0:
                del stack[i:]
            close({"p"}, {"div", "section", "article", "td", "li", "body", "main"})
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                close({"td", "th"} if tag in ("td", "th") else {"dt", "dd"}
                      if tag in ("dt", "dd") else {tag}, {"ul", "ol", "dl", "table", "select"})
        if tag not in _VOID and not empty:
            stack.append((tag, tuple("." + n for n in _names(attributes)) if "=" in attributes
                          else ()))
    add(page[at:])
    flush()
    return out


def rule(block: Block) -> int:
    """1 for article text, by the elements and names around a block."""
    inside = False
    for i, name in enumerate(block.path):
        if name[0] == ".":
            if name[1:] in _NOT_ARTICLE:
                return 0
        elif name in _NOT_TAGS or name == "header" and not inside:
            return 0
        elif name in _ARTICLE:
            inside = True
    return int(inside)


class _Hashed(dict):
    def __init__(self, size: int) -> None:
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = value = xxhash.xxh32_intdigest(word) % self.size
        return value


_PATHS, _WORDS_OF = _Hashed(PATH), _Hashed(WORDS)


def vectors(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), PATH + WORDS + NUMBERS), np.float32)
    for i, b in enumerate(page):
        for name in b.path:
            x[i, _PATHS[name]] = 1
        if b.path:  # the last element again, by itself
            last = max(k for k, n in enumerate(b.path) if n[0] != ".")
            x[i, _PATHS["last " + b.path[last]]] = 1
        words = b.text.lower().split()
        ids = [_WORDS_OF[w] for w in words]
        x[i, PATH : PATH + WORDS] = np.bincount(ids, minlength=WORDS) / len(words)
        n = len(b.text)
        x[i, PATH + WORDS :] = (np.log1p(n) / 8, b.link, min(1.0, len(words) / 50),
                                b.text[-1] in ".!?", (i + 1) / len(page), 1.0)
    return x


@dataclass
class Lstm:
    """Two LSTMs, over the blocks and over the blocks from the end, and a logistic output."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 5) -> Lstm:
        rng, d = np.random.default_rng(seed), PATH + WORDS + NUMBERS
        w = {}
        for side in "fb":
            w["x" + side] = rng.normal(0, 0.1, (d, 4 * HIDDEN))
            w["h" + side] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            w["c" + side] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]
        w["out"] = rng.normal(0, 0.1, 2 * HIDDEN)
        w["bias"] = np.zeros(1)
        return Lstm({k: v.astype(np.float32) for k, v in w.items()})

    def run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool) -> tuple:
        """x: (time, pages, inputs), mask: (time, pages). Padding keeps the state."""
        w, steps, pages = self.weights, *x.shape[:2]
        z_all = x @ w["x" + side] + w["c" + side]
        h = c = np.zeros((pages, HIDDEN), np.float32)
        hs, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = z_all[t] + h @ w["h" + side]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = np.split(gates, 3, 1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep:
                kept.append((t, h, c, i, f, o, g, tanh, m))
            c = np.where(m, new, c)
            h = np.where(m, o * tanh, h)
            hs[t] = h
        return hs, kept

    def margins(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        hf, _ = self.run(x, mask, "f", False)
        hb, _ = self.run(x, mask, "b", False)
        return np.concatenate([hf, hb], 2) @ self.weights["out"] + self.weights["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        runs = {side: self.run(x, mask, side, True) for side in "fb"}
        h = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        p = 1 / (1 + np.exp(-(h @ w["out"] + w["bias"])))
        d = np.where(mask, p - y, 0) / mask.sum()
        out = {"out": np.tensordot(d, h, ([0, 1], [0, 1])), "bias": np.array([d.sum()])}
        dh_all = d[..., None] * w["out"]
        for k, side in enumerate("fb"):
            dx = np.zeros(x.shape[:2] + (4 * HIDDEN,), np.float32)
            dw = np.zeros_like(w["h" + side])
            dh = dc = np.zeros(x.shape[1:2] + (HIDDEN,), np.float32)
            for t, h0, c0, i, f, o, g, tanh, m in reversed(runs[side][1]):
                own = dh + dh_all[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                dnew = np.where(m, dc + own * o * (1 - tanh * tanh), 0)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c0 * f * (1 - f),
                                     np.where(m, own * tanh * o * (1 - o), 0),
                                     dnew * i * (1 - g * g)], 1)
                dx[t] = dz
                dw += h0.T @ dz
                dh = np.where(m, dz @ w["h" + side].T, own)
                dc = np.where(m, dnew * f, dc)
            out["h" + side] = dw
            out["x" + side] = np.tensordot(x, dx, ([0, 1], [0, 1]))
            out["c" + side] = dx.sum((0, 1))
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), PATH + WORDS + NUMBERS), np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k] = p
        mask[: len(p), k] = True
    return x, mask


# Containers of the layouts that training pages are made in.
_HOMES = ["article", "main article", "main", "div.content", "div.main .content", "div.post .body",
          "div.entry .content", "section.article", "div.story .text", "article.post", "div.page",
          "article div.text", "main div.container", "div.wrapper article", ""]
_OTHERS = [
    ("nav ul li a", "div.menu ul li", "ul.nav li a", "div.breadcrumbs a", "div.topbar", "header",
     "header div.banner", "div.header", "header nav a", "div.masthead", "div.login form label"),
    ("div.ad", "div.advert", "aside.ad", "div.sponsored", "div.promo", "section.banner", "aside p",
     "div.notice", "div.cookie .notice p", "div.alert", "p.notice", "div.disclaimer",
     "form label", "form p", "div.newsletter form", "div.subscribe p", "div.share a"),
    ("aside ul li", "div.sidebar p", "aside.related li a", "div.widget li", "section.comments p",
     "div.comments div.comment p", "ol.comments li p", "div#respond p", "div.discussion p",
     "article.comment p", "footer", "footer p", "div.footer", "div.copyright", "div.tags a",
     "footer ul li a", "div.pagination a", "section.related p", "form.search label"),
]


_HOLDERS = ["div.{}", "section.{}", "aside.{}", "p.{}", "ul.{} li", "div.{} p", "div.{} div",
            "div.{} ul li a", "ol.{} li"]


def _path(spec: str) -> tuple[str, ...]:
    out: list[str] = []
    for part in spec.replace("#", ".").split():
        tag, *names = part.split(".")
        out += ([tag] if tag else []) + ["." + n for n in names]
    return tuple(out)


def variant(page: list[Block], labels: list[int], other: list[Block],
            rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The article of a page in another layout, among texts of another page."""
    outer = ("html", "body") + ((), ("div", ".wrapper"), ("div", ".container"))[rng.integers(3)]
    home = outer + _path(_HOMES[rng.integers(len(_HOMES))])
    out, marks, names = [], [], sorted(_NOT_ARTICLE)

    def insert(kind: int, inside: tuple[str, ...]) -> None:
        if rng.random() < 0.5:
            path = inside + _path(_OTHERS[kind][rng.integers(len(_OTHERS[kind]))])
        else:
            name = names[rng.integers(len(names))]
            path = inside + _path(_HOLDERS[rng.integers(len(_HOLDERS))].format(name))
        for _ in range(rng.integers(1, 5)):
            text = other[rng.integers(len(other))].text
            if rng.random() < 0.5 or "a" in path:
                text = " ".join(text.split()[: rng.integers(1, 12)])
            out.append(Block(text, path, float("a" in path)))
            marks.append(0)

    for _ in range(rng.integers(0, 3)):
        insert(0, outer)
    if rng.random() < 0.5:
        insert(rng.integers(1, 3), outer)
    for n, (b, label) in enumerate(zip(page, labels)):
        if label:
            tag = ("h1", "h2", "p")[rng.integers(3)] if n == 0 else (
                "p", "p", "p", "p", "li", "blockquote", "h2", "pre", "td", "div")[rng.integers(10)]
            around = {"li": ("ul", "li"), "td": ("table", "tr", "td")}.get(tag, (tag,))
            bold = ("b",) if rng.random() < 0.2 else ()
            out.append(Block(b.text, home + around + bold, 0.0))
            marks.append(1)
            if rng.random() < 0.12:
                insert(1, home)
    for _ in range(rng.integers(0, 4)):
        insert(rng.integers(1, 3), home if rng.random() < 0.3 else outer)
    if rng.random() < 0.8:
        insert(2, outer)
    return out, marks


def train(pages: list[str]) -> Lstm:
    rng = np.random.default_rng(11)
    read = [b for p in sorted(set(pages)) if (b := blocks(p))]
    examples = []
    for k, page in enumerate(read):
        labels = [rule(b) for b in page]
        examples.append((vectors(page), np.array(labels, np.float32)))
        for _ in range(3 if any(labels) else 0):
            made, marks = variant(page, labels, read[rng.integers(len(read))], rng)
            examples.append((vectors(made), np.array(marks, np.float32)))
    model = Lstm.fresh()
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    examples = [(x[:256], y[:256]) for x, y in examples]  # bounds a training step, not a page
    for _ in range(EPOCHS if examples else 0):
        order = rng.permutation(len(examples))
        for start in range(0, len(order), BATCH):
            own = [examples[i] for i in order[start : start + BATCH]]
            x, mask = padded([e[0] for e in own])
            y = np.zeros(mask.shape, np.float32)
            for k, e in enumerate(own):
                y[: len(e[1]), k] = e[1]
            step += 1
            for k, g in model.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                model.weights[k] = (model.weights[k] - RATE * move).astype(np.float32)
    return model


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
        max_rows: int = SAMPLE_PAGES) -> Lstm:
    """Fits on at most `max_rows` pages, the first ones in the order of a hash of their ids.

    A repeated id gives one page, that of the least hash.
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{html_col}`")
    place = F.xxhash64(key.cast("string"))
    picked = (pages.select(place.alias("place"), key.alias("key")).where(key.isNotNull())
              .distinct().orderBy("place", "key").limit(max_rows).select("key"))
    sample = pages.select(key.alias("key"), F.coalesce(text, F.lit("")).alias("html")).join(
        F.broadcast(picked), "key").groupBy("key").agg(
            least_text(F.col("html")).alias("html")).select("html")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [p for b in batches for p in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([pickle.dumps(train(found).weights)], pa.binary())], ["w"])

    row = sample.repartition(1).mapInArrow(learn, "w binary").first()
    return Lstm(pickle.loads(row["w"])) if row else Lstm.fresh()


def main_texts(model: Lstm, pages: list[str | None], most: int = 1 << 15) -> list[str]:
    """Main texts; pages of like length go through the network together."""
    read = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, p in enumerate(read) if p), key=lambda i: len(read[i]))
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and (end - start + 1) * len(read[order[end]]) <= most // 8:
            end += 1
        group = order[start:end]
        x, mask = padded([vectors(read[i]) for i in group])
        keep = model.margins(x, mask) > 0
        for k, i in enumerate(group):
            out[i] = "\n\n".join(b.text for b, yes in zip(read[i], keep[:, k]) if yes)
        start = end
    return out


def extract(pages: DataFrame, model: Lstm, html_col: str = "html") -> DataFrame:
    """All columns of `pages` but the html, with `text` and `n_chars` (code points)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    plain = pages.select(*[F.col(f"`{c}`") for c in kept],
                         F.col(f"`{html_col}`").cast("string").alias("html"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema
                        if f.name != "html"] + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "html", most_rows=512):
            texts = main_texts(shared.value, part.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], [*kept, "text", "n_chars"])

    return plain.mapInArrow(run, schema)
