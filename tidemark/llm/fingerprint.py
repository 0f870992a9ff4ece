"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

A section is what stands between blank lines or a heading line (one that starts with '#'), a
paragraph is a line that is not blank, and its leaves are its sentences, cut every 24 code
points. A leaf's hash is of its text, a parent's of its children's hashes, and the root also
covers the exact text, so roots are equal only for equal texts. The fingerprint is one string:

    root "|" section { ";" section },  section = hash ":" paragraph { "," paragraph }
    paragraph = hash "." leaf { "." leaf },  hash = 16 hex digits (root: 32), leaf = 8

so two fingerprints show, without the texts, whether documents are equal and, going down only
where branches differ, which sections, paragraphs and leaves were edited.

Likeness is the Dice share of common leaves: of all leaves in both trees, how many the other has
too, counting repeats. Equal roots give 1, and trees without a common leaf 0.

Defined cases: null text counts as empty; the empty text has a root and no section; two empty
texts have likeness 1; equal texts have equal fingerprints whatever their other columns; long
texts are read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, tasks, with_columns

LEAF = 24  # code points
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def tree(text: str | None) -> list[list[list[str]]]:
    """Leaf hashes by section and paragraph."""
    sections: list[list[list[str]]] = [[]]
    digest = xxhash.xxh32_hexdigest
    for line in (text or "").split("\n"):
        line = line.strip()
        if not line:
            if sections[-1]:
                sections.append([])
            continue
        if line[0] == "#" and sections[-1]:
            sections.append([])
        sections[-1].append([digest(s[i : i + LEAF]) for s in _SENTENCE.split(line)
                             for i in range(0, len(s), LEAF)])
    return [s for s in sections if s]


def fingerprint(text: str | None) -> str:
    parts = []
    for section in tree(text):
        made = [(xxhash.xxh64_hexdigest(".".join(leaves)), leaves) for leaves in section]
        parts.append(xxhash.xxh64_hexdigest(".".join(h for h, _ in made)) + ":"
                     + ",".join(f"{h}.{'.'.join(leaves)}" for h, leaves in made))
    root = xxhash.xxh3_128((text or "").encode())
    root.update("/".join(p[:16] for p in parts).encode())
    return root.hexdigest() + "|" + ";".join(parts)


def _branches(print_: str) -> list[tuple[str, list[tuple[str, list[str]]]]]:
    body = print_.partition("|")[2]
    out = []
    for section in body.split(";") if body else []:
        h, _, rest = section.partition(":")
        out.append((h, [(p.partition(".")[0], p.split(".")[1:]) for p in rest.split(",")]))
    return out


def likeness(a: str, b: str) -> float:
    """Dice share of common leaves, from 0 to 1."""
    if a[:32] == b[:32]:
        return 1.0
    counts = [Counter(leaf for _, section in _branches(x) for _, leaves in section
                      for leaf in leaves) for x in (a, b)]
    total = counts[0].total() + counts[1].total()
    return 2 * (counts[0] & counts[1]).total() / total if total else 0.0


def edits(a: str, b: str) -> list[tuple[int, int, int]]:
    """(section, paragraph, leaf) of the leaves of `b` that its branch in `a` does not have.

    Branches of equal hash are not entered. A section is compared with the one in the same place.
    """
    if a[:32] == b[:32]:
        return []
    left, right = _branches(a), _branches(b)
    known = {h for h, _ in left}
    out = []
    for i, (h, paragraphs) in enumerate(right):
        if h in known:
            continue
        own = left[i][1] if i < len(left) else []
        same = {p for p, _ in own}
        leaves_there = {leaf for _, leaves in own for leaf in leaves}
        for j, (p, leaves) in enumerate(paragraphs):
            if p not in same:
                out += [(i, j, k) for k, leaf in enumerate(leaves) if leaf not in leaves_there]
    return out


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_fingerprint(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns and `fingerprint`; one row for each row."""
    return with_columns(docs, "fingerprint string", text_col,
                        lambda texts: [pa.array([fingerprint(t) for t in texts], pa.string())])


def compared_with_next(docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document.

    The next document is the one after it in descending id order (null ids last, equal ids in the
    order of their texts); after the last comes the first. Texts are dealt out once, by ranges of
    ids. Of each range the first document also goes to the range before, as the document that
    follows its last one; only ids of range borders are collected, one per task.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    n = 4 * tasks(spark)
    cuts = plain.select(F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0]
    cuts = sorted(set(cuts or []), reverse=True)
    # ids above the first cut are range 0, null ids are the last range
    place = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.expr(f"size(filter(array({', '.join(f'{c}L' for c in cuts)}), c -> c >= doc_id))")
        if cuts else F.lit(0))
    placed = plain.withColumn("place", place.cast("int"))
    heads = {r["place"]: r["head"] for r in
             placed.groupBy("place").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    if not order:
        return spark.createDataFrame(
            [], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                "edited_fingerprint string, near_edited double, near_next double")
    before = {p: order[i - 1] for i, p in enumerate(order)}
    borders = F.create_map(*[F.lit(x) for p in order for x in (p, before[p])])
    heads_of = F.create_map(*[
        F.lit(x).cast(t) for p in order if heads[p] is not None
        for x, t in ((p, "int"), (heads[p], "long"))] or [F.lit(-1), F.lit(0).cast("long")])
    is_head = F.col("doc_id").eqNullSafe(heads_of[F.col("place")])
    copies = F.when(is_head, F.array(
        F.struct(F.col("place").alias("to"), F.lit(False).alias("follows")),
        F.struct(borders[F.col("place")].alias("to"), F.lit(True).alias("follows")))).otherwise(
        F.array(F.struct(F.col("place").alias("to"), F.lit(False).alias("follows"))))
    dealt = (
        placed.withColumn("copy", F.explode(copies))
        .select(F.col("copy.to").alias("to"), F.col("copy.follows").alias("follows"),
                "doc_id", "text")
        .repartition(len(order), "to")
        .sortWithinPartitions("to", "follows", F.col("doc_id").desc_nulls_last(), "text")
    )
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (to, doc_id, text, fingerprint) that waits for the next document
        done = None  # the range whose following document has been seen
        for part in in_slices(batches, "text"):
            rows = []
            for to, follows, doc_id, text in zip(*(part.column(c).to_pylist() for c in
                                                   ("to", "follows", "doc_id", "text"))):
                if follows and done == to:
                    continue
                print_ = fingerprint(text)
                if held is not None:
                    _, held_id, held_text, held_print = held
                    changed = edited(held_text, text)
                    changed_print = fingerprint(changed)
                    rows.append((held_id, len(held_text),
                                 hashlib.sha256(changed.encode()).hexdigest(), held_print,
                                 changed_print, likeness(held_print, changed_print),
                                 likeness(held_print, print_)))
                held = (to, doc_id, text, print_)
                if follows:
                    done, held = to, None
            names = [c.split()[0] for c in schema.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                     pa.float64()]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names)

    return dealt.mapInArrow(compare, schema)
