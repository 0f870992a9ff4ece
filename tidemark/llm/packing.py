"""Bounded-space online packing of tokenized documents into sequences of a fixed length.

Each partition keeps a fixed number of open windows. A document's ids are cut into full windows
and a remainder; the remainder goes to the open window that it leaves the least room in. When it
fits in none, its head fills the fullest window to the end, that window is emitted, and the rest
is placed anew; a new window opens while fewer than the fixed number are open. What a partition
leaves open goes with the leftovers of 63 others into a partition of the next round, and so on
until one is left, so that a round's task gets a bounded number of part-filled windows. Only the
last round emits windows that are not full, each padded to the next power of two.

A sequence id is made of round, partition and count. A round is written before it is read, with
the full windows and leftovers of a task in one file, so a lost executor cannot mix two attempts.

Defined cases: null text counts as empty; an empty text is its end id alone; equal documents and
null ids are packed like others; a text is never cut short; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh_path, in_slices

LENGTH = 1024
OPEN_WINDOWS = 16
FAN_IN = 64
END_ID = 0
_CACHE_WORDS = 1_000_000
_INSIDE_RUN = re.compile(r"(?<=\s) (?=\s|\Z)")


class _Alphabet(dict):
    """The byte alphabet's form of a character, by code point, for str.translate."""

    def __init__(self, split) -> None:
        self.split = split

    def __missing__(self, code: int) -> str:
        self[code] = value = self.split.pre_tokenize_str(chr(code))[0][0]
        return value


class _Units(dict):
    """Ids (little-endian, 32 bits) of a space and the characters up to the next space.

    In byte-level BPE a space begins a pre-token, so such units are encoded alone, unless it stands
    inside a run of white space, which is one pre-token: those texts are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split, self.model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        self.alphabet = _Alphabet(self.split)
        self.whole = ["  ", *(t.content for t in
                              self.tokenizer.get_added_tokens_decoder().values())]
        self.line_end = self.ids("\n")

    def ids(self, text: str, pre_token: bool = False) -> bytes:
        """`pre_token`: the text is known to be one."""
        parts = [text.translate(self.alphabet)] if pre_token else [
            part for part, _ in self.split.pre_tokenize_str(text)]
        found = [t.id for part in parts for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(found)}I", *found)

    def word(self, space: str, word: str) -> bytes:
        if word.isalpha():  # letters, with a space before them or not, are one pre-token
            return self.ids(space + word, True)
        if word[:-1].isalpha() and word[-1] in ".,!?;:":  # and a mark after them another
            before = self[word[:-1]] if space else self.ids(word[:-1], True)
            return before + self.ids(word[-1], True)
        a, line_end, b = word.partition("\n")
        if line_end and a and b and "\n" not in b and not (
                a[-1].isspace() or b[0].isspace()):
            return (self[a] if space else self.word("", a)) + self.line_end + self.word("", b)
        return self.ids(space + word)

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self.word(" ", unit)
        self[unit] = value
        return value

    def encode(self, text: str) -> bytes:
        """Ids of a text as the tokenizer gives them without added special tokens."""
        if any(s in text for s in self.whole) or _INSIDE_RUN.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        return self.word("", first) + b"".join(map(self.__getitem__, rest))


_ENCODERS: dict[str, _Units] = {}


def encoder(path: str) -> _Units:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Units(path)
    return _ENCODERS[path]


class Packer:
    """Open windows of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, length: int, most_open: int, first_id: int) -> None:
        self.length, self.most_open, self.next_id = length, most_open, first_id
        self.open: list[tuple[int, list]] = []  # (used, pieces)
        self.full: list[tuple[int, list]] = []  # (sequence id, pieces)

    def emit(self, pieces: list) -> None:
        self.full.append((self.next_id, pieces))
        self.next_id += 1

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        size = 4 * self.length
        while len(ids) >= size:
            self.emit([(doc_id, start, ids[:size], doc_tokens)])
            start, ids = start + self.length, ids[size:]
        while ids:
            need = len(ids) // 4
            fits = [(used, i) for i, (used, _) in enumerate(self.open) if used + need <= self.length]
            if not fits and len(self.open) < self.most_open:
                self.open.append((need, [(doc_id, start, ids, doc_tokens)]))
                return
            used, i = max(fits) if fits else max((u, i) for i, (u, _) in enumerate(self.open))
            take = min(need, self.length - used)
            pieces = self.open[i][1]
            pieces.append((doc_id, start, ids[: 4 * take], doc_tokens))
            if used + take == self.length:
                del self.open[i]
                self.emit(pieces)
            else:
                self.open[i] = (used + take, pieces)
            start, ids = start + take, ids[4 * take :]


_SCHEMA = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, `offset` long, ids binary, `leftover` boolean")


def _rows(sequences: list[tuple[int, list]], leftover: bool, keep_ids: bool) -> pa.RecordBatch:
    out: list[tuple] = []
    for sequence, pieces in sequences:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            out.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, sequence, offset,
                        ids if keep_ids or leftover else None, leftover))
            offset += n
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             "ids", "leftover"]
    kinds = [None, *[pa.int64()] * 6, pa.binary(), pa.bool_()]
    return names, kinds, (list(zip(*out)) if out else [[] for _ in names])


def _batch(made: tuple, id_type: pa.DataType) -> pa.RecordBatch:
    names, kinds, columns = made
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k or id_type) for c, k in zip(columns, kinds)], names)


def pack(docs: DataFrame, path: str, length: int = LENGTH, most_open: int = OPEN_WINDOWS,
         text_col: str = "text", id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    `ids` (little-endian, 32 bits each) is null unless `keep_ids`. `path` is a tokenizer file
    that every executor can open.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = _SCHEMA.format(id=plain.schema["doc_id"].dataType.simpleString())

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, most_open, TaskContext.get().partitionId() << 28)
        encode, end = encoder(path).encode, np.array([END_ID], "<u4").tobytes()
        id_type = None
        for part in in_slices(batches, "text"):
            id_type = part.column("doc_id").type
            for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                    part.column("text").to_pylist()):
                ids = encode(text or "") + end
                packer.add(doc_id, 0, ids, len(ids) // 4)
            yield _batch(_rows(packer.full, False, keep_ids), id_type)
            packer.full = []
        if packer.open:
            key = TaskContext.get().partitionId() << 28
            left = [(key + i, pieces) for i, (_, pieces) in enumerate(packer.open)]
            yield _batch(_rows(left, True, keep_ids), id_type)

    def written(df: DataFrame, name: str) -> DataFrame:
        where = fresh_path(spark, name)
        df.write.option("compression", "zstd").parquet(where)
        return spark.read.schema(schema).parquet(where)

    tables = [written(plain.mapInArrow(first_round, schema), "pack")]
    groups = int(tables[0].where("leftover").agg(
        F.coalesce(F.max(F.col("sequence_id") / (1 << 28)), F.lit(0))).first()[0]) + 1
    number = 0
    while groups > 1 or number == 0:
        groups, number = -(-groups // FAN_IN), number + 1
        last = groups == 1

        def later_round(batches: Iterator[pa.RecordBatch], number: int = number,
                        last: bool = last) -> Iterator[pa.RecordBatch]:
            first_id = number << 56 | TaskContext.get().partitionId() << 28
            packer = Packer(length, most_open, first_id)
            id_type = None
            for batch in batches:
                id_type = batch.column("doc_id").type
                for row in zip(*(batch.column(c).to_pylist()
                                 for c in ("doc_id", "start", "ids", "doc_tokens"))):
                    packer.add(*row)
            if last:
                for _, pieces in packer.open:
                    packer.emit(pieces)
                packer.open = []
            if id_type is not None:
                yield _batch(_rows(packer.full, False, keep_ids), id_type)
                left = [(first_id + i, pieces) for i, (_, pieces) in enumerate(packer.open)]
                yield _batch(_rows(left, True, keep_ids), id_type)

        left = tables[-1].where("leftover")
        task = F.shiftright("sequence_id", 28).bitwiseAND((1 << 28) - 1)
        dealt = left.repartition(groups, (task / FAN_IN).cast("long"))
        dealt = dealt.sortWithinPartitions("sequence_id", "offset")
        tables.append(written(dealt.mapInArrow(later_round, schema), "pack"))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.where("not leftover").drop("leftover")
