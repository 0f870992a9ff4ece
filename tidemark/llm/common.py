"""Helpers that several operators share: tables, scratch space, label splits, batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import delete


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    made = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_open: list[list[str]] = []  # paths of each `scratch` that is entered


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _open:
        paths.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes in the end what was written below the shared folder by then.

    For steps whose results are written elsewhere by then: frames that read the rest are void.
    """
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open[:] = [p for p in _open if p is not paths]
        for path in paths:
            delete(spark, path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an execution whose frame is made inside go when it ends.

    Otherwise they stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame below the shared folder and reads it back, which cuts its lineage."""
    path = fresh_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.select("*").write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Writes a frame as a table bucketed by `key` below the shared folder and reads it back."""
    spark = df.sparkSession
    made = f"{name}_{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        (df.repartition(tasks(spark), key).write.bucketBy(tasks(spark), key)
         .option("compression", "zstd").option("path", fresh_path(spark, name)).saveAsTable(made))
    return spark.table(made)


def release(df: DataFrame) -> None:
    """Empties a table that `stored` has made, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        empty = df.sparkSession.createDataFrame([], df.schema)
        empty.write.mode("overwrite").parquet(folder)


def tasks(spark: SparkSession) -> int:
    """Number of partitions for shuffles that this package sizes itself."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def is_held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def least_text(text: Column) -> Column:
    """Of the texts of a group, the one with the least hash, found with partial aggregation."""
    return F.min(F.struct(F.xxhash64(text).alias("hash"), text.alias("text")))["text"]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(text, label) of at most `max_rows` labelled documents outside the held-out fold.

    Ids are taken in the order of a hash, and of a repeated id the text whose hash is least, so
    the sample is the same in each run and does not depend on how the tables are laid out.
    """
    picked = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()
               & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    one = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        least_text(F.col("text")).alias("text"), F.max("label").alias("label"))
    return one.select("doc_id", "text", "label")


def in_slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20,
              most_rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that one slice holds a few megabytes of `column`, or one row."""
    for batch in batches:
        values = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and (held + size > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def with_columns(df: DataFrame, added: str, text_col: str,
                 compute: Callable[[list[str | None]], list[pa.Array]]) -> DataFrame:
    """All columns of `df` and those that `compute` makes of the texts of a slice.

    `added` is DDL. A column of `df` with the name of an added one is replaced.
    """
    names = [part.split()[0] for part in added.split(",")]
    kept = [c for c in df.columns if c not in names]
    plain = df.select(*[F.col(f"`{c}`") for c in kept if c != text_col], F.col(f"`{text_col}`"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema] + [added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, text_col):
            made = compute(part.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *names])

    return plain.mapInArrow(run, schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys of a sorted stream."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(c[a] for c in columns)
            if key != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
