"""From raw documents to packed training sequences: five stages, each one operator of tidemark.llm.

A stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a frame
that is written as Parquet and read again as the next stage's documents. A stage's intermediates
and what it read are removed when its result is written. All stages but the last
return the columns of `documents`, whatever else those hold; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, line_dedup, packing, quality, suffix_dedup
from tidemark.llm.common import fresh_path, scratch, shuffles_removed, stored, table
from tidemark.llm.queries import tokenizer_path
from tidemark.sources.files import delete

_ROW = "__row"


def _numbered(docs: DataFrame) -> DataFrame:
    """`docs` with a number for each row, stored: a scan's own numbers change with its splits."""
    return stored(docs.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")


def _like(made: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return made.select(*[F.col(f"`{c}`") for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights, names=("__score", "__predicted"))
    return scored.where("__predicted = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is like; all documents stay."""
    return _like(line_dedup.dedup(_numbered(docs), _ROW), docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id (null is the largest)."""
    numbered = _numbered(docs)
    found = jaccard_join.near_duplicates(numbered, _ROW)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    kept = first.select(F.col("first.row").alias(_ROW))
    return numbered.join(kept, _ROW, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def unrepeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that occur more than once; all documents stay."""
    return _like(suffix_dedup.removed_text(_numbered(docs), _ROW), docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", distinct_lines),
    ("n-gram Jaccard join", distinct_documents),
    ("suffix-array dedup", unrepeated_text),
    ("packing", sequences),
]

#: A trained classifier and a tokenizer take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            with shuffles_removed(spark):
                made.select("*").write.option("compression", "zstd").parquet(path)
        if read is not None:
            delete(spark, read)
        docs, read = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
