"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    filter_audit,
    fingerprint,
    html_text,
    jaccard_join,
    line_dedup,
    packing,
    pieces,
    quality,
    rp_forest,
    simhash,
    spelling,
    suffix_dedup,
    toxicity,
)
from tidemark.llm.common import is_held_out, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision of the quality classifier for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, weights).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision of the compression-distance classifier for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json")).drop("ids")


@query
def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likeness to these and the next."""
    return fingerprint.compared_with_next(table(spark, sf_dir, "documents"))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, group and number of links of every document (5-word n-grams, similarity 0.8)."""
    docs = numbered(table(spark, sf_dir, "documents"))
    return jaccard_join.near_duplicates(docs, "row").select(
        "doc_id", "class_id", "group_id", "n_copies", "n_links")


def numbered(docs: DataFrame) -> DataFrame:
    """Documents with the number `row`, stored: a scan's own numbers change with its splits."""
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                  "numbered")


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 200-byte strings."""
    docs = numbered(table(spark, sf_dir, "documents"))
    return docs.select("row", "doc_id").join(suffix_dedup.digests(docs, "row"), "row").drop("row")


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document, the numbers of its lines that stay, and how many go."""
    docs = numbered(table(spark, sf_dir, "documents"))
    kept = line_dedup.kept_lines(docs, "row")
    text = F.coalesce(F.col("text"), F.lit(""))
    worded = F.size(F.filter(F.split(text, "\n"), line_dedup.has_words)).cast("long")
    lines = docs.select("row", "doc_id", worded.alias("n_lines"))
    none = F.array().cast("array<int>")
    return lines.join(kept, "row", "left").select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size(F.coalesce("kept", none))).alias(
            "n_removed"),
        F.array_join(F.coalesce("kept", none).cast("array<string>"), ",").alias("kept_lines"))


ORACLE["op7_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS no
    FROM documents
), sets AS (
    SELECT doc_id, no, row_number() OVER (ORDER BY doc_id, no) AS id,
           list_sort(list_distinct([w FOR w IN string_split(translate(
               line, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' ') IF w <> ''])) AS words
    FROM lines
), worded AS (SELECT * FROM sets WHERE len(words) > 0
), classes AS (
    SELECT min(id) AS id, words, len(words) AS n FROM worded GROUP BY words
), tokens AS (SELECT id, n, unnest(words) AS word FROM classes
), gone AS (
    SELECT DISTINCT id FROM (
        SELECT b.id AS id
        FROM tokens a JOIN tokens b
          ON a.word = b.word AND a.id < b.id
         AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9
        GROUP BY a.id, b.id, a.n, b.n
        HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9)
), kept AS (
    SELECT w.doc_id, list(w.no ORDER BY w.no) AS nos
    FROM classes c JOIN worded w USING (id)
    WHERE c.id NOT IN (SELECT id FROM gone) GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(l.n, 0) AS n_lines,
       coalesce(l.n, 0) - coalesce(len(k.nos), 0) AS n_removed,
       coalesce(array_to_string(k.nos, ','), '') AS kept_lines
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id) l ON l.doc_id = d.doc_id
LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query
def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.fit(pages))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document: score, length and checksum of the ids."""
    docs = table(spark, sf_dir, "documents")
    found = pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", "rank", "score", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"), "round_trip")


@query
def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every vector whose id is divisible by 100."""
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of all documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders, by language."""
    return filter_audit.interactions(table(spark, sf_dir, "documents"),
                                     table(spark, sf_dir, "labels"))


ORACLE["op13_filter_audit"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
           min(doc_id) OVER (PARTITION BY text) AS least FROM docs
), known AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
    FROM labels GROUP BY doc_id
), flags AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           [len(w) < 100,
            100 * len(list_distinct(w)) < 80 * len(w),
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
            regexp_matches(text, '[#$%&*|]'),
            least IS NOT NULL AND (words.doc_id IS NULL OR words.doc_id > least)] AS f
    FROM words LEFT JOIN known ON known.doc_id = words.doc_id
), sets AS (
    SELECT part, good, toxic, f, count(*) AS n FROM flags GROUP BY ALL
), letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS i
), orders AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS o
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
    SELECT o, s.i AS step, o[s.i] AS own, o[1:s.i - 1] AS before FROM orders, letters s
), seen AS (
    SELECT part, good, toxic, n, f, step, own, f[own] AS fails,
           array_to_string([substr('ABCDE', x, 1) FOR x IN o], '') AS filter_order,
           len([x FOR x IN before IF f[x]]) > 0 AS gone, len([x FOR x IN f IF x]) AS failures
    FROM sets, steps
)
SELECT part, filter_order, step::INTEGER AS step,
       sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN fails AND failures = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN fails AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN fails AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN fails THEN n * 120 // failures ELSE 0 END)::BIGINT AS shapley
FROM seen GROUP BY part, filter_order, step
"""
