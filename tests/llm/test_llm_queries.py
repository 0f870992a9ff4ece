"""The registered queries: all are there, and those with SQL agree with it."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference
from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry_module.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF_DIR), name, QUERIES[name], ORACLE[name], SF_DIR) is None


#: What each query must return at least, in Spark's names of the types.
COLUMNS = {
    1: "query_id bigint, rank int, vec_id bigint, score double",
    2: "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    3: "doc_id bigint, rank int, score double, n_pieces bigint, ids_crc32 bigint",
    4: "page_id bigint, url string, text string, n_chars bigint",
    5: "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
       "sequence_id bigint, offset bigint",
    6: "doc_id bigint, held_out boolean, score double, predicted int",
    7: "doc_id bigint, n_lines bigint, n_removed bigint, kept_lines string",
    8: "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double",
    9: "doc_id bigint, class_id bigint, group_id bigint, n_copies bigint, n_links bigint",
    10: "doc_id bigint, held_out boolean, score double, predicted int",
    11: "doc_id bigint, fingerprint string, component_id bigint",
    12: "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    13: "part string, filter_order string, step int, kept bigint, removed bigint, "
        "redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, "
        "shapley bigint",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_has_its_columns(spark, name):
    """The registered function runs over its whole table, with these columns and types."""
    df = QUERIES[name](spark, SF_DIR)
    want = [tuple(c.split()) for c in COLUMNS[int(name[2:].split("_")[0])].split(", ")]
    assert [(c, t) for c, t in df.dtypes if c in dict(want)] == want
    rows = df.count()
    table = {1: "embeddings", 4: "pages"}.get(int(name[2:].split("_")[0]), "documents")
    whole = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    one_each = {2, 4, 6, 7, 8, 9, 10, 11}
    assert rows == whole if int(name[2:].split("_")[0]) in one_each else rows > 0


def test_simhash_query_writes_hexadecimal_digits(spark):
    rows = QUERIES["op11_simhash"](spark, SF_DIR).collect()
    assert all(len(r.fingerprint) == 16 and int(r.fingerprint, 16) >= 0
               and r.fingerprint == r.fingerprint.lower() for r in rows)
    assert all(r.component_id <= r.doc_id for r in rows)
