"""Run registered queries against their SQL in DuckDB and compare all values."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def difference(spark, con, name, query, sql, sf_dir):
    """None if equal, else a short description of the first difference."""
    df = query(spark, sf_dir)
    got_types = {c: KINDS.get(t, t) for c, t in df.dtypes}
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = table(list(want_types), cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if got_types != want_types:
        wrong = {c: (t, want_types[c]) for c, t in got_types.items() if t != want_types[c]}
        return f"types {wrong}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference {a} / {b}"
    return None if got[1] else "no rows"


def main(sf_dir="/root/testdata/sf0.01", *only):
    from pyspark.sql import SparkSession

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as e

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, q in e.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        sql = e.oracle_sql().get(name)
        try:
            d = difference(spark, con, name, q, sql, sf_dir) if sql else "no SQL"
        except Exception as x:  # report and go on with the next query
            d = f"{type(x).__name__}: {str(x)[:600]}"
        bad += d is not None
        print(f"{'ok ' if d is None else 'BAD'} {name} {time.time() - start:.1f}s {d or ''}",
              flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
