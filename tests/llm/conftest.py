import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def documents(spark, tmp_path_factory):
    """Writes rows of documents as a table, with columns that could clash, and reads it."""
    made = []

    def write(rows):
        path = str(tmp_path_factory.mktemp("docs") / f"d{len(made)}")
        made.append(path)
        df = spark.createDataFrame(
            rows, "doc_id long, text string").withColumns({
                "lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"),
                "row": F.lit(None).cast("string"), "score": F.lit("x"), "node": F.lit(1.5)})
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write


def numbered(df):
    return df.withColumn("__row", F.monotonically_increasing_id())


#: Nulls, empty and blank texts, repeated rows, ties, one very long text.
AWKWARD = [(1, None), (2, ""), (3, "   "), (4, "\n\n"), (None, "a text without an id"),
           (5, "one"), (5, "one"), (6, "one"), (7, "two words"), (8, LONG), (9, LONG + " end"),
           (10, "Über straße 😀 naïve"), (11, None)]
