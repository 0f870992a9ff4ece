"""NDJSON reports: scan, union under schema drift, and sink."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaClash(ValueError):
    """Two parts disagree on the type of a column."""


def read_ndjson(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    base_path: str | None = None,
) -> DataFrame:
    """Read one or more NDJSON paths as one frame; a malformed line fails the read.

    Without a schema it is inferred over all paths together, which costs a pass
    over the text, keeps absent columns absent, and gives null where a column is
    in some rows only. A declared schema saves the pass for known layouts.
    """
    reader = spark.read.option("mode", "FAILFAST").option("primitivesAsString", "false")
    if base_path:
        reader = reader.option("basePath", base_path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths if isinstance(paths, str) else list(paths))


_NUMBERS = (T.LongType, T.DoubleType)


def merge_types(a: T.DataType, b: T.DataType, where: str) -> T.DataType:
    """The common type of two columns; struct fields may differ, other types may only widen."""
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType) or a == b:
        return a
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType, f"{where}[]"))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        fields = [
            T.StructField(
                f.name, merge_types(f.dataType, other.pop(f.name, f.dataType), f"{where}.{f.name}")
            )
            for f in a.fields
        ]
        return T.StructType(fields + [T.StructField(n, t) for n, t in other.items()])
    raise SchemaClash(f"{where}: {a.simpleString()} and {b.simpleString()}")


def check_types(frames: Sequence[DataFrame]) -> None:
    """Fail early when parts disagree on a column's type."""
    reduce(lambda a, b: merge_types(a, b, "row"), [T.StructType(f.schema.fields) for f in frames])


def drift_union(frames: Sequence[DataFrame]) -> DataFrame | None:
    """Union by name; a column missing from a part is null there.

    No frames give none. A type clash is an error rather than a coercion.
    """
    if not frames:
        return None
    check_types(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, nulls written out, UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def json_array(df: DataFrame, order: Sequence[str], max_rows: int = 100_000) -> DataFrame:
    """A small frame as one JSON array text, for exports a browser loads whole.

    The array is one value in one task, so a frame beyond ``max_rows`` is refused.
    """
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows do not fit one JSON array")
    row = F.struct(*df.columns)
    key = F.struct(*order, row.alias("_row"))
    items = F.transform(F.array_sort(F.collect_list(key)), lambda x: x["_row"])
    return df.agg(F.to_json(items, {"ignoreNullFields": "false"}).alias("json"))
