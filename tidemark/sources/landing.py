"""Landed deliveries and the registry of their schemas.

    {root}/day=2025-01-31/delivery=0001/part-*.json

A delivery replaces earlier ones of its day; deliveries are ordered by name. Only the folders of
the wanted days are listed, and only their newest deliveries are opened.

The fields and types of a delivery are worked out once, in one pass over its text, when it is
registered; whoever reads it later takes the merged schema of the deliveries that they read, so
no read infers one. Types may widen (whole numbers to doubles, null to anything); other
differences are errors that name the field and the delivery.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import names
from .manifest import Log
from .ndjson import SchemaClash, merge_types, read_ndjson

# One row per file. The content column is never selected, so no file is opened.
FILES = ("path string, modificationTime timestamp, length bigint, content binary, "
         "day string, delivery string")
DELIVERIES = "day string, delivery string, files bigint, bytes bigint, schema string"


@dataclass(frozen=True)
class Delivery:
    """The newest delivery of a day, as listed; without a schema it has no rows."""

    day: str
    name: str
    files: int
    bytes: int
    schema: T.StructType | None = None

    def path(self, root: str) -> str:
        return f"{root}/day={self.day}/delivery={self.name}"

    def row(self) -> tuple:
        schema = None if self.schema is None else self.schema.json()
        return self.day, self.name, self.files, self.bytes, schema

    @staticmethod
    def of(row) -> Delivery:
        schema = None if row.schema is None else T.StructType.fromJson(json.loads(row.schema))
        return Delivery(row.day, row.delivery, row.files, row.bytes, schema)


def landed_days(spark: SparkSession, root: str) -> list[str]:
    """Days with a folder: one name a day, no files are listed."""
    return [n.removeprefix("day=") for n in names(spark, root) if n.startswith("day=")]


def newest(spark: SparkSession, root: str, days: Iterable[str]) -> list[Delivery]:
    """The newest delivery of each of some landed days, from the listing of their folders."""
    paths = [f"{root}/day={d}" for d in sorted(set(days))]
    if not paths:
        return []
    files = spark.read.format("binaryFile").option("basePath", root).schema(FILES).load(paths)
    each = files.groupBy("day", "delivery").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    last = each.groupBy("day").agg(F.max(F.struct("delivery", "files", "bytes")).alias("d"))
    return [Delivery(r.day, r.d.delivery, r.d.files, r.d.bytes)
            for r in last.orderBy("day").collect()]


_QUOTED = re.compile("(`(?:[^`]|``)*`)")


def _type_of(text: str, where: str) -> T.StructType:
    """The Spark type of a variant schema; a field of several types is a clash."""
    parts = _QUOTED.split(text)
    ddl = "".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts))
    return _plain(T.DataType.fromDDL(f"row {ddl}")["row"].dataType, where)


def _plain(kind: T.DataType, where: str) -> T.DataType:
    if isinstance(kind, T.VariantType):
        raise SchemaClash(f"{where}: values of several types")
    if isinstance(kind, T.DecimalType):  # fractions, and whole numbers beyond a long
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType, f"{where}[]"))
    if isinstance(kind, T.StructType):
        return T.StructType([
            T.StructField(f.name, _plain(f.dataType, f"{where}.{f.name}")) for f in kind.fields])
    return kind


def registered(spark: SparkSession, root: str, deliveries: Sequence[Delivery]) -> list[Delivery]:
    """Deliveries with their schemas: one pass over their text. A malformed line is an error."""
    if not deliveries:
        return []
    text = spark.read.option("basePath", root).schema("value string, day string, delivery string")
    lines = text.text([d.path(root) for d in deliveries]).where(F.trim("value") != "")
    found = lines.groupBy("day").agg(
        F.schema_of_variant_agg(F.parse_json("value")).alias("schema")).collect()
    schemas = {r.day: r.schema for r in found}
    return [
        Delivery(d.day, d.name, d.files, d.bytes,
                 _type_of(schemas[d.day], _where(root, d)) if d.day in schemas else None)
        for d in deliveries]


def _where(root: str, delivery: Delivery) -> str:
    return f"{root.rsplit('/', 1)[-1]} of {delivery.day}, delivery {delivery.name}"


def merged(root: str, deliveries: Iterable[Delivery]) -> T.StructType:
    """The common schema of deliveries; a clash names the later one."""
    schema = T.StructType()
    for d in sorted(deliveries, key=lambda d: (d.day, d.name)):
        if d.schema is not None:
            schema = merge_types(schema, d.schema, _where(root, d))
    return schema


def _readable(kind: T.DataType, known: T.DataType | None = None) -> T.DataType:
    """Fields that are null everywhere get their known type, or text."""
    if isinstance(kind, T.NullType):
        return known or T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind.fields])
    return kind


def scan(
    spark: SparkSession, root: str, deliveries: Sequence[Delivery], schema: T.StructType,
    known: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Rows of some deliveries by a merged schema: a field that one lacks is null there.

    With ``known`` only these fields are parsed. The day is that of the folder.
    """
    fields = [T.StructField(f.name, _readable(f.dataType, (known or {}).get(f.name)))
              for f in schema.fields
              if f.name not in ("day", "delivery") and (known is None or f.name in known)]
    columns = T.StructType([T.StructField("day", T.StringType()), *fields])
    filled = [d.path(root) for d in deliveries if d.schema is not None]
    if not filled:
        return spark.createDataFrame([], columns)
    read = read_ndjson(spark, filled, schema=T.StructType(
        [*fields, T.StructField("day", T.StringType()),
         T.StructField("delivery", T.StringType())]), base_path=root)
    return read.select(*[F.col(f"`{c}`") for c in columns.names])


class Registry:
    """Schemas of the newest deliveries of a landing root, versioned below ``home``."""

    def __init__(self, spark: SparkSession, root: str, home: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log, self.table = Log(spark, home), self.root.rsplit("/", 1)[-1]

    def known(self) -> dict[str, Delivery]:
        """What is registered: one entry a day."""
        version = self.log.open()
        if version is None or self.table not in version:
            return {}
        return {r.day: Delivery.of(r) for r in version.read(self.table).collect()}

    def window(self, days: int, end: dt.date | None = None) -> list[Delivery]:
        """The newest deliveries of the last ``days`` calendar days up to ``end``.

        ``end`` defaults to the last landed day. Deliveries that are new, or have other files
        than when they were registered, are registered first.
        """
        landed = landed_days(self.spark, self.root)
        if not landed:
            return []
        last = end or dt.date.fromisoformat(max(landed))
        first = str(last - dt.timedelta(days=days - 1))
        found = newest(self.spark, self.root, [d for d in landed if first <= d <= str(last)])
        known = self.known()

        def same(d: Delivery) -> bool:
            k = known.get(d.day)
            return k is not None and (k.name, k.files, k.bytes) == (d.name, d.files, d.bytes)

        new = registered(self.spark, self.root, [d for d in found if not same(d)])
        if new:
            known |= {d.day: d for d in new}
            merged(self.root, (known[d.day] for d in found))  # a clash is not registered
            rows = self.spark.createDataFrame([known[k].row() for k in sorted(known)], DELIVERIES)
            written = self.log.write(rows.coalesce(1), self.table)
            self.log.commit(lambda _: {self.table: written.table})
        return [known[d.day] for d in found]

    def read(self, deliveries: Sequence[Delivery]) -> DataFrame:
        return scan(self.spark, self.root, deliveries, merged(self.root, deliveries))
