"""Published views: history of the runs, the latest copies that readers see, and documents.

A run writes each view once, below its own history folder. The latest copies are no files of their
own: a version of the log at ``{root}/{kind}/org=../source=..`` names the folders of the last run,
for all its views at once, so a reader never meets views of two runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fields import RAW_TABLES, VIEW_SCHEMAS, VIEWS
from ..operators.views import sort_view
from .manifest import Log, Snapshot, Written

# Views with a day column are laid out by day, so a window reads only its days.
_BY_DAY = {"daily_summary", "user_daily_summary", "language_summary"}


def log_root(root: str, kind: str, org: str, source: str) -> str:
    """Versions are kept per organization and source, so none replaces another's."""
    return f"{root}/{kind}/org={org}/source={source}"


def history_path(root: str, kind: str, org: str, source: str, run: str, name: str) -> str:
    return f"{log_root(root, kind, org, source)}/runs/run_id={run}/{name}"


def stage(
    name: str, df: DataFrame, root: str, org: str, source: str, run: str,
    kind: str = "views", fmt: str = "parquet",
) -> Written:
    """Write one frame to the run's history; readers do not see it before :func:`switch`."""
    if name not in (RAW_TABLES if kind == "raw" else VIEWS):
        raise ValueError(f"unknown {kind} table: {name}")
    by_day = fmt == "parquet" and (name in _BY_DAY or kind == "raw") and "day" in df.columns
    if fmt == "json" and kind == "views":
        df = sort_view(df, name)
    log = Log(df.sparkSession, log_root(root, kind, org, source))
    return log.write(df, name, fmt=fmt, layout="day" if by_day else None,
                     folder=f"runs/run_id={run}/{name}")


def switch(
    spark: SparkSession, staged: Mapping[str, Written], root: str, org: str, source: str, run: str,
    kind: str = "views",
) -> dict[str, dict[str, str]]:
    """Make staged frames the latest copies, all at once; gives the places of both."""
    log = Log(spark, log_root(root, kind, org, source))
    version = log.commit(lambda _: {name: w.table for name, w in staged.items()}, run)
    return {
        name: {"history": f"{log.root}/{w.table.parts[''].path}",
               "latest": f"{log.root}#{version.number}"}
        for name, w in staged.items()
    }


def publish(
    frames: Mapping[str, DataFrame],
    root: str,
    org: str,
    source: str,
    run: str,
    kind: str = "views",
    fmt: str = "parquet",
) -> dict[str, dict[str, str]]:
    """Write each frame to the run's history, then switch all latest copies to them.

    Publishing only adds files. A run that fails before all are written changes nothing that
    readers see.
    """
    for name in frames:
        if name not in (RAW_TABLES if kind == "raw" else VIEWS):
            raise ValueError(f"unknown {kind} table: {name}")
    staged = {n: stage(n, df, root, org, source, run, kind, fmt) for n, df in frames.items()}
    spark = next(iter(frames.values())).sparkSession
    return switch(spark, staged, root, org, source, run, kind)


def read_path(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """One written copy of a view, with its declared schema."""
    schema = VIEW_SCHEMAS[name]
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.names)


def latest(
    spark: SparkSession, roots: Sequence[str], org: str, source: str, kind: str = "views",
    number: int | None = None,
) -> Snapshot:
    """The latest copies of all views as of now (or of one version), from the first root with any.

    Views read from the result belong together, whatever is published meanwhile.
    """
    for root in roots:
        found = Log(spark, log_root(root, kind, org, source)).open(number)
        if found is not None:
            return found
    raise FileNotFoundError(f"no {kind} of {org}, {source} have been published yet")


def read_view(
    spark: SparkSession,
    name: str,
    roots: Sequence[str],
    org: str,
    source: str,
    fmt: str | None = None,
) -> DataFrame:
    """The latest copy of a known view, from the first root that has one.

    The version knows the format; one that is given must be the same.
    """
    if name not in VIEWS:
        raise ValueError(f"unknown view: {name}")
    for root in roots:
        found = Log(spark, log_root(root, "views", org, source)).open()
        if found is None or name not in found:
            continue
        table = found.version.tables[name]
        if fmt not in (None, table.format):
            raise ValueError(f"{name} is stored as {table.format}, not {fmt}")
        return found.read(name, schema=VIEW_SCHEMAS[name])
    raise FileNotFoundError(f"{name} has not been published yet")


def view_documents(
    views: Mapping[str, DataFrame], org: str | None, source: str, run: str, updated_at: str
) -> DataFrame:
    """Every view as document rows: one ``latest:`` and one ``run:`` id per view.

    The items stay rows (as JSON text, since the views differ in layout) and are
    not gathered into one array.
    """
    parts = []
    for name, df in views.items():
        ids = F.array(F.lit(f"latest:{name}"), F.lit(f"{run}:{name}"))
        item = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        parts.append(
            df.select(item.alias("item")).select(
                F.explode(ids).alias("id"),
                F.lit("dashboard-view").alias("document_type"),
                F.lit(org or "mock").alias("organization"),
                F.lit(source).alias("source"),
                F.lit(run).alias("run_id"),
                F.lit(updated_at).alias("updated_at"),
                F.lit(name).alias("view_type"),
                "item",
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Bytes of the items of one document, with a separator each.
DOCUMENT_BYTES = 1_000_000


def bounded_documents(
    views: Mapping[str, DataFrame], log: Log, org: str | None, source: str, run: str,
    updated_at: str, max_bytes: int = DOCUMENT_BYTES,
) -> DataFrame:
    """Every view as documents that hold its items in order and stay below a size.

    A view that fits is one document, as are its ids; else they are numbered, and each says how
    many there are. ``items`` is a JSON array as text. An item too large for a document is an
    error.

    The items of a view are written once, in order, as a table that no version names. A running
    count of bytes, from the sums of the parts and the rows within each, gives every item its
    place; half a document's size of places make a document, and one more item may begin in them.
    Items larger than that half are documents of their own.
    """
    parts = []
    for name, df in views.items():
        item = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        ordered = sort_view(df, name).select(
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
            item.alias("item"))
        items = log.staged(f"items_{name}", log.write(ordered, f"items_{name}"))
        parts.append(_cut(items, max_bytes).withColumn("view_type", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    many = F.when(F.col("total") > 1, F.concat(F.lit(":"), F.col("number"))).otherwise("")
    ids = F.array(*[F.concat(F.lit(f"{kind}:"), "view_type", many) for kind in ("latest", run)])
    return out.select(
        F.explode(ids).alias("id"),
        F.lit("dashboard-view").alias("document_type"),
        F.lit(org or "mock").alias("organization"),
        F.lit(source).alias("source"),
        F.lit(run).alias("run_id"),
        F.lit(updated_at).alias("updated_at"),
        "view_type", "number", "total", "item_count", "items",
    )


def _cut(items: DataFrame, max_bytes: int) -> DataFrame:
    """(number, total, item_count, items) from (part, at, item), in the order of ``at``."""
    half = max_bytes // 2
    size = F.octet_length("item").cast("bigint") + 1
    sized = items.withColumn("size", size)
    sums = sized.groupBy("part").agg(F.sum("size").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    offsets = sums.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    alone = F.when(F.col("size") > half, F.col("at")).otherwise(F.lit(-1))
    fits = F.when(F.col("size") < max_bytes, True).otherwise(F.raise_error(
        F.concat(F.lit(f"an item does not fit {max_bytes} bytes: "), F.col("size")))
        .cast("boolean"))
    placed = sized.join(offsets, "part").where(fits).select(
        F.floor(place / half).alias("block"), alone.alias("alone"), "at", "item")
    documents = placed.groupBy("block", "alone").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.array_sort(F.collect_list(F.struct("at", "item")))["item"].alias("items"))
    order = Window.orderBy("block", "alone")
    known = placed.select("block", "alone").distinct().select(  # a row a document
        "block", "alone", F.row_number().over(order).cast("bigint").alias("number"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("total"))
    return documents.join(known, ["block", "alone"]).select(
        "number", "total", "item_count",
        F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("items"))


def write_documents(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").partitionBy("view_type").parquet(path)


def record_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per artifact. Each count is one number per task."""
    out = None
    for name, df in frames.items():
        n = df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("artifact"), "records"
        )
        out = n if out is None else out.unionByName(n)
    return out
