"""Bounded top-k and totals, with or without partition keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    by: Sequence[str] = (),
    rank: str = "rank",
) -> DataFrame:
    """First ``k`` rows in ``order`` (per key of ``by``), numbered from 1.

    Without keys this is a top-k per task and a merge of k-row lists; the row
    number then runs over k rows only. With keys, Spark drops rows beyond rank
    k before the shuffle, so a hot key sends k rows per task.
    """
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def attach_total(
    df: DataFrame, source: DataFrame, total: Column, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add an aggregate over all of ``source`` (per key of ``by``) to each row."""
    if by:
        return df.join(source.groupBy(*by).agg(total.alias(name)), list(by))
    return df.withColumn(name, source.agg(total.alias(name)).scalar())


def whole_frame(df: DataFrame, aggregates: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Aggregate per key, or over everything but without a row for no input."""
    if by:
        return df.groupBy(*by).agg(*aggregates)
    rows = F.count(F.lit(1)).alias("_rows")
    return df.agg(*aggregates, rows).where("_rows > 0").drop("_rows")
