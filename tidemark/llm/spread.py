"""Joins in which no task gets all rows of a frequent key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 1024  # a key with more than 1/SHARE of all rows is frequent, so fewer than SHARE keys are


def frequent(size: Column, total: Column) -> Column:
    return size * SHARE > total


def join_spread(rows: DataFrame, side: DataFrame, key: str, size: str,
                total: int | Column) -> DataFrame:
    """Inner join of `rows` with `side`, which holds one row for each key.

    The column `size` of `side` (left out of the result) says how many of the `total` rows have
    the key. Rows of frequent keys stay where they are: the fewer than SHARE rows of `side` for
    them are broadcast. Only the others are shuffled, and no key of them has more than 1/SHARE of
    all rows.
    """
    total = F.lit(total) if isinstance(total, int) else total
    many = frequent(F.col(size), total)
    hot = F.broadcast(side.where(many).drop(size))
    cold = side.where(~many).drop(size)
    others = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(others.join(cold, key))
