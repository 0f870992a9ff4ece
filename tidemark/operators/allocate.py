"""Weights, integer apportionment, classification, scores and calendar phases.

Groups may be of any size. All rows take the same way: one shuffle by group and cell, and windows
over these. A group with more than 1/``SHARE`` of all rows, of which there are fewer than ``SHARE``,
is cut into cells, ordered by rank and each about 1/``CUTS`` of all rows; its totals and the rows
before each cell come by broadcast, as they are few. Other groups are one cell. Nothing runs while
the plan is made.

That shuffle has as many partitions as the files read make up ``PART``, so that a task sorts about
as many rows however large they are; of small files, as many as the session sets.

Sums of weights are whole numbers: each weight is scaled by the largest exponent of its group, a
power of two, and cut into limbs of ``BITS`` bits. So they are exact to 2**-104 of the largest
weight, do not depend on the order of rows, and weights may have any scale.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fields import (
    AGENT_PHASES, BASELINE_PHASE, CHAT_LANGUAGES, DEFAULT_FEATURE, INFRA_LANGUAGES, PHASE_BANDS,
)
from ..functions.scalars import (
    active_review_signal, agent_signal, finite_number, passive_review_signal,
)
from ..sources.files import bytes_read

SHARE = 1024
CUTS = 1024  # over all large groups
_BLOCK = 32  # cuts compared at a time
PART = 2 << 20  # bytes of files for each partition of a shuffle
_MOST_PARTS = 1 << 14
BITS, _LIMBS = 26, ("_limb0", "_limb1", "_limb2", "_limb3")  # sums hold 2**35 rows of a group


def parts_of(df: DataFrame) -> int | None:
    """Partitions of a shuffle of `df`, by its files; None if the session's number is enough."""
    n = min(-(-bytes_read(df) // PART), _MOST_PARTS)
    return n if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(rows: DataFrame, n: int | None, keys: Sequence[str]) -> DataFrame:
    """`rows` by keys in `n` partitions, for an operator that needs them so; None leaves it to it."""
    return rows if n is None else rows.repartition(n, *keys)


def _exponent(weight: Column) -> Column:
    """Of the largest power of two below a weight (or one off); null for zero."""
    return F.when(weight != 0, F.floor(F.log2(F.abs(weight))).cast("int"))


def _scaled(weight: Column, exponent: Column) -> Column:
    """The weight over a power of two; in two steps, as that may be no double."""
    half = F.floor(exponent / 2)
    return weight * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - exponent)


def _limbs(scaled: Column) -> list[Column]:
    """Whole numbers of ``BITS`` bits, highest first, with the sign of the weight."""
    left, out = F.abs(scaled), []
    for _ in _LIMBS:
        left = left * float(1 << BITS)
        out.append((F.signum(scaled) * F.floor(left)).cast("bigint"))
        left = left - F.floor(left)
    return out


def _sum_of_limbs(limbs: Sequence[Column]) -> Column:
    """The sum as a double, scaled like the weights."""
    carry, lower = F.lit(0).cast("bigint"), F.lit(0.0)
    for limb in reversed(limbs[1:]):
        whole = limb + carry
        lower = (whole.bitwiseAND(F.lit((1 << BITS) - 1)) + lower) / float(1 << BITS)
        carry = F.shiftright(whole, BITS)
    return (limbs[0] + carry + lower) / float(1 << BITS)


def _share(scaled: Column, total: Column, n: Column) -> Column:
    return F.when(total > 0, scaled / total).otherwise(F.lit(1.0) / n)


def _with(rows: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Add the columns of a few rows, at most one for each key; null is a key like any other."""
    named = {k: f"_of_{i}" for i, k in enumerate(keys)}
    few = few.withColumnsRenamed(named)
    same = reduce(and_, [rows[k].eqNullSafe(few[n]) for k, n in named.items()])
    return rows.join(F.broadcast(few), same, how).drop(*named.values())


class _Large:
    """The groups with more than 1/SHARE of the rows, and what their rows need to know of them."""

    def __init__(self, rows: DataFrame, group: Sequence[str], position: str):
        self.rows, self.group, self.position = rows, list(group), position
        weighed = [F.max(_exponent(F.col("_w"))).alias("_e")] if "_w" in rows.columns else []
        sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *weighed)
        self.all_rows = sizes.agg(F.sum("_n")).scalar()
        self.known = sizes.where(F.col("_n") * SHARE > self.all_rows)

    def own_rows(self) -> DataFrame:
        return _with(self.rows, self.known, self.group, "inner")

    def add_sums(self) -> None:
        """``_s``, the scaled sum of weights."""
        limbs = _limbs(_scaled(F.col("_w"), F.coalesce("_e", F.lit(0))))
        sums = self.own_rows().groupBy(*self.group).agg(
            *[F.sum(limb).alias(name) for limb, name in zip(limbs, _LIMBS)])
        total = _sum_of_limbs([F.col(name) for name in _LIMBS])
        self._add(sums.select(*self.group, total.alias("_s")))

    def add_cuts(self, parts) -> None:
        """``_left``, what remains after the floors, and ``_cuts``, keys between the cells.

        A key is a cut if a hash of its position says so: the same in each evaluation.
        """
        chosen = F.pmod(F.xxhash64(self.position), self.all_rows) < CUTS
        rows = parts(self.own_rows()).withColumn("_cut", F.when(chosen, _key(self.position)))
        cuts = F.sort_array(F.collect_list("_cut"))
        self._add(rows.groupBy(*self.group).agg(
            (F.max("_total") - F.sum("_base")).alias("_left"), cuts.alias("_cuts")))

    def _add(self, found: DataFrame) -> None:
        self.known = _with(self.known, found, self.group, "inner")

    def rows_before(self, parts) -> DataFrame:
        """Rows of earlier cells, for each group and cell."""
        before = Window.partitionBy(*self.group).orderBy("_cell").rowsBetween(
            Window.unboundedPreceding, -1)
        rows = parts(self.own_rows()).withColumn("_cell", _cell(self.position))
        cells = rows.groupBy(*self.group, "_cell").agg(F.count(F.lit(1)).alias("_size"))
        return cells.select(*self.group, "_cell",
                            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))


def _key(position: str) -> Column:
    """Largest fraction first, then the smaller position."""
    return F.struct((-F.col("_frac")).alias("a"), F.col(position).alias("b"))


def _cell(position: str) -> Column:
    """How many cuts a row has passed: first in steps of a block, then within one; 0 without."""
    cuts, key = F.col("_cuts"), _key(position)
    heads = F.transform(F.sequence(F.lit(1), F.size(cuts), F.lit(_BLOCK)),
                        lambda i: F.element_at(cuts, i.cast("int")))
    blocks = F.size(F.filter(heads, lambda cut: cut <= key))
    block = F.slice(cuts, (blocks - 1) * _BLOCK + 1, F.lit(_BLOCK))
    inside = F.size(F.filter(block, lambda cut: cut <= key))
    passed = F.when(blocks > 0, (blocks - 1) * _BLOCK + inside).otherwise(F.lit(0))
    return F.when(F.size(cuts) > 0, passed).otherwise(F.lit(0)).cast("int")


def _weighed(items: DataFrame, weight: str, boost: Column | None) -> DataFrame:
    """``_w``: the boosted weight; null, NaN and infinite ones count as zero."""
    base = F.col(weight).cast("double")
    boosted = base if boost is None else base * F.coalesce(boost, F.lit(1.0))
    return items.withColumn("_w", finite_number(boosted))


def _with_shares(rows: DataFrame, cell: Window) -> DataFrame:
    """``share`` from the group's known sum, or else from the rows of the cell, its whole group."""
    largest = F.max(_exponent(F.col("_w"))).over(cell)
    exponent = F.coalesce("_e", largest, F.lit(0))
    rows = rows.withColumn("_x", _scaled(F.col("_w"), exponent))
    rows = rows.withColumns(dict(zip(_LIMBS, _limbs(F.col("_x")))))
    total = _sum_of_limbs([F.sum(name).over(cell) for name in _LIMBS])
    n = F.coalesce("_n", F.count(F.lit(1)).over(cell))
    rows = rows.withColumns({"_s": F.coalesce("_s", total), "_n": n})
    return rows.withColumn("share", _share(F.col("_x"), F.col("_s"), F.col("_n")))


_HELPERS = ["_w", "_x", "_e", "_s", "_n", "_cell", "_cuts", "_left", "_before", "_base", "_frac",
            "_total", *_LIMBS]


def normalised_weights(
    items: DataFrame,
    group: Sequence[str],
    weight: str,
    position: str,
    boost: Column | None = None,
) -> DataFrame:
    """Add ``share``: boosted weight over the group's sum, equal if that is not positive.

    Weights that are null, NaN or infinite count as zero. Negative ones enter the sum.
    """
    rows = _weighed(items, weight, boost)
    large = _Large(rows, group, position)
    large.add_sums()
    spread = F.pmod(F.xxhash64(position), F.lit(CUTS))
    rows = _with(rows, large.known, group).withColumn(
        "_cell", F.when(F.col("_s").isNotNull(), spread).otherwise(F.lit(0)))
    rows = dealt(rows, parts_of(items), [*group, "_cell"])
    return _with_shares(rows, Window.partitionBy(*group, "_cell")).drop(*_HELPERS)


def _parts(rows: DataFrame, total: str, share: str) -> DataFrame:
    """Floor and fraction of each item's part of the total."""
    amount = F.col(total).cast("bigint")
    raw = F.when(amount > 0, amount * F.col(share)).otherwise(F.lit(0.0))
    return (
        rows.withColumn("_raw", raw)
        .withColumn("_base", F.floor("_raw").cast("bigint"))
        .withColumn("_frac", F.col("_raw") - F.col("_base"))
        .withColumn("_total", F.greatest(F.coalesce(amount, F.lit(0)), F.lit(0)))
        .drop("_raw")
    )


def apportion(
    items: DataFrame,
    group: Sequence[str],
    total: str,
    share: str,
    position: str,
    out: str = "allotted",
) -> DataFrame:
    """Split each group's integer total by shares, largest remainders first.

    Every item gets the floor of its part; what is left goes one by one to the
    largest fractions, ties to the smaller ``position`` (an integer, unique in
    the group). A total that is not positive gives zeros. ``total`` is repeated
    on each row of the group.
    """
    def parts(rows: DataFrame) -> DataFrame:
        return _parts(rows, total, share)

    large = _Large(items, group, position)
    large.add_cuts(parts)
    rows = _with(items, large.known, group)
    rows = parts(rows).withColumn("_cell", _cell(position))
    rows = _with(rows, large.rows_before(parts), [*group, "_cell"])
    return _allotted(dealt(rows, parts_of(items), [*group, "_cell"]), group, position, out)


def apportion_by_weight(
    items: DataFrame,
    group: Sequence[str],
    total: str,
    weight: str,
    position: str,
    boost: Column | None = None,
    out: str = "allotted",
) -> DataFrame:
    """:func:`normalised_weights` and :func:`apportion` in one go, with one shuffle for both."""
    def parts(rows: DataFrame) -> DataFrame:
        scaled = _scaled(F.col("_w"), F.coalesce("_e", F.lit(0)))
        share = _share(scaled, F.col("_s"), F.col("_n"))
        return _parts(rows.withColumn("share", share), total, "share")

    rows = _weighed(items, weight, boost)
    large = _Large(rows, group, position)
    large.add_sums()
    large.add_cuts(parts)
    # of the other groups nothing is known yet, so they have no cuts and one cell
    rows = parts(_with(rows, large.known, group)).withColumn("_cell", _cell(position))
    rows = _with(rows.drop("share", "_base", "_frac", "_total"), large.rows_before(parts),
                 [*group, "_cell"])
    rows = dealt(rows, parts_of(items), [*group, "_cell"])
    shared = _with_shares(rows, Window.partitionBy(*group, "_cell"))
    return _allotted(_parts(shared, total, "share"), group, position, out)


def _allotted(rows: DataFrame, group: Sequence[str], position: str, out: str) -> DataFrame:
    """The floors, and one more for the first of each group; rows of other cells come before."""
    cell = Window.partitionBy(*group, "_cell")
    left = F.coalesce(F.col("_left"), F.col("_total") - F.sum("_base").over(cell))
    ranked = F.row_number().over(cell.orderBy(F.desc("_frac"), F.asc(position)))
    rank = F.coalesce(F.col("_before"), F.lit(0)) + ranked
    extra = (rank <= left).cast("bigint")
    return rows.withColumn(out, F.col("_base") + extra).drop(*_HELPERS)


def feature_of(language: Column, phase: Column) -> Column:
    """Feature label of a language in a phase."""
    agentic = language.isin(*INFRA_LANGUAGES) & phase.isin(*AGENT_PHASES)
    return (
        F.when(agentic, F.lit("chat_panel_agent_mode"))
        .when(language.isin(*CHAT_LANGUAGES), F.lit("chat_panel_ask_mode"))
        .otherwise(F.lit(DEFAULT_FEATURE))
    )


# Score from which each signal counts.
AGENT_SIGNAL_MIN = 10
ACTIVE_SIGNAL_MIN = 18
PASSIVE_SIGNAL_MIN = 10


def signal_scores(user_daily: DataFrame) -> DataFrame:
    """Engagement scores per user-day and whether they reach their threshold."""
    scores = {
        "agent": (agent_signal(), AGENT_SIGNAL_MIN),
        "active_review": (active_review_signal(), ACTIVE_SIGNAL_MIN),
        "passive_review": (passive_review_signal(), PASSIVE_SIGNAL_MIN),
    }
    return user_daily.select(
        "day", "user_login",
        *[c.alias(f"{n}_score") for n, (c, _) in scores.items()],
        *[(c >= least).alias(f"{n}_signal") for n, (c, least) in scores.items()],
    )


def phase_of(progress: Column) -> Column:
    phase = F.lit(BASELINE_PHASE)
    for name, low, high in PHASE_BANDS:
        phase = F.when((progress >= low) & (progress <= high), F.lit(name)).otherwise(phase)
    return phase


def calendar_phases(spine: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Weekday (Monday 0), weekend, progress through the period and phase per day."""
    days = spine.select(*by, "day").distinct()
    idx = F.row_number().over(Window.partitionBy(*by).orderBy("day")) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    weekday = F.weekday(F.col("day").cast("date"))
    return (
        days.withColumn("progress", idx / F.greatest(n - 1, F.lit(1)))
        .withColumn("weekday", weekday.cast("bigint"))
        .withColumn("is_weekend", F.col("weekday") >= 5)
        .withColumn("phase", phase_of(F.col("progress")))
    )
