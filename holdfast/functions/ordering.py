"""Row numbers and running totals over a whole table, or over each of its groups, slice by slice.

Rows are range-partitioned by their order and written once, with the number of
their slice.  A task adds up its own slice; what the slices before add up to
comes from a table with one row per slice.  Sampled borders keep the slices even
whatever the size of a group, and the same path serves every table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import stage

_SLICE, _INSIDE, _CARRY = "_slice", "_inside", "_carry"


def _sliced(df: DataFrame, order: list[Column], slices: int | None, inside: bool = False) -> DataFrame:
    """Written in slices that follow one another in ``order``; ``slices`` overrides how many there are."""
    ordered = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    added = {_SLICE: F.spark_partition_id()}
    if inside:
        ordered = ordered.sortWithinPartitions(*order)
        # The lower 33 bits of this id count the rows of a partition.
        added[_INSIDE] = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stage(ordered.withColumns(added), "slices")


def row_numbers(df: DataFrame, order: list[Column], name: str = "row_number", slices: int | None = None) -> DataFrame:
    """1-based position of each row; ``order`` has to be unique."""
    fixed = _sliced(df, order, slices, inside=True)
    # The window runs over one row per slice.
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = fixed.groupBy(_SLICE).agg(F.count("*").alias("n")).select(
        _SLICE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_CARRY))
    return fixed.join(F.broadcast(starts), _SLICE).withColumn(name, F.col(_CARRY) + F.col(_INSIDE) + 1).drop(_SLICE, _INSIDE, _CARRY)


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, str], by: str | None = None,
                   slices: int | None = None) -> DataFrame:
    """Adds a running sum for each ``{new column: bigint column}``; ``order`` has to be unique.

    With ``by`` the sums start afresh with each value of that column.  Its groups
    may have any size: a large one is spread over many slices.
    """
    groups = [F.col(by)] if by else []
    fixed = _sliced(df, [*groups, *order], slices)
    inside = Window.partitionBy(_SLICE, *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = fixed.withColumns({new: F.sum(old).over(inside) for new, old in totals.items()})
    # What earlier slices hold of the same group.  A group has a row per slice here, and a slice goes on with one group at most.
    earlier = Window.partitionBy(*groups).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = fixed.groupBy(_SLICE, *groups).agg(*[F.sum(old).alias(new) for new, old in totals.items()])
    carried = sums.select(F.col(_SLICE).alias("_at"), *[g.alias("_of") for g in groups], *[
        F.sum(new).over(earlier).alias(f"{_CARRY}{i}") for i, new in enumerate(totals)]).where(f"{_CARRY}0 IS NOT NULL")
    same = F.col(_SLICE) == F.col("_at")
    if by:
        same = same & F.col(by).eqNullSafe(F.col("_of"))
    out = within.join(F.broadcast(carried), same, "left")
    return out.withColumns({new: F.col(new) + F.coalesce(f"{_CARRY}{i}", F.lit(0)) for i, new in enumerate(totals)}).drop(
        _SLICE, "_at", "_of", *[f"{_CARRY}{i}" for i in range(len(totals))])
