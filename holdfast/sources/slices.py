"""Row slices by an explicit order; a Spark table has none of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.expressions import column, is_numeric
from holdfast.functions.ordering import row_numbers
from holdfast.functions.selection import order_statistics


def _cut(df: DataFrame, key: str, n: int, head: bool) -> DataFrame:
    k = column(key)
    if n <= 0:
        return df.where(F.lit(False)) if head else df
    if is_numeric(df, key):
        facts = df.agg(F.count("*").alias("rows"), F.count(k).alias("keys")).first()
        rows, keys = facts["rows"], facts["keys"]
        if n >= rows:
            return df if head else df.where(F.lit(False))
        if n > keys:
            raise ValueError(f"{key!r} is null in {rows - keys} rows, which have no order to cut the table at row {n}")
        if n == keys:
            return df.where(k.isNotNull()) if head else df.where(k.isNull())
        spot = order_statistics(df, {key: k}, {key: [n - 1]}, {key: keys})[(key, n - 1)]
        if spot.equal != 1:
            raise ValueError(f"{key!r} has to be unique to cut the table at row {n}")
        border = F.lit(spot.value)
        return df.where(k <= border) if head else df.where((k > border) | k.isNull())
    numbered = row_numbers(df, [k.asc_nulls_last()], "_position")
    test = F.col("_position") <= n if head else F.col("_position") > n
    return numbered.where(test).drop("_position")


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by ``key``.

    A numeric key becomes a filter on its n-th value, which reaches the scan;
    nothing is sorted.  Other keys are numbered first.  Rows without a key come
    last; a cut between them is refused.
    """
    return _cut(df, key, n, True)


def rows_after(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows but the first ``n``; with ``first_rows`` the two parts never overlap."""
    return _cut(df, key, n, False)


def number_batches(df: DataFrame, key: str, batch_size: int, slices: int | None = None) -> DataFrame:
    """Adds the 1-based ``batch_index`` of each block of ``batch_size`` rows in key order.

    A row without a key comes last; several such rows have no order and are refused.
    """
    if batch_size < 1:
        raise ValueError("batch_size has to be at least 1")
    if df.where(column(key).isNull()).limit(2).count() > 1:
        raise ValueError(f"{key!r} is null in several rows, which have no order")
    numbered = row_numbers(df, [column(key).asc_nulls_last()], "_position", slices)
    return numbered.withColumn("batch_index", F.floor((F.col("_position") - 1) / batch_size) + 1).drop("_position")
