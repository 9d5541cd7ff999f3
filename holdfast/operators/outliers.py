"""Outlier bounds, capping and row removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import clip, number, present
from holdfast.functions.selection import exact_quantiles
from holdfast.operators.base import FittedOperator, pick


def iqr_bounds(df: DataFrame, columns: list[str], factor: float = settings.IQR_FACTOR) -> dict:
    names = present(df, columns)
    quartiles = exact_quantiles(df, {n: number(df, n) for n in names}, [0.25, 0.75])
    bounds = {}
    for n, (q1, q3) in quartiles.items():
        if q1 is not None:
            spread = factor * (q3 - q1)
            bounds[n] = [q1 - spread, q3 + spread]
    return bounds


def z_bounds(df: DataFrame, columns: list[str], threshold: float = settings.Z_THRESHOLD) -> dict:
    """Mean plus and minus ``threshold`` sample standard deviations."""
    names = present(df, columns)
    if not names:
        return {}
    stats = []
    for i, n in enumerate(names):
        stats += [F.avg(number(df, n)).alias(f"m{i}"), F.stddev_samp(number(df, n)).alias(f"s{i}")]
    row = df.agg(*stats).first()
    return {n: [row[f"m{i}"] - threshold * row[f"s{i}"], row[f"m{i}"] + threshold * row[f"s{i}"]]
            for i, n in enumerate(names) if row[f"s{i}"] is not None}


METHODS = {"iqr": iqr_bounds, "zscore": z_bounds}
ACTIONS = ("cap", "remove")


def outlier_counts(df: DataFrame, bounds: dict) -> DataFrame:
    """(column, lower, upper, outliers) in one pass over the rows."""
    names = present(df, list(bounds))
    entries = F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(bounds[n][0]).alias("lower"), F.lit(bounds[n][1]).alias("upper"),
                 F.col(f"c{i}").alias("outliers")) for i, n in enumerate(names)])
    counted = df.agg(*[F.count_if((number(df, n) < bounds[n][0]) | (number(df, n) > bounds[n][1])).alias(f"c{i}")
                       for i, n in enumerate(names)])
    return counted.select(F.inline(entries))


def cap(df: DataFrame, bounds: dict) -> DataFrame:
    names = present(df, list(bounds))
    return df.withColumns({n: clip(number(df, n), *bounds[n]) for n in names}) if names else df


def remove(df: DataFrame, bounds: dict) -> DataFrame:
    """Keep the rows with every checked column inside its bounds; a missing value drops the row."""
    names = present(df, list(bounds))
    if not names:
        return df
    return df.where(reduce(lambda a, b: a & b, [number(df, n).between(*bounds[n]) for n in names]))


class OutlierHandler(FittedOperator):
    kind = "outliers"

    def __init__(self, method: str = "iqr", action: str = "cap", columns: list[str] | None = None,
                 factor: float = settings.IQR_FACTOR, threshold: float = settings.Z_THRESHOLD):
        pick(METHODS, method, "outlier method")
        if action not in ACTIONS:
            raise ValueError(f"unknown outlier action {action!r}; choose from {list(ACTIONS)}")
        columns = settings.OUTLIER_COLUMNS if columns is None else columns
        super().__init__(method=method, action=action, columns=list(columns), factor=factor, threshold=threshold)

    def learn(self, df: DataFrame) -> dict:
        o = self.options
        limit = o["factor"] if o["method"].lower() == "iqr" else o["threshold"]
        return METHODS[o["method"].lower()](df, o["columns"], limit)

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        return cap(df, state) if self.options["action"] == "cap" else remove(df, state)
