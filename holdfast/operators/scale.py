"""Scalers; missing values are ignored in the fit and kept by the transform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import number, present
from holdfast.functions.selection import exact_quantiles
from holdfast.operators.base import FittedOperator, pick


class _Scaler(FittedOperator):
    """State is ``{column: [centre, width]}``; a width of 0 counts as 1."""

    def __init__(self, columns: list[str] | None = None):
        super().__init__(columns=list(settings.SCALED_COLUMNS if columns is None else columns))

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        names = present(df, list(state))
        scaled = {n: (number(df, n) - F.lit(state[n][0])) / F.lit(state[n][1] or 1.0) for n in names}
        return df.withColumns(scaled) if scaled else df

    def _two(self, df: DataFrame, first, second) -> dict:
        names = present(df, self.options["columns"])
        if not names:
            return {}
        stats = []
        for i, n in enumerate(names):
            stats += [first(number(df, n)).alias(f"a{i}"), second(number(df, n)).alias(f"b{i}")]
        row = df.agg(*stats).first()
        return {n: (row[f"a{i}"], row[f"b{i}"]) for i, n in enumerate(names) if row[f"a{i}"] is not None}


class StandardScaler(_Scaler):
    """Centre on the mean, divide by the population standard deviation."""

    kind = "scale_standard"

    def learn(self, df: DataFrame) -> dict:
        return {n: [mean, std] for n, (mean, std) in self._two(df, F.avg, F.stddev_pop).items()}


class MinMaxScaler(_Scaler):
    kind = "scale_minmax"

    def learn(self, df: DataFrame) -> dict:
        return {n: [low, high - low] for n, (low, high) in self._two(df, F.min, F.max).items()}


class RobustScaler(_Scaler):
    """Centre on the exact median, divide by the interquartile range."""

    kind = "scale_robust"

    def learn(self, df: DataFrame) -> dict:
        names = present(df, self.options["columns"])
        quartiles = exact_quantiles(df, {n: number(df, n) for n in names}, [0.25, 0.5, 0.75])
        return {n: [q[1], q[2] - q[0]] for n, q in quartiles.items() if q[1] is not None}


METHODS = {"standard": StandardScaler, "minmax": MinMaxScaler, "robust": RobustScaler}


def create_scaler(name: str, columns: list[str] | None = None) -> FittedOperator:
    return pick(METHODS, name, "scaling method")(columns)
