"""Missing values: fill values are fitted once and applied as literals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, is_numeric, missing, number, present
from holdfast.functions.selection import exact_quantiles
from holdfast.operators.base import FittedOperator, pick
from holdfast.operators.neighbours import knn_fill
from holdfast.session import stage


def _fill(df: DataFrame, values: dict) -> DataFrame:
    filled = {}
    for name, value in values.items():
        if value is None or name not in df.columns:
            continue
        if is_numeric(df, name):
            kind = "double" if isinstance(value, float) else df.schema[name].dataType
            filled[name] = F.when(missing(df, name), F.lit(value).cast(kind)).otherwise(column(name).cast(kind))
        else:
            filled[name] = F.coalesce(column(name), F.lit(value))
    return df.withColumns(filled) if filled else df


class MeanImputer(FittedOperator):
    kind = "impute_mean"

    def __init__(self, columns: list[str]):
        super().__init__(columns=columns)

    def learn(self, df: DataFrame) -> dict:
        names = present(df, self.options["columns"])
        if not names:
            return {}
        row = df.agg(*[F.avg(number(df, n)).alias(f"m{i}") for i, n in enumerate(names)]).first()
        return {n: row[i] for i, n in enumerate(names)}

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        return _fill(df, state)


class MedianImputer(MeanImputer):
    """Exact median; an even number of values gives the middle of the two."""

    kind = "impute_median"

    def learn(self, df: DataFrame) -> dict:
        names = present(df, self.options["columns"])
        found = exact_quantiles(df, {n: number(df, n) for n in names}, [0.5])
        return {n: q[0] for n, q in found.items()}


class ModeImputer(MeanImputer):
    """Most frequent value, the smallest one on a tie.

    Counting by value spreads over the cluster; the ``mode`` aggregate would
    hold all distinct values of a column in one buffer.
    """

    kind = "impute_mode"

    def learn(self, df: DataFrame) -> dict:
        state = {}
        for n in present(df, self.options["columns"]):
            top = (df.where(~missing(df, n)).groupBy(column(n).alias("value")).count()
                   .orderBy(F.desc("count"), F.asc("value")).limit(1).collect())
            if top:
                state[n] = top[0]["value"]
        return state


class KnnImputer(FittedOperator):
    """Mean of the nearest donors; the fitted state points at the donor table."""

    kind = "impute_knn"

    def __init__(self, columns: list[str], neighbours: int = settings.NEIGHBOURS):
        super().__init__(columns=columns, neighbours=neighbours)

    def learn(self, df: DataFrame) -> dict:
        names = present(df, self.options["columns"])
        means = MeanImputer(names).fit(df).state
        if len(names) > 1:
            self.tables = {"donors": stage(df.select(*[number(df, n).alias(n) for n in names]), "donors")}
        return {"columns": names, "means": means}

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        names = state["columns"]
        # With one column no distance exists, so every gap gets the column mean.
        if len(names) > 1:
            df = knn_fill(df, self.tables["donors"], names, self.options["neighbours"])
        return _fill(df, state["means"])


STRATEGIES = {"mean": MeanImputer, "median": MedianImputer, "mode": ModeImputer, "knn": KnnImputer}


def create_imputer(name: str, columns: list[str], neighbours: int = settings.NEIGHBOURS) -> FittedOperator:
    cls = pick(STRATEGIES, name, "imputation strategy")
    return cls(columns, neighbours) if cls is KnnImputer else cls(columns)


class MissingValueHandler(FittedOperator):
    """One strategy for the numeric columns, the mode for the categorical ones."""

    kind = "missing_values"

    def __init__(self, strategy: str = "median", numeric: list[str] | None = None,
                 categorical: list[str] | None = None, neighbours: int = settings.NEIGHBOURS):
        numeric = settings.IMPUTED_COLUMNS if numeric is None else numeric
        super().__init__(strategy=strategy, numeric=list(numeric), categorical=list(categorical or []),
                         neighbours=neighbours)
        self.parts = [create_imputer(strategy, list(numeric), neighbours), ModeImputer(list(categorical or []))]

    def learn(self, df: DataFrame) -> dict:
        state = {"numeric": self.parts[0].learn(df), "categorical": self.parts[1].learn(df)}
        self.tables = self.parts[0].tables
        return state

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        self.parts[0].tables = self.tables
        df = self.parts[0].apply(df, state["numeric"])
        return self.parts[1].apply(df, state["categorical"])
