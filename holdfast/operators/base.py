"""Fit on a frame, keep a small state, apply it as column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame


class NotFittedError(RuntimeError):
    pass


class FittedOperator:
    """``fit`` runs aggregates and keeps their few results; ``transform`` is lazy."""

    kinds: dict[str, type["FittedOperator"]] = {}
    kind = ""

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        if cls.kind:
            FittedOperator.kinds[cls.kind] = cls

    def __init__(self, **options):
        self.options = options
        self.state: dict | None = None
        # Fitted tables that may be too large for the state, by name.
        self.tables: dict[str, DataFrame] = {}

    def fit(self, df: DataFrame) -> "FittedOperator":
        self.state = self.learn(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.state is None:
            raise NotFittedError(f"{type(self).__name__} has to be fitted first")
        return self.apply(df, self.state)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def learn(self, df: DataFrame) -> dict:
        raise NotImplementedError

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        raise NotImplementedError

    def to_dict(self) -> dict:
        if self.state is None:
            raise NotFittedError(f"{type(self).__name__} has to be fitted first")
        return {"kind": self.kind, "options": self.options, "state": self.state}

    @staticmethod
    def from_dict(saved: dict) -> "FittedOperator":
        if not isinstance(saved, dict) or saved.get("kind") not in FittedOperator.kinds:
            raise TypeError("not a saved operator")
        operator = FittedOperator.kinds[saved["kind"]](**saved["options"])
        operator.state = saved["state"]
        return operator


def pick(table: dict, name: str, what: str):
    """Look a strategy up by its lower-cased name."""
    key = name.lower()
    if key not in table:
        raise ValueError(f"unknown {what} {name!r}; choose from {sorted(table)}")
    return table[key]
