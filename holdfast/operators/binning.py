"""Quantile and equal-width bins with fitted edges."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import cut, number
from holdfast.functions.selection import exact_quantiles
from holdfast.operators.base import FittedOperator


@dataclass(frozen=True)
class BinConfig:
    col: str
    n_bins: int = 5
    strategy: str = "quantile"
    labels: list[str] | None = None


DEFAULT_BINS = [
    BinConfig("tenure", 5, "quantile", settings.TENURE_BIN_LABELS),
    BinConfig("MonthlyCharges", 4, "quantile", settings.CHARGE_BIN_LABELS),
]


def uniform_edges(low: float, high: float, bins: int) -> list[float]:
    """Equal steps; the first edge moves down by a thousandth of the range."""
    if low == high:
        widen = 0.001 * abs(low) if low else 0.001
        low, high = low - widen, high + widen
        shift = 0.0
    else:
        shift = 0.001 * (high - low)
    step = (high - low) / bins
    edges = [low + i * step for i in range(bins)] + [high]
    edges[0] -= shift
    return edges


def _shown(edge: float, digits: int) -> float:
    """With so many decimals; zeros right behind the point of a number below 1 do not count."""
    zeros = -math.floor(math.log10(abs(edge))) - 1 if 0 < abs(edge) < 1 else 0
    return float(np.round(edge, digits + zeros))


def interval_texts(edges: list[float]) -> list[str]:
    """``(a, b]`` texts with as few digits (3 or more) as keep the edges apart.

    The first bin holds its lower edge too, so that is shown one last digit lower.
    """
    for digits in range(3, 20):
        shown = [_shown(e, digits) for e in edges]
        if len(set(shown)) == len(edges):
            break
    else:
        digits, shown = 3, [_shown(e, 3) for e in edges]
    lows = [shown[0] - 10.0 ** -digits, *shown[1:-1]]
    return [f"({low}, {high}]" for low, high in zip(lows, shown[1:])]


class FeatureBinner(FittedOperator):
    """Adds ``{column}_bin``; the source column stays.  The state has the edges and the label of each bin."""

    kind = "binning"

    def __init__(self, bins: list[BinConfig | dict] | None = None, enabled: bool = True):
        self.bins = [b if isinstance(b, BinConfig) else BinConfig(**b)
                     for b in (DEFAULT_BINS if bins is None else bins)]
        super().__init__(bins=[asdict(b) for b in self.bins], enabled=enabled)

    def learn(self, df: DataFrame) -> dict:
        if not self.options["enabled"]:
            return {}
        usable = [b for b in self.bins if b.col in df.columns]
        edges: dict[str, list[float]] = {}
        uniform = [b for b in usable if b.strategy == "uniform"]
        if uniform:
            stats = []
            for i, b in enumerate(uniform):
                stats += [F.min(number(df, b.col)).alias(f"a{i}"), F.max(number(df, b.col)).alias(f"b{i}")]
            row = df.agg(*stats).first()
            for i, b in enumerate(uniform):
                if row[f"a{i}"] is not None:
                    edges[b.col] = uniform_edges(row[f"a{i}"], row[f"b{i}"], b.n_bins)
        quantile = [b for b in usable if b.strategy != "uniform"]
        if quantile:
            steps = sorted({i / b.n_bins for b in quantile for i in range(b.n_bins + 1)})
            found = exact_quantiles(df, {b.col: number(df, b.col) for b in quantile}, steps)
            for b in quantile:
                if found[b.col][0] is not None:
                    at = dict(zip(steps, found[b.col]))
                    edges[b.col] = sorted({at[i / b.n_bins] for i in range(b.n_bins + 1)})
        given = {b.col: b.labels or [] for b in usable}
        return {c: {"edges": e, "labels": given[c][:len(e) - 1] if len(given[c]) >= len(e) - 1 else interval_texts(e)}
                for c, e in edges.items()}

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        return df.withColumns({f"{c}_bin": cut(number(df, c), bins["edges"], bins["labels"])
                               for c, bins in state.items() if c in df.columns})
