"""Exact quantiles and order statistics of any number of groups of any size.

Two scans of the input answer all groups at once:

1. One bounded sketch per group gives its size and a bracket around each wanted
   share of it.  Brackets are rows of a table and reach the values by a join on
   the group.
2. Values are counted by the stretch between the ends of brackets that they lie
   in, and those inside a bracket also one by one: an end has a stretch of its
   own, so a value that fills a third of a group is one row.

What is left, about a thousandth of the values for each share, is written and
summed up in order with ``running_totals``, so neither a task nor the driver
holds a group.  The counts prove each answer: should a sketch have misled, the
ranks that fell outside their bracket are looked for among all values of their
group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.ordering import running_totals
from holdfast.session import stage

#: Fineness of a sketch, and the share of a group by which a bracket reaches beyond the wanted one on both sides.
ACCURACY, REACH = 10_000, 0.0004
#: Up to so many values a group needs no bracket; all of them are counted one by one.
FEW = 10_000
#: Up to so many groups their table is sent to all tasks, so the rows of a large group need not meet in one.
SENT = 10_000


@dataclass(frozen=True)
class Position:
    """The value at a position, with the rows before it and the rows equal to it."""

    value: float
    below: int
    equal: int


def sketched(rows: DataFrame, shares: list[float], accuracy: int = ACCURACY, reach: float = REACH, few: int = FEW) -> DataFrame:
    """``name, n, lows, highs`` of each group of ``rows(name, value)``: brackets around ``shares`` of it; nulls are not values.

    An end that lies beyond the group, and each end of a small group, is null: the bracket is open there.
    """
    found = rows.where("value IS NOT NULL").groupBy("name").agg(
        F.count("*").alias("n"), F.percentile_approx("value", _ends(shares, reach), accuracy).alias("ends"))
    return _bracketed(found, shares, reach, few)


def _ends(shares: list[float], reach: float) -> list[float]:
    return [min(max(p + d, 0.0), 1.0) for p in shares for d in (-reach, reach)]


def _bracketed(found: DataFrame, shares: list[float], reach: float, few: int) -> DataFrame:
    large = F.col("n") > few
    lows = [F.when(large & F.lit(p - reach > 0), F.col("ends")[2 * i]) for i, p in enumerate(shares)]
    highs = [F.when(large & F.lit(p + reach < 1), F.col("ends")[2 * i + 1]) for i, p in enumerate(shares)]
    return found.select("name", "n", F.array(*lows).alias("lows"), F.array(*highs).alias("highs"))


def sent_if_few(groups: DataFrame) -> DataFrame:
    """A written table with a row per group, to be joined with the rows of all groups: sent to them unless it has many rows."""
    return F.broadcast(groups) if groups.limit(SENT + 1).count() <= SENT else groups


def _counted(rows: DataFrame, groups: DataFrame, shares: int, slices: int | None, few: bool = False) -> DataFrame:
    """``name, rank, value, below, equal``; the value is null where the rank lies outside its bracket."""
    value = F.col("value")
    low, high = ([F.col(c)[i] for i in range(shares)] for c in ("lows", "highs"))
    # Rises with the value, and is the same for two values only if no end lies between them or on one of them.
    stretch = reduce(lambda a, b: a + b, [F.coalesce((value > e).cast("int") + (value >= e).cast("int"), F.lit(0)) for e in [*low, *high]])
    # Open ends hold everything; the ends themselves are inside as well.
    inside = reduce(lambda a, b: a | b, [F.coalesce(value >= a, F.lit(True)) & F.coalesce(value <= b, F.lit(True)) for a, b in zip(low, high)])
    brackets = groups.select("name", "lows", "highs")
    brackets = F.broadcast(brackets) if few else sent_if_few(brackets)
    met = rows.where("value IS NOT NULL").join(brackets, "name").select(
        "name", stretch.alias("stretch"), F.when(inside, value).alias("value"))
    counts = stage(met.groupBy("name", "stretch", "value").agg(F.count("*").alias("equal")), "counts")
    summed = running_totals(counts, [F.col("stretch"), F.col("value")], {"upto": "equal"}, "name", slices)
    below = F.col("upto") - F.col("equal")
    hit = F.filter("ranks", lambda r: (r >= below) & (r < F.col("upto")))
    return summed.join(groups.select("name", "ranks"), "name").select(
        "name", F.explode(F.array_distinct(hit)).alias("rank"), "value", below.alias("below"), "equal")


def _open(groups: DataFrame, kind: str) -> DataFrame:
    """The same groups with one bracket, open at both ends."""
    end = F.array(F.lit(None).cast(kind))
    return groups.withColumns({"lows": end, "highs": end})


def positions(rows: DataFrame, groups: DataFrame, shares: int, slices: int | None = None) -> DataFrame:
    """``name, rank, value, below, equal`` of each wanted rank of each group.

    ``rows`` has ``name`` (not null) and a numeric ``value`` (null: no value; no
    NaN).  ``groups`` has the columns of ``sketched`` for that many ``shares``, and
    ``ranks``, an array of zero-based positions below ``n`` near those shares.
    """
    found = stage(_counted(rows, groups.where(F.size("ranks") > 0), shares, slices), "positions")
    missed = found.where("value IS NULL").groupBy("name").agg(F.collect_list("rank").alias("ranks"))
    if not missed.isEmpty():
        again = _counted(rows, _open(stage(missed, "missed"), rows.schema["value"].dataType.simpleString()), 1, slices)
        found = stage(found.where("value IS NOT NULL").unionByName(again), "positions")
    return found


def _spots(n: Column, probs: list[float]) -> Column:
    """The positions on both sides of each quantile, each once."""
    every = [f(F.lit(float(p)) * (n - 1)).cast("bigint") for p in probs for f in (F.floor, F.ceil)]
    return F.array_sort(F.array_distinct(F.array(*every)))


def group_quantiles(rows: DataFrame, probs: list[float], slices: int | None = None) -> DataFrame:
    """``name, n, quantiles``: linearly interpolated quantiles of each group of ``rows(name, value)`` that has values."""
    values = rows.where("value IS NOT NULL").select("name", F.col("value").cast("double").alias("value"))
    groups = stage(sketched(values, probs).withColumn("ranks", _spots(F.col("n"), probs)), "sketches")
    found = positions(values, groups, len(probs), slices).groupBy("name").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def quantile(p: float) -> Column:
        spot = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.floor(spot).cast("bigint"), F.ceil(spot).cast("bigint")
        a, b = F.element_at("at", low), F.element_at("at", high)
        # Weights of both ends, which is how engines interpolate; equal ends stay as they are.
        return F.when(a == b, a).otherwise((high - spot) * a + (spot - low) * b)

    return groups.select("name", "n").join(found, "name").select("name", "n", F.array(*map(quantile, probs)).alias("quantiles"))


def _stacked(df: DataFrame, targets: dict[object, Column]) -> tuple[DataFrame, list]:
    """One row per target and row; targets are known by their number."""
    names = list(targets)
    if len(names) == 1:
        return df.select(F.lit("0").alias("name"), targets[names[0]].alias("value")), names
    pairs = F.array(*[F.struct(F.lit(str(i)).alias("name"), targets[n].alias("value")) for i, n in enumerate(names)])
    return df.select(F.inline(pairs)).where("value IS NOT NULL"), names


def few_sketched(df: DataFrame, targets: list[Column], shares: list[float], accuracy: int = ACCURACY, reach: float = REACH,
                 few: int = FEW) -> DataFrame:
    """``sketched`` for a handful of expressions, known by their number, without a row for each of their values."""
    sums = [a for i, t in enumerate(targets) for a in (
        F.count(t).alias(f"n{i}"), F.percentile_approx(t, _ends(shares, reach), accuracy).alias(f"ends{i}"))]
    entries = [F.struct(F.lit(str(i)).alias("name"), F.col(f"n{i}").alias("n"), F.col(f"ends{i}").alias("ends")) for i in range(len(targets))]
    return _bracketed(df.agg(*sums).select(F.inline(F.array(*entries))).where("n > 0"), shares, reach, few)


def _few_positions(stacked: DataFrame, groups: list[tuple], shares: int, slices: int | None) -> list:
    """The rows of ``positions`` for a handful of groups, whose sketches are on the driver."""
    kind = stacked.schema["value"].dataType.simpleString()
    schema = f"name string, lows array<{kind}>, highs array<{kind}>, ranks array<bigint>"
    found = _counted(stacked, stacked.sparkSession.createDataFrame(groups, schema), shares, slices, few=True).collect()
    missed = {r["name"] for r in found if r["value"] is None}
    if missed:
        again = [(name, [None], [None], ranks) for name, _, _, ranks in groups if name in missed]
        found = [r for r in found if r["name"] not in missed] + _few_positions(stacked, again, 1, slices)
    return found


def order_statistics(df: DataFrame, targets: dict[object, Column], ranks: dict[object, list[int]],
                     rows: dict[object, int], slices: int | None = None) -> dict:
    """Values at zero-based positions of each target's sorted values.

    ``rows`` is the number of values per target; nulls are not values, and NaN
    must not occur.  Returns ``{(name, rank): Position}``.
    """
    for name, wanted in ranks.items():
        if wanted and not 0 <= min(wanted) <= max(wanted) < rows[name]:
            raise IndexError(f"position outside the {rows[name]} values of {name!r}")
    if not any(ranks.values()):
        return {}
    stacked, names = _stacked(df, {n: targets[n] for n, wanted in ranks.items() if wanted})
    shares = sorted({r / max(rows[n] - 1, 1) for n in names for r in ranks[n]})
    # A sketch and a few positions per target.
    groups = [(r["name"], r["lows"], r["highs"], sorted(set(ranks[names[int(r["name"])]]))) for r in few_sketched(df, [targets[n] for n in names], shares).collect()]
    return {(names[int(r["name"])], r["rank"]): Position(r["value"], r["below"], r["equal"])
            for r in _few_positions(stacked, groups, len(shares), slices)}


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probs: list[float],
                    slices: int | None = None) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several expressions.

    An expression without values gives None for each probability.
    """
    if not columns:
        return {}
    values = {n: F.when(~F.isnan(c.cast("double")), c.cast("double")) for n, c in columns.items()}
    stacked, names = _stacked(df, values)
    spots = {r["name"]: (r, [p * (r["n"] - 1) for p in probs]) for r in few_sketched(df, list(values.values()), probs).collect()}
    groups = [(name, r["lows"], r["highs"], sorted({k for s in at for k in (math.floor(s), math.ceil(s))}))
              for name, (r, at) in spots.items()]
    found = {(r["name"], r["rank"]): r["value"] for r in _few_positions(stacked, groups, len(probs), slices)} if groups else {}
    out: dict[str, list[float | None]] = {n: [None] * len(probs) for n in names}
    for name, (_, at) in spots.items():
        ends = [(found[name, math.floor(s)], found[name, math.ceil(s)], math.ceil(s) - s, s - math.floor(s)) for s in at]
        out[names[int(name)]] = [a if a == b else v * a + w * b for a, b, v, w in ends]
    return out
