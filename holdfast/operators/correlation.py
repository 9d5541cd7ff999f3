"""Pearson, Spearman and Kendall matrices with listwise removal of missing rows."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.expressions import column, number
from holdfast.functions.ordering import running_totals
from holdfast.session import stage


def _complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[number(df, c).alias(c) for c in columns]).dropna()


def correlation(df: DataFrame, columns: list[str], method: str = "spearman", slices: int | None = None) -> DataFrame:
    """(x, y, r) for every ordered pair of columns, the diagonal included."""
    methods = {"pearson": _pearson, "spearman": _spearman, "kendall": _kendall}
    if method not in methods:
        raise ValueError(f"unknown correlation method {method!r}; choose from {sorted(methods)}")
    pairs = methods[method](_complete(df, columns), columns, slices)
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"), "r"))
    same = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.lit(1.0).alias("r")) for c in columns])))
    return both.unionByName(same)


def label_correlation(df: DataFrame, columns: list[str], label: str, method: str = "spearman", **limits) -> DataFrame:
    """(x, r) against the label, strongest first."""
    matrix = correlation(df, [*columns, label], method, **limits)
    return (matrix.where((F.col("y") == label) & (F.col("x") != label)).select("x", "r")
            .orderBy(F.abs("r").desc(), "x"))


def _long(row: DataFrame, columns: list[str]) -> DataFrame:
    entries = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r"))
               for i, (a, b) in enumerate(combinations(columns, 2))]
    return row.select(F.inline(F.array(*entries)))


def _pearson(kept: DataFrame, columns: list[str], _slices: int | None) -> DataFrame:
    return _long(kept.agg(*[F.corr(column(a), column(b)).alias(f"r{i}")
                            for i, (a, b) in enumerate(combinations(columns, 2))]), columns)


def _ranked(cells: DataFrame, columns: list[str], slices: int | None) -> DataFrame:
    """``name, v, n, upto, rank`` of each value: its rows, the rows up to it, and its number among the values of its column."""
    values = F.array(*[F.struct(F.lit(str(i)).alias("name"), column(c).alias("v")) for i, c in enumerate(columns)])
    counts = cells.select("w", F.inline(values)).groupBy("name", "v").agg(F.sum("w").alias("n")).withColumn("one", F.lit(1).cast("bigint"))
    return stage(running_totals(stage(counts, "values"), [F.asc("v")], {"upto": "n", "rank": "one"}, "name", slices), "ranks")


def _placed(cells: DataFrame, columns: list[str], ranks: DataFrame, field: str) -> DataFrame:
    """Adds for the i-th column ``d{i}``, the ``field`` of its value's rank."""
    for i, c in enumerate(columns):
        mine = ranks.where(F.col("name") == str(i)).select(F.col("v").alias(f"v{i}"), F.col(field).alias(f"d{i}"))
        cells = cells.join(mine, column(c) == F.col(f"v{i}")).drop(f"v{i}")
    return cells


def _spearman(kept: DataFrame, columns: list[str], slices: int | None) -> DataFrame:
    """Pearson of average ranks, from counts per distinct value and per distinct row."""
    cells = stage(kept.groupBy(*columns).agg(F.count("*").alias("w")), "cells")
    rows = cells.agg(F.sum("w")).first()[0] or 0
    average = F.col("upto") - (F.col("n") - 1) / 2 - (rows + 1) / 2
    ranked = _placed(cells, columns, _ranked(cells, columns, slices).withColumn("average", average), "average")
    sums = [F.sum(F.col("w") * F.col(f"d{i}") * F.col(f"d{i}")).alias(f"s{i}") for i in range(len(columns))]
    pairs = list(combinations(range(len(columns)), 2))
    sums += [F.sum(F.col("w") * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"p{k}") for k, (i, j) in enumerate(pairs)]
    row = ranked.agg(*sums)
    return _long(row.select(*[F.try_divide(F.col(f"p{k}"), F.sqrt(F.col(f"s{i}")) * F.sqrt(F.col(f"s{j}")))
                              .alias(f"r{k}") for k, (i, j) in enumerate(pairs)]), columns)


def _kendall(kept: DataFrame, columns: list[str], slices: int | None) -> DataFrame:
    """tau-b of each pair of columns, from the bits of the ranks.

    Two ranks of the second column first differ at one bit; above it they agree.
    So the cells of each (bit, upper bits) are put in the order of the first
    column, and running totals of the weight with a 0 and with a 1 at that bit
    give the concordant and the discordant pairs: a 1 after a 0, and a 0 after a 1.
    Cells with equal ranks in the first column are one row, so ties count as
    neither.  All bits of all pairs are groups of one running total, which spreads
    a group of any size over many tasks.
    """
    cells = stage(kept.groupBy(*columns).agg(F.count("*").alias("w")), "cells")
    ranks = _ranked(cells, columns, slices)
    per = {int(r["name"]): r for r in ranks.groupBy("name").agg(
        F.max("rank").alias("values"), F.sum("n").cast("double").alias("rows"),
        F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("tied")).collect()}
    if not per:
        return kept.sparkSession.createDataFrame([(a, b, None) for a, b in combinations(columns, 2)], "x string, y string, r double")
    pairs = list(combinations(range(len(columns)), 2))
    # The column with fewer values has fewer bits.
    sides = [(i, j) if per[j]["values"] <= per[i]["values"] else (j, i) for i, j in pairs]
    entries = F.array(*[F.struct(F.lit(k).alias("pair"), F.col(f"d{i}").alias("x"), F.col(f"d{j}").alias("y"),
                                 F.lit(per[j]["values"].bit_length()).alias("bits")) for k, (i, j) in enumerate(sides)])
    placed = _placed(cells, columns, ranks, "rank").select("w", F.inline(entries))
    met = placed.groupBy("pair", "x", "y", "bits").agg(F.sum("w").alias("w"))
    levels = met.select("pair", "x", "y", "w", F.explode(F.expr("sequence(0, bits - 1)")).alias("level"))
    one = F.expr("shiftright(y, level) & 1")
    counts = levels.groupBy("pair", F.expr("concat_ws(':', pair, level, shiftright(y, level + 1))").alias("group"), "x").agg(
        F.sum(F.col("w") * one).alias("ones"), F.sum(F.col("w") * (1 - one)).alias("zeros"))
    summed = running_totals(stage(counts, "bits"), [F.asc("x")], {"ones_upto": "ones", "zeros_upto": "zeros"}, "group", slices)
    ones, zeros = F.col("ones").cast("double"), F.col("zeros").cast("double")
    balance = (F.col("zeros_upto") - F.col("zeros")) * ones - (F.col("ones_upto") - F.col("ones")) * zeros
    found = {r["pair"]: r["s"] for r in summed.groupBy("pair").agg(F.sum(balance).alias("s")).collect()}
    out = []
    for k, (i, j) in enumerate(pairs):
        every = per[i]["rows"] * (per[i]["rows"] - 1) / 2
        scale = ((every - per[i]["tied"]) * (every - per[j]["tied"])) ** 0.5
        out.append((columns[i], columns[j], found.get(k, 0.0) / scale if scale else None))
    return kept.sparkSession.createDataFrame(out, "x string, y string, r double")
