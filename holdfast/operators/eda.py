"""Distributions and rates: the numbers behind the exploratory charts."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.expressions import column, label_text, missing, number
from holdfast.functions.selection import exact_quantiles, group_quantiles, sent_if_few
from holdfast.session import stage

#: Parts of a group whose densities are added up by different tasks, and values that one step spreads over the grid.
PARTS, AT_ONCE = 32, 4096


def _grouped(df: DataFrame, name: str, by: str) -> DataFrame:
    """``category, name, value`` of the rows with both; ``name`` is the category as text."""
    return df.where(~missing(df, by)).select(
        column(by).alias("category"), column(by).cast("string").alias("name"), number(df, name).alias("value")).where("value IS NOT NULL")


def _classes(rows: DataFrame, keys: list[str], sums: list[Column]) -> DataFrame:
    """``keys``, ``category`` and the sums of each class; the least of texts would have Spark sort all rows, and a text is its own name."""
    if rows.schema["category"].dataType == T.StringType():
        return rows.groupBy(*keys).agg(*sums).withColumn("category", F.col("name"))
    return rows.groupBy(*keys).agg(F.min("category").alias("category"), *sums)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label_text, n, pct, imbalance_ratio): share of each class and majority to minority."""
    counts = df.groupBy(label_text(column(label)).alias("label_text")).count()
    # Windows run over the two or three aggregated rows.
    every = Window.partitionBy()
    known = F.when(F.col("label_text").isNotNull(), F.col("count"))
    return counts.select("label_text", F.col("count").alias("n"),
                         (F.col("count") / F.sum("count").over(every) * 100).alias("pct"),
                         (F.max(known).over(every) / F.min(known).over(every)).alias("imbalance_ratio"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n), most frequent first; missing values are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.when(~missing(df, c), column(c).cast("string")).alias("value")) for c in columns])
    return (df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value")
            .agg(F.count("*").alias("n")).orderBy("column", F.desc("n"), "value"))


def rate_by(df: DataFrame, by: str, label: str) -> DataFrame:
    """(category, n, rate_pct, overall_pct), highest rate first."""
    y = number(df, label)
    overall = df.agg(F.avg(y) * 100).scalar()
    return (df.where(column(by).isNotNull()).groupBy(column(by).alias("category"))
            .agg(F.count(y).alias("n"), (F.avg(y) * 100).alias("rate_pct"))
            .withColumn("overall_pct", overall).orderBy(F.desc("rate_pct"), "category"))


def rates_by_two(df: DataFrame, rows: str, columns: str, label: str) -> DataFrame:
    """(row, column, n, rate_pct): label rate in percent by two categories, of any number of values."""
    return (df.where(column(rows).isNotNull() & ~missing(df, columns))
            .groupBy(column(rows).alias("row"), column(columns).alias("column"))
            .agg(F.count(number(df, label)).alias("n"), (F.avg(number(df, label)) * 100).alias("rate_pct")))


def rate_pivot(df: DataFrame, rows: str, columns: str, label: str, values: list | None = None) -> DataFrame:
    """Label rate in percent by two categories, the second one as columns.

    Each of its values is a column, so the driver has to know them all; without
    that, ``rates_by_two`` has the same rates as rows.
    """
    if values is None:
        values = sorted(r[0] for r in df.where(~missing(df, columns)).select(column(columns)).distinct().collect())
    return (df.where(column(rows).isNotNull()).groupBy(column(rows).alias(rows)).pivot(columns, values)
            .agg(F.avg(number(df, label)) * 100))


def histogram(df: DataFrame, name: str, bins: int = 40) -> DataFrame:
    """(bin, low, high, n, mean, median) over equal bins, left-closed but for the last."""
    x = number(df, name)
    low, high, mean = df.agg(F.min(x), F.max(x), F.avg(x)).first()
    if low is None:
        raise ValueError(f"{name!r} has no values")
    median = exact_quantiles(df, {name: x}, [0.5])[name][0]
    if low == high:
        low, high = low - 0.5, high + 0.5
    edges = [float(e) for e in np.linspace(low, high, bins + 1)]
    at = F.array(*[F.lit(e) for e in edges])
    guess = F.least(F.floor((x - F.lit(low)) / F.lit(high - low) * bins).cast("int"), F.lit(bins - 1))
    # The quotient may land one bin off next to an edge; the edges decide.
    lower = guess - (x < F.get(at, guess)).cast("int")
    bin_no = lower + ((x >= F.get(at, lower + 1)) & (lower < bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("bin"), F.lit(edges[i]).alias("low"), F.lit(edges[i + 1]).alias("high"))
        for i in range(bins)])))
    return grid.join(counts, "bin", "left").select(
        "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"), F.lit(mean).alias("mean"),
        F.lit(median).alias("median"))


def box_stats(df: DataFrame, name: str, by: str, factor: float = 1.5) -> DataFrame:
    """(category, n, q1, median, q3, whisker_low, whisker_high, n_fliers) per class, of any number of classes."""
    rows = _grouped(df, name, by)
    q = F.col("quantiles")
    marks = group_quantiles(rows.select("name", "value"), [0.25, 0.5, 0.75]).select(
        "name", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"))
    x, reach = F.col("value"), factor * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    found = _classes(rows.join(sent_if_few(stage(marks, "marks")), "name"), ["name", "q1", "median", "q3"], [
        F.count("*").alias("n"), F.min(F.when(x >= low, x)).alias("low"),
        F.max(F.when(x <= high, x)).alias("high"), F.count_if((x < low) | (x > high)).alias("n_fliers")])
    return found.select("category", "n", "q1", "median", "q3", F.least("low", "q1").alias("whisker_low"),
                        F.greatest("high", "q3").alias("whisker_high"), "n_fliers")


def kernel_density(df: DataFrame, name: str, by: str, points: int = 1000, margin: float = 0.5) -> DataFrame:
    """(category, i, x, density): Gaussian kernel, Scott's bandwidth, on an even grid per class.

    The grid reaches ``margin`` times the range beyond both ends.  Equal values
    are counted first; each task then adds up the values of one part of a class
    after another into one density sum per grid point, so no row is paired with
    the grid in a table and no task holds a class.
    """
    rows = _grouped(df, name, by)
    stats = stage(_classes(rows, ["name"], [
        F.count("*").alias("n"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("least"), F.max("value").alias("most")]), "classes")
    flat = stats.where("std IS NULL OR std = 0").select("category").first()
    if flat is not None:
        raise ValueError(f"{name!r} does not vary within {by} = {flat[0]!r}")
    reach = margin * (F.col("most") - F.col("least"))
    grid = stats.select("name", "category", "n", (F.col("least") - reach).alias("first"),
                        ((F.col("most") - F.col("least") + 2 * reach) / (points - 1)).alias("step"),
                        (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("width"))
    counts = rows.groupBy("name", "value").agg(F.count("*").alias("w"))
    part = F.pmod(F.xxhash64("value"), F.lit(PARTS)).cast("int")
    placed = counts.join(sent_if_few(grid.select("name", "first", "step", "width")), "name").withColumn("part", part)
    dealt = placed.repartition("name", "part").sortWithinPartitions("name", "part").select(
        "name", "value", "w", "first", "step", "width")

    def add_up(batches):
        """One row of sums for each class of the partition; classes come one after another."""
        last, sums = None, None
        for batch in batches:
            for group, rows in batch.groupby("name", sort=False):
                if group != last:
                    if last is not None:
                        yield pd.DataFrame({"name": [last], "sums": [sums]})
                    last, sums = group, np.zeros(points)
                at = rows["first"].iloc[0] + np.arange(points) * rows["step"].iloc[0]
                values, weights = rows["value"].to_numpy(), rows["w"].to_numpy(dtype=float)
                for k in range(0, len(values), AT_ONCE):
                    z = (at[:, None] - values[None, k:k + AT_ONCE]) / rows["width"].iloc[0]
                    sums += np.exp(-0.5 * z * z) @ weights[k:k + AT_ONCE]
        if last is not None:
            yield pd.DataFrame({"name": [last], "sums": [sums]})

    sums = dealt.mapInPandas(add_up, "name string, sums array<double>")
    total = sums.select("name", F.posexplode("sums").alias("i", "s")).groupBy("name", "i").agg(F.sum("s").alias("s"))
    return total.join(grid, "name").select(
        "category", "i", (F.col("first") + F.col("i") * F.col("step")).alias("x"),
        (F.col("s") / (F.col("n") * F.col("width") * math.sqrt(2 * math.pi))).alias("density"))


def violin_stats(df: DataFrame, name: str, by: str, points: int = 100) -> DataFrame:
    """(category, i, x, density, low, median, high): density between the extremes, with the median."""
    rows, q = _grouped(df, name, by), F.col("quantiles")
    marks = group_quantiles(rows.select("name", "value"), [0.0, 0.5, 1.0]).select(
        F.col("name").alias("_name"), q[0].alias("low"), q[1].alias("median"), q[2].alias("high"))
    density = kernel_density(df, name, by, points, margin=0.0)
    return density.join(marks, F.col("category").cast("string") == F.col("_name")).drop("_name")
