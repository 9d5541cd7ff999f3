"""Data-quality aggregates; each report is one pass with a small result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, missing, number, present, round_to
from holdfast.functions.selection import exact_quantiles


def _unpivot(row: DataFrame, entries: list[Column]) -> DataFrame:
    return row.select(F.inline(F.array(*entries)))


def null_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """(column, null_count, null_pct), most affected column first."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(missing(df, c)).alias(f"c{i}")
                                               for i, c in enumerate(df.columns)])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("null_count"),
                        round_to(F.coalesce(F.try_divide(F.col(f"c{i}"), F.col("n")), F.lit(0.0)) * 100, 2)
                        .alias("null_pct")) for i, c in enumerate(df.columns)]
    report = _unpivot(counts, entries)
    if only_missing:
        report = report.where(F.col("null_count") > 0)
    return report.orderBy(F.desc("null_pct"), "column")


def total_nulls(df: DataFrame) -> DataFrame:
    """One row: the missing cells of the whole table."""
    cells = reduce(lambda a, b: a + b, [missing(df, c).cast("bigint") for c in df.columns])
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias("null_cells"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each set of identical rows."""
    return (df.groupBy(*[column(c) for c in df.columns]).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_rows")))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return (df.groupBy(column(key)).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_keys")))


def label_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
                  (F.avg(number(df, label)) * 100).alias("label_rate_pct"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, dtype, n_unique, sample); the sample is the smallest value."""
    names = df.columns
    types = dict(df.dtypes)
    values = {c: F.when(~missing(df, c), column(c)) for c in names}
    smallest = df.agg(*[F.min(values[c]).cast("string").alias(f"m{i}") for i, c in enumerate(names)],
                      *([F.approx_count_distinct(values[c]).alias(f"d{i}") for i, c in enumerate(names)]
                        if approximate else []))
    entries = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(f"m{i}").alias("sample"),
                        *([F.col(f"d{i}").alias("n_unique")] if approximate else []))
               for i, c in enumerate(names)]
    profile = _unpivot(smallest, entries)
    if approximate:
        return profile.select("column", "dtype", "n_unique", "sample")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), values[c].cast("string").alias("value")) for c in names])
    distinct = (df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
                .groupBy("column").agg(F.count("*").alias("n_unique")))
    return (profile.join(distinct, "column", "left")
            .select("column", "dtype", F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "sample"))


def describe(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max)."""
    names = present(df, columns)
    quartiles = exact_quantiles(df, {n: number(df, n) for n in names}, [0.25, 0.5, 0.75])
    stats = []
    for i, n in enumerate(names):
        c = number(df, n)
        stats += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                  F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}")]
    entries = [F.struct(F.lit(n).alias("column"), F.col(f"n{i}").alias("count"),
                        *[round_to(value.cast("double"), digits).alias(name) for name, value in {
                            "mean": F.col(f"m{i}"), "std": F.col(f"s{i}"), "min": F.col(f"a{i}"),
                            "q25": F.lit(quartiles[n][0]), "q50": F.lit(quartiles[n][1]),
                            "q75": F.lit(quartiles[n][2]), "max": F.col(f"z{i}")}.items()])
               for i, n in enumerate(names)]
    return _unpivot(df.agg(*stats), entries)


def _beyond(df: DataFrame, columns: list[str], threshold: float) -> Column | None:
    names = present(df, columns)
    stats = []
    for i, n in enumerate(names):
        stats += [F.avg(number(df, n)).alias(f"m{i}"), F.stddev_pop(number(df, n)).alias(f"s{i}")]
    row = df.agg(*stats).first()
    tests = [F.coalesce(F.abs((number(df, n) - row[f"m{i}"]) / row[f"s{i}"]) > threshold, F.lit(False))
             for i, n in enumerate(names) if row[f"s{i}"]]
    return reduce(lambda a, b: a | b, tests) if tests else None


def z_outlier_rows(df: DataFrame, columns: list[str], threshold: float = settings.Z_THRESHOLD) -> DataFrame:
    """Rows with any \\|z\\| above the threshold, z from the population standard deviation."""
    hit = _beyond(df, columns, threshold)
    return df.where(F.lit(False) if hit is None else hit)


def z_outlier_summary(df: DataFrame, columns: list[str], threshold: float = settings.Z_THRESHOLD) -> DataFrame:
    hit = _beyond(df, columns, threshold)
    n = F.lit(0).cast("bigint") if hit is None else F.count_if(hit)
    return df.agg(F.count("*").alias("n_rows"), n.alias("n_outliers")).withColumn(
        "outlier_pct", F.coalesce(F.try_divide(F.col("n_outliers"), F.col("n_rows")), F.lit(0.0)) * 100)


def expectations(df: DataFrame, required: list[str], binary: list[str], label: str,
                 never_null: list[str], rate_range: tuple[float, float] = (0.10, 0.40)) -> DataFrame:
    """(check, value, passed) for presence, 0/1 columns, label rate and nulls."""
    absent = [c for c in required if c not in df.columns]
    binary, never_null = present(df, binary), present(df, never_null)
    stats = [F.avg(number(df, label)).alias("rate")]
    stats += [F.count_if(~column(c).isin(0, 1)).alias(f"b{i}") for i, c in enumerate(binary)]
    stats += [F.count_if(missing(df, c)).alias(f"n{i}") for i, c in enumerate(never_null)]

    def check(name: str, value: Column, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), passed.alias("passed"))

    entries = [check("missing_columns", F.lit(len(absent)), F.lit(not absent)),
               check(f"label_rate:{label}", F.col("rate"),
                     F.coalesce(F.col("rate").between(*rate_range), F.lit(False)))]
    entries += [check(f"not_binary:{c}", F.col(f"b{i}"), F.col(f"b{i}") == 0) for i, c in enumerate(binary)]
    entries += [check(f"nulls:{c}", F.col(f"n{i}"), F.col(f"n{i}") == 0) for i, c in enumerate(never_null)]
    return _unpivot(df.agg(*stats), entries)


def quality_report(df: DataFrame, label: str, key: str | None = None) -> dict[str, DataFrame]:
    """The checks of a freshly read table: nulls, duplicates and the label rate."""
    report = {"nulls": null_report(df), "duplicate_rows": duplicate_rows(df), "label": label_rate(df, label)}
    if key is not None:
        report["duplicate_keys"] = duplicate_keys(df, key)
    return report
