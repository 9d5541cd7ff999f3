"""Exact, seeded splits, samples and folds.

Rows are ordered by a seeded hash of their key.  The hash at each wanted position
of each class is found exactly (``functions.selection``) and kept in a table with
one row per class, so membership is a comparison after a join with that table:
no class is sorted in one task, any number of classes is served alike, and the
sizes are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, hash_order
from holdfast.functions.ordering import row_numbers, running_totals
from holdfast.functions.selection import positions, sent_if_few, sketched
from holdfast.session import stage

MIN_ROWS = 10
_ALL = "all"


def _name(label: str | None) -> Column:
    return F.lit(_ALL) if label is None else column(label).cast("string")


def _classes(df: DataFrame, label: str | None) -> tuple[DataFrame, int, int]:
    """``name, n`` of each class, all rows, and the rows of the smallest class."""
    classes = stage(df.groupBy(_name(label).alias("name")).agg(F.count("*").alias("n")), "classes")
    rows, least = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.min("n"), F.lit(0))).first()
    return classes, rows, least


def _borders(df: DataFrame, key: str, label: str | None, seed: int, method: str, quotas: DataFrame, shares: list[float]) -> DataFrame:
    """``name, n, quotas, at``: for each quota of each class, by its last rank, the hash up to which rows count.

    Where rows beyond the quota share that hash, ``key`` is the largest key that
    still counts, else null.  ``quotas`` has ``name`` and ``quotas``, which are about these ``shares`` of each class.
    """
    rows = df.select(_name(label).alias("name"), hash_order(column(key), seed, method).alias("value"), column(key).alias("key"))
    ranks = F.transform(F.filter("quotas", lambda q: (q > 0) & (q < F.col("n"))), lambda q: q - 1)
    groups = stage(sketched(rows.select("name", "value"), shares).join(quotas, "name").withColumn("ranks", F.array_distinct(ranks)), "quotas")
    found = positions(rows.select("name", "value"), groups, len(shares)).withColumn("wanted", F.col("rank") + 1 - F.col("below"))
    kind = df.schema[key].dataType.simpleString()
    tied = found.where("wanted < equal")
    ends = found.where("wanted = equal").withColumn("key", F.lit(None).cast(kind))
    if not tied.isEmpty():
        # Several rows share the hash at the border: the key decides.
        counts = rows.join(tied.select("name", "value", "rank", "wanted"), ["name", "value"]).groupBy(
            F.concat_ws(":", "rank", "name").alias("border"), "name", "rank", "wanted", "key").agg(F.count("*").alias("c"))
        upto = running_totals(stage(counts, "tied"), [F.asc("key")], {"upto": "c"}, "border")
        inside = F.col("upto") <= F.col("wanted")
        last = stage(upto.groupBy("name", "rank", "wanted").agg(
            F.max(F.when(inside, F.col("key"))).alias("key"), F.max(F.when(inside, F.col("upto"))).alias("most")), "tied")
        if not last.where("most IS NULL OR most <> wanted").isEmpty():
            raise ValueError(f"{key!r} has to be unique for an exact split")
        ends = ends.unionByName(tied.join(last.select("name", "rank", "key"), ["name", "rank"]))
    at = ends.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("rank", F.struct("value", "key")))).alias("at"))
    return groups.select("name", "n", "quotas").join(at, "name", "left")


def _within(quota: Column, n: Column, at: Column, value: Column, own: Column) -> Column:
    """Whether a row is among the first ``quota`` of the ``n`` rows of its class."""
    border = F.element_at(at, quota - 1)
    tie = F.coalesce(own <= border["key"], F.lit(True))
    inside = (value < border["value"]) | ((value == border["value"]) & tie)
    return F.when(quota <= 0, False).when(quota >= n, True).otherwise(F.coalesce(inside, F.lit(False)))


def _parted(df: DataFrame, key: str, label: str | None, seed: int, method: str, quotas: DataFrame, shares: list[float],
            names: list, into: str) -> DataFrame:
    """Adds the i-th of ``names`` where the i-th (rising) quota of the class is the first to hold the row, else the last name."""
    borders = _borders(df, key, label, seed, method, quotas, shares).select(
        F.col("name").alias("_class"), F.struct("n", "quotas", "at").alias("_border"))
    met = df.join(sent_if_few(stage(borders, "borders")), _name(label) == F.col("_class"), "left")
    value, b = hash_order(column(key), seed, method), F.col("_border")
    part = F.when(F.lit(False), F.lit(names[0]))
    for i, name in enumerate(names[:-1]):
        part = part.when(_within(F.get(b["quotas"], F.lit(i)), b["n"], b["at"], value, column(key)), F.lit(name))
    return met.withColumn(into, part.otherwise(F.lit(names[-1]))).select(*[column(c) for c in df.columns if c != into], into)


def shared_out(classes: DataFrame, counted: str, size: int, into: str) -> DataFrame:
    """Adds to ``name`` and its count the class's part of ``size`` rows in proportion; largest remainder, then class order."""
    rows = classes.agg(F.sum(counted)).scalar()
    exact = F.col(counted).cast("double") * F.lit(float(size)) / rows.cast("double")
    floors = classes.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact").cast("bigint"))
    spare = F.lit(size) - floors.agg(F.sum("_floor")).scalar()
    numbered = row_numbers(floors, [(F.col("_exact") - F.col("_floor")).desc(), F.col("name").asc()], "_number")
    return numbered.withColumn(into, F.col("_floor") + (F.col("_number") <= spare).cast("bigint")).drop("_exact", "_floor", "_number")


def split_quotas(classes: DataFrame, rows: int, test_share: float, val_share: float) -> DataFrame:
    """``name, test, val``: rows of each class in both parts.

    The test set is the rounded-up share of all rows, the validation set the
    rounded-up share of the rest; at each step the kept rows are shared out
    first and the split-off part is what remains of each class.
    """
    test = math.ceil(rows * test_share)
    kept = shared_out(classes, "n", rows - test, "kept")
    val = math.ceil((rows - test) * val_share)
    train = shared_out(kept, "kept", rows - test - val, "train")
    return train.select("name", (F.col("n") - F.col("kept")).alias("test"), (F.col("kept") - F.col("train")).alias("val"))


def assign_split(df: DataFrame, key: str, label: str = settings.LABEL, *,
                 test_share: float = settings.TEST_SHARE, val_share: float = settings.VALIDATION_SHARE,
                 stratify: bool = True, seed: int = settings.SEED, method: str = "xxhash64",
                 name: str = "split") -> DataFrame:
    """Adds 'train', 'val' or 'test' per row."""
    if label not in df.columns:
        raise KeyError(f"label column {label!r} not found; available: {df.columns}")
    strata = label if stratify else None
    classes, rows, _ = _classes(df, strata)
    if rows < MIN_ROWS:
        raise ValueError(f"too small to split: {rows} rows, need at least {MIN_ROWS}")
    if not classes.where("name IS NULL").isEmpty():
        raise ValueError(f"label column {label!r} has missing values")
    parts = split_quotas(classes, rows, test_share, val_share)
    quotas = stage(parts.select("name", F.array(F.col("test"), F.col("test") + F.col("val")).alias("quotas")), "shares")
    return _parted(df, key, strata, seed, method, quotas, [test_share, test_share + (1 - test_share) * val_share],
                   ["test", "val", "train"], name)


def split(df: DataFrame, key: str, label: str = settings.LABEL, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, val, test)."""
    marked = assign_split(df, key, label, name="_split", **options)
    return tuple(marked.where(F.col("_split") == s).drop("_split") for s in settings.SPLITS)


def sample_condition(df: DataFrame, key: str, n: int, seed: int = settings.SEED,
                     method: str = "xxhash64") -> Column:
    """True for exactly ``n`` randomly chosen rows (for all rows when there are fewer)."""
    if n <= 0:
        return F.lit(False)
    quota = df.sparkSession.createDataFrame([(_ALL, [n])], "name string, quotas array<bigint>")
    rows = df.count()
    if n >= rows:
        return F.lit(True)
    border = _borders(df, key, None, seed, method, quota, [n / rows]).first()
    last = border["at"][n - 1]
    value = hash_order(column(key), seed, method)
    tie = F.lit(True) if last["key"] is None else column(key) <= F.lit(last["key"])
    return (value < F.lit(last["value"])) | ((value == F.lit(last["value"])) & tie)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = settings.SEED, method: str = "xxhash64") -> DataFrame:
    """A simple random sample of exactly ``n`` rows."""
    return df.where(sample_condition(df, key, n, seed, method))


def assign_folds(df: DataFrame, key: str, label: str | None, folds: int = settings.CV_FOLDS,
                 seed: int = settings.SEED, method: str = "xxhash64", name: str = "fold") -> DataFrame:
    """Adds 0..folds-1; within a class the fold sizes differ by at most one."""
    classes, _, least = _classes(df, label)
    if folds < 2 or least < folds:
        raise ValueError(f"need at least {folds} rows of each class and two folds")
    size, larger = F.floor(F.col("n") / folds), F.col("n") % folds
    ends = [(size * (i + 1) + F.least(F.lit(i + 1), larger)).cast("bigint") for i in range(folds - 1)]
    return _parted(df, key, label, seed, method, classes.select("name", F.array(*ends).alias("quotas")),
                   [(i + 1) / folds for i in range(folds - 1)], list(range(folds)), name)


def split_summary(df: DataFrame, label: str, split_column: str = "split") -> DataFrame:
    """(split, n_rows, pct_of_total, label_rate_pct)."""
    per = df.groupBy(column(split_column).alias("split")).agg(
        F.count("*").alias("n_rows"), F.avg(column(label).cast("double")).alias("rate"))
    # The window runs over the aggregated rows only, one per split.
    whole = F.sum("n_rows").over(Window.partitionBy())
    return per.select("split", "n_rows", (F.col("n_rows") / whole * 100).alias("pct_of_total"),
                      (F.col("rate") * 100).alias("label_rate_pct"))

