"""What each filter of a chain does in every order of the chain, from wide packed counters.

The filters of a document are independent of one another, so all that any order
does with it follows from its mask, one bit for each filter that it fails.  A mask
stands for a few big integers.  Each has one field of 64 bits for every step of
every order, 600 fields for five filters, and a field is one if the document is
kept (removed, and so on) at that step.  Adding such integers counts all steps of
all orders at once.  No count comes near 2^64, so no field runs over into the
next, and a sum is unpacked by reading its bytes as 64-bit integers.

Documents are first counted by part and mask on Spark, with sums before the
shuffle, so the largest part is at most as many rows as there are masks when its
integers are added up.
"""

from __future__ import annotations

import functools
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.text import text_of, words
from holdfast.session import stage

#: More filters than these have too many orders for one row each.
MOST_FILTERS = 6
BYTES = 8


@functools.cache
def orders(names: str) -> list[str]:
    return ["".join(p) for p in permutations(names)]


@functools.cache
def packed(names: str) -> dict[str, list[int]]:
    """For each mask the big integer of every outcome; its fields are the steps, order by order."""
    k = len(names)
    bit = {c: 1 << i for i, c in enumerate(names)}
    steps = [[bit[c] for c in order] for order in orders(names)]
    out: dict[str, list[int]] = {"kept": [], "removed": [], "redundant": [], "unique_fails": []}
    for mask in range(1 << k):
        fields = {name: bytearray(len(steps) * k * BYTES) for name in out}
        for p, bits in enumerate(steps):
            gone = False
            for s, b in enumerate(bits):
                at, fails = (p * k + s) * BYTES, bool(mask & b)
                fields["redundant"][at] = gone and fails
                fields["removed"][at] = fails and not gone
                fields["unique_fails"][at] = mask == b
                gone |= fails
                fields["kept"][at] = not gone
        for name, f in fields.items():
            out[name].append(int.from_bytes(f, "little"))
    return out


def unpacked(total: int, fields: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(fields * BYTES, "little"), "<i8")


def audit(df: DataFrame, fails: dict[str, Column], part: Column, flags: dict[str, Column] | None = None) -> DataFrame:
    """One row per part, order of the filters and step: what that step keeps and removes there.

    ``fails`` names each filter by one letter and tells which rows fail it (null:
    does not fail); ``flags`` names columns for the number of removed rows with
    that property (null: without it).  A null part counts as "".  ``shapley`` is
    the number of rows that the step's filter removes, summed over all orders.
    Repeated rows count each.  Columns of ``df`` are read by the expressions
    alone, so no name clashes.  An empty table gives no rows.
    """
    names, flags = "".join(fails), flags or {}
    extra = list(flags)
    if not 0 < len(fails) <= MOST_FILTERS or any(len(c) != 1 for c in fails):
        raise ValueError(f"give 1 to {MOST_FILTERS} filters, each named by one letter")
    mask = functools.reduce(lambda a, b: a + b, [
        F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails.values())])
    flagged = [F.coalesce(c, F.lit(False)).cast("int").alias(f"flag_{i}") for i, c in enumerate(flags.values())]
    counts = df.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"), *flagged).groupBy("part", "mask").agg(
        F.count("*").alias("n"), *[F.sum(f"flag_{i}").alias(f"flag_{i}") for i in range(len(flags))])
    sums = ["kept", "removed", "redundant", "unique_fails", *extra]

    def unfold(rows: pd.DataFrame) -> pd.DataFrame:
        table, every, k = packed(names), orders(names), len(names)
        weights = {name: ("n", name) for name in table} | {f: (f"flag_{i}", "removed") for i, f in enumerate(extra)}
        masks = rows["mask"].tolist()
        out = {"part": rows["part"].iloc[0], "filter_order": np.repeat(every, k), "step": np.tile(np.arange(1, k + 1), len(every))}
        for name in sums:
            column, outcome = weights[name]
            out[name] = unpacked(sum(n * table[outcome][m] for n, m in zip(rows[column].tolist(), masks)), len(every) * k)
        letters = np.array(list("".join(every)))
        out["shapley"] = np.zeros(len(letters), np.int64)
        for c in names:
            out["shapley"][letters == c] = out["removed"][letters == c].sum()
        return pd.DataFrame(out)

    form = ", ".join(["part string", "filter_order string", "step int", *(f"{c} long" for c in sums), "shapley long"])
    return counts.groupBy("part").applyInPandas(unfold, form)


def text_failures(text: Column) -> dict[str, Column]:
    """Four filters of a text: few words, few different words, many capitals, a symbol."""
    w = words(text)
    n = F.size(w)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct(w)) < 50 * n, "C": 100 * capitals > 2 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def audit_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source") -> DataFrame:
    """The audit of five filters by source: the four of ``text_failures``, and E, an equal text under a smaller id.

    A null text counts as empty.  A row without an id does not fail E and has no
    label, and no other row fails for its sake; rows with the same text and the
    same id, the smallest, all pass.  A document is good (toxic) if any of its
    labels says so.  Texts are equal if their SHA-256 digests are.
    """
    whole = text_of(text)
    fails = text_failures(F.col("text"))
    bits = [F.coalesce(c, F.lit(False)).alias(name) for name, c in fails.items()]
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{source}`").cast("string").alias("part"), whole.alias("text"))
    narrow = stage(given.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *bits), "masks")
    firsts = narrow.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).alias("good"),
                          (F.col("toxic") == 1).alias("toxic")).where("id IS NOT NULL").groupBy("id").agg(
        F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    # Rows without an id need neither join, so they never meet in one task.
    known = narrow.where("id IS NOT NULL").join(firsts, ["digest", "id"], "left").join(marks, "id", "left").select(
        "part", *fails, F.col("first").isNull().alias("E"), "good", "toxic")
    unknown = narrow.where("id IS NULL").select("part", *fails, F.lit(False).alias("E"), F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return audit(known.unionByName(unknown), {c: F.col(c) for c in [*fails, "E"]}, F.col("part"),
                 {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")})
