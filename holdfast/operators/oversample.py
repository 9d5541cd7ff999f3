"""Synthetic minority rows between near neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column
from holdfast.operators.neighbours import nearest
from holdfast.operators.split import sample_condition
from holdfast.session import stage


def neighbour_pool(rows: DataFrame, width: int, k: int, asked: DataFrame | None = None, **limits) -> DataFrame:
    """(v, pool): the k nearest other rows of each distinct vector ``v``, or of those that are ``asked`` for.

    Equal rows are one point with a count: ``m`` copies are neighbours of each
    other at distance 0, however many there are.
    """
    spots = rows.groupBy("v").agg(F.count("*").cast("double").alias("m"))
    spots = stage(spots, "spots")
    asked = spots if asked is None else asked.select("v").distinct()
    near = nearest(asked.select(F.col("v").alias("qid"), F.col("v").alias("q")),
                   spots.select(F.col("v").alias("point"), F.array("m").alias("payload")), width, k + 1, **limits)
    copies = F.get("payload", F.lit(0)).cast("bigint") - F.when(F.col("point") == F.col("qid"), 1).otherwise(0)
    repeated = (near.withColumn("copies", F.least(copies, F.lit(k))).where(F.col("copies") > 0)
                .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))))
    ordered = F.array_sort(F.collect_list(F.struct("distance2", "point")))
    # At most k + 1 points with k copies each are listed.
    return repeated.groupBy("qid").agg(F.slice(ordered, 1, k).alias("pool")).withColumnRenamed("qid", "pool_v")


def oversample(df: DataFrame, key: str, label: str, features: list[str], neighbours: int = 5,
               seed: int = settings.SEED, **limits) -> DataFrame:
    """The rows and as many synthetic ones as bring every class to the size of the largest.

    A synthetic row is base + u * (neighbour - base) with a seeded u in [0, 1);
    its key is null.
    """
    # Written once: each class scans its rows several times.
    out = stage(df.select(column(key).alias(key), column(label).alias(label),
                          *[column(f).cast("double").alias(f) for f in features]), "rows")
    counts = {r[0]: r[1] for r in out.groupBy(column(label)).count().collect()}
    largest = max(counts.values())
    result = out
    for value, n in sorted(counts.items()):
        needed = largest - n
        if not needed:
            continue
        if n <= neighbours:
            raise ValueError(f"class {value!r} has {n} rows, need more than {neighbours} neighbours")
        rows = out.where(column(label) == F.lit(value)).select(column(key).alias("k"), F.array(*features).alias("v"))
        extra = sample_condition(rows, "k", needed % n, seed).cast("int") if needed % n else F.lit(0)
        draws = rows.withColumn("draws", extra + F.lit(needed // n)).where(F.col("draws") > 0)
        # Only rows that are drawn are ever moved towards a neighbour.
        pool = neighbour_pool(rows, len(features), neighbours, draws if needed < n else None, **limits)
        drawn = draws.select("k", "v", F.explode(F.sequence(F.lit(1), F.col("draws").cast("int"))).alias("draw"))
        pick = F.pmod(F.xxhash64(F.lit(seed), F.lit("pick"), "k", "draw"), F.lit(neighbours)).cast("int")
        gap = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("gap"), "k", "draw"), 11) / F.lit(float(2**53))
        placed = (drawn.join(pool, F.col("v") == F.col("pool_v"))
                  .select("v", F.get("pool", pick)["point"].alias("near"), gap.alias("u")))
        made = placed.select(F.lit(None).cast(out.schema[key].dataType).alias(key),
                             F.lit(value).cast(out.schema[label].dataType).alias(label),
                             *[(F.col("v")[i] + F.col("u") * (F.col("near")[i] - F.col("v")[i])).alias(f)
                               for i, f in enumerate(features)])
        result = result.unionByName(made)
    return result
