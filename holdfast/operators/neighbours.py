"""Exact nearest neighbours without pairing every row with every other.

*Boxes.*  Points are cut into slabs of their widest direction, box by box and
round by round, until each box holds a bounded number of them.  Splits, sizes and
bounds of the boxes are tables that meet the points by a join on the box, so
there may be any number of boxes.

*Search.*  Queries walk down the same tables, first each to one near box with
enough points, which gives the query's true radius.  Then they walk down all
boxes that this radius reaches, and only those are searched.  A query without a
radius takes what the farthest corners of boxes with enough points tell of it.
Boxes with many queries are split.

Points have to be distinct in their space, so equal rows never pile up in one box.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from holdfast.functions.expressions import column, missing, number
from holdfast.session import stage

#: Points of a box and queries of a task at most, and parts that a round cuts a box into.
BOX_POINTS, QUERY_CHUNK, FAN = 5_000, 20_000, 16
_DISTANCES = 4_000_000


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def _closest(queries: np.ndarray, points: np.ndarray, first: np.ndarray, k: int, limit: np.ndarray):
    """Positions of queries and of their k closest points, and the squared distances, block by block.

    Points beyond a query's ``limit`` do not count; one that is not a number is none.
    Ties are broken by the first payload entry, then by the place of the point.
    A product of matrices leaves out what is farther than it can be wrong by; the rest is measured exactly.
    """
    step = max(1, _DISTANCES // max(len(points), 1))
    with np.errstate(all="ignore"):
        centre = points.mean(axis=0)
        near = points - centre
        squares = (near ** 2).sum(axis=1)
        for start in range(0, len(queries), step):
            block, most = queries[start:start + step], limit[start:start + step]
            moved = block - centre
            own = (moved ** 2).sum(axis=1)
            wrong = 8 * (points.shape[1] + 4) * np.finfo(float).eps * (np.sqrt(own) + np.sqrt(squares.max())) ** 2
            rough = moved @ (-2 * near.T)
            rough += squares
            reach = most - own
            free = np.flatnonzero(np.isnan(most))
            if len(free):
                reach[free] = np.partition(rough[free], k - 1, axis=1)[:, k - 1] if len(points) > k else np.inf
            # What cannot be compared is measured as well.
            i, j = np.nonzero(~(rough > (reach + 2 * wrong)[:, None]))
            distance = np.zeros(len(i))
            for d in range(points.shape[1]):
                distance += (block[i, d] - points[j, d]) ** 2
            inside = ~(distance > most[i]) & ~(np.isnan(distance) & ~np.isnan(most[i]))
            i, j, distance = i[inside], j[inside], distance[inside]
            order = np.lexsort((j, first[j], distance, i))
            i, j, distance = i[order], j[order], distance[order]
            kept = np.arange(len(i)) - np.searchsorted(i, i) < k
            yield start + i[kept], j[kept], distance[kept]


def _found(q: pa.Table, p: pa.Table, width: int, k: int, form: pa.Schema) -> pa.Table:
    """The k closest points of a box for each of its queries."""
    if not len(q) or not len(p):
        return form.empty_table()
    points, payload = _matrix(p["point"], width), p["payload"].combine_chunks()
    size = payload.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    first = np.zeros(len(p))
    first[size > 0] = payload.flatten().to_numpy(zero_copy_only=False)[(np.cumsum(size) - size)[size > 0]]
    # Equal distances are told apart in the same way wherever the rows come from.
    place = np.lexsort(points.T[::-1])
    limit = q["limit"].to_numpy().astype(float)
    found = [*_closest(_matrix(q["q"], width), points[place], first[place], k, limit)]
    i, j, distance = (np.concatenate(c) for c in zip(*found))
    j = pa.array(place[j])
    return pa.Table.from_arrays([q["query"].take(pa.array(i)), pa.array(distance), p["point"].take(j), p["payload"].take(j)], form.names).cast(form)


def _bounds(placed: DataFrame, width: int) -> DataFrame:
    """``box, n, lows, highs, dim, low, high, mean`` of each box: its bounds, its widest direction and what is known of that."""
    at = [F.col("point")[i] for i in range(width)]
    stats = [a for i, x in enumerate(at) for a in (F.min(x).alias(f"low{i}"), F.max(x).alias(f"high{i}"), F.avg(x).alias(f"mean{i}"))]
    found = placed.groupBy("box").agg(F.count("*").alias("n"), *stats).select(
        "box", "n", *[F.array(*[F.col(f"{c}{i}") for i in range(width)]).alias(f"{c}s") for c in ("low", "high", "mean")])
    wide = F.transform(F.arrays_zip("lows", "highs"), lambda z: z["highs"] - z["lows"])
    found = found.withColumn("dim", (F.array_position(wide, F.array_max(wide)) - 1).cast("int"))
    return found.select("box", "n", "lows", "highs", "dim", *[F.get(f"{c}s", F.col("dim")).alias(c) for c in ("low", "high", "mean")])


def _cuts(placed: DataFrame, found: DataFrame, fan: int) -> DataFrame:
    """``box, dim, cuts``: where to cut each of the boxes ``found`` along its widest direction."""
    value = F.get("point", F.col("dim"))
    shares = [i / fan for i in range(1, fan)]
    cuts = placed.join(found.select("box", "dim"), "box").groupBy("box").agg(F.percentile_approx(value, shares, 1000).alias("cuts"))
    # The mean parts any box that is not a single point; rounding may put it on the upper end.
    every = F.concat("cuts", F.array("mean", "low"))
    return found.join(cuts, "box").select("box", "dim", F.array_sort(F.array_distinct(
        F.filter(every, lambda c: (c >= F.col("low")) & (c < F.col("high"))))).alias("cuts"))


def _boxes(points: DataFrame, width: int, box_points: int, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """The points with their last box, and for each round ``box, parent, n, lows, highs, leaf``."""
    open_ = stage(points.withColumn("box", F.concat("space", F.lit("/"))), "points")
    done, rounds = [], []
    parent = F.lit(None).cast("string")
    while True:
        found = stage(_bounds(open_, width).withColumn("leaf", (F.col("n") <= box_points) | ~F.coalesce(
            F.col("low") < F.col("high"), F.lit(False))), "boxes")
        rounds.append(found.select("box", parent.alias("parent"), "n", "lows", "highs", "leaf"))
        done.append(open_.join(found.where("leaf").select("box"), "box", "left_semi"))
        if found.where("NOT leaf").isEmpty():
            return reduce(DataFrame.unionByName, done), rounds
        value = F.get("point", F.col("dim"))
        child = F.size(F.filter("cuts", lambda c: c < value))
        cuts = stage(_cuts(open_, found.where("NOT leaf"), fan), "cuts")
        open_ = stage(open_.join(cuts, "box").withColumn(
            "box", F.concat("box", F.lit("."), child.cast("string"))).drop("dim", "cuts"), "points")
        parent = F.regexp_replace("box", "[.][0-9]+$", "")


#: From so many directions on distances are sums of arrays: written out they would be a method too long to be compiled.
_WRITTEN_OUT = 8


def _distance_to(width: int, far: bool) -> Column:
    """Squared distance from ``q`` to the nearest or to the farthest corner of a box."""
    def gap(q: Column, low: Column, high: Column) -> Column:
        below, above = low - q, q - high
        return F.greatest(F.abs(below), F.abs(above)) if far else F.greatest(below, above, F.lit(0.0))

    def summed(*columns: pd.Series) -> pd.Series:
        if not len(columns[0]):
            return pd.Series([], dtype=float)
        q, low, high = (np.concatenate(c.to_numpy()).reshape(-1, width) for c in columns)
        with np.errstate(all="ignore"):
            below, above = low - q, q - high
            gaps = np.maximum(np.abs(below), np.abs(above)) if far else np.maximum(np.maximum(below, above), 0.0)
            return pd.Series((gaps ** 2).sum(axis=1))

    if width > _WRITTEN_OUT:
        # Said to change, so that it is worked out once where it is used twice.
        return F.pandas_udf(summed, "double").asNondeterministic()("q", "lows", "highs")
    gaps = [gap(F.col("q")[i], F.col("lows")[i], F.col("highs")[i]) for i in range(width)]
    return reduce(lambda out, g: out + g * g, gaps, F.lit(0.0))


#: A hair wider than the radius, so rounding never hides a neighbour.
_HAIR = 1 + 1e-9


def _children(rounds: list[DataFrame]) -> list[DataFrame]:
    """The boxes of each round under the box they are met by; the first ones, which have no parent, under themselves."""
    return [boxes.withColumn("parent", F.col("parent" if nth else "box")) for nth, boxes in enumerate(rounds)]


def _own(queries: DataFrame, rounds: list[DataFrame], width: int, k: int) -> DataFrame:
    """``query, q, box``: one last box near each query, if possible with ``k`` points."""
    front = queries.select("query", "q", F.concat("space", F.lit("/")).alias("parent"))
    ended = []
    for nth, parts in enumerate(_children(rounds)):
        # A box is known by its number under its parent, as only whole numbers are summed up without a sort.
        number_ = F.substring_index("box", ".", -1).cast("int") if nth else F.lit(0)
        met = front.join(parts, "parent").withColumn("near2", _distance_to(width, False)).where(F.col("near2") <= float("inf"))
        next_ = met.groupBy("query").agg(F.min_by(
            2 * number_ + F.col("leaf").cast("int"), F.when(F.col("n") >= k, F.col("near2")).otherwise(float("inf"))).alias("code"))
        box = F.concat("parent", F.lit("."), F.shiftright("code", 1).cast("string")) if nth else F.col("parent")
        kept = stage(front.join(next_, "query").select("query", "q", box.alias("box"), (F.col("code") % 2 == 1).alias("leaf")), "own")
        ended.append(kept.where("leaf").drop("leaf"))
        front = kept.where("NOT leaf").select("query", "q", F.col("box").alias("parent"))
    return reduce(DataFrame.unionByName, ended)


def _reached(queries: DataFrame, rounds: list[DataFrame], width: int, k: int) -> DataFrame:
    """``query, q, radius, box``: each query with the last boxes within its ``radius``; null: with those that can hold one of its neighbours."""
    front = queries.select("query", "q", "radius", F.coalesce("radius", F.lit(float("inf"))).alias("limit"), F.concat(
        "space", F.lit("/")).alias("parent"))
    ended = []
    for parts in _children(rounds):
        # A box with enough points holds k neighbours at most as far as its farthest corner.
        enough = front.where("radius IS NULL").join(parts.where(F.col("n") >= k), "parent").withColumn(
            "far2", _distance_to(width, True)).groupBy("query").agg(F.min("far2").alias("enough"))
        # A query meets its boxes when its limit is known, so boxes out of reach are never sent on.
        limited = front.join(enough, "query", "left").withColumn("limit", F.least("limit", F.coalesce("enough", F.lit(float("inf")))))
        met = limited.join(parts, "parent").where(_distance_to(width, False) <= F.col("limit") * _HAIR)
        kept = stage(met.select("query", "q", "radius", "limit", "box", "leaf"), "front")
        ended.append(kept.where("leaf").select("query", "q", "radius", "box"))
        front = kept.where("NOT leaf").select("query", "q", "radius", "limit", F.col("box").alias("parent"))
    return reduce(DataFrame.unionByName, ended)


def nearest(queries: DataFrame, points: DataFrame, width: int, k: int, box_points: int = BOX_POINTS,
            query_chunk: int = QUERY_CHUNK, fan: int = FAN) -> DataFrame:
    """The ``k`` closest ``points`` of every query.

    ``queries`` has ``qid`` and ``q``, ``points`` has ``point`` (distinct) and
    ``payload``; ``q``, ``point`` and ``payload`` are arrays of double.  Returns
    (qid, distance2, point, payload), at most ``k`` rows per query.  Where both
    have a text column ``space``, a query only sees points of its own space;
    points are then distinct in each space, and all spaces are searched at once.
    """
    form = T.StructType([T.StructField("query", T.LongType()), T.StructField("distance2", T.DoubleType()),
                         *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("point", "payload")]])
    table = to_arrow_schema(form)
    if "space" not in queries.columns:
        queries, points = queries.withColumn("space", F.lit("")), points.withColumn("space", F.lit(""))
    placed, rounds = _boxes(points.select("space", "point", "payload"), width, box_points, fan)
    placed = placed.select("box", "point", "payload")
    # Few queries are work for many tasks, however little room they take.
    tasks = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), queries.sparkSession.sparkContext.defaultParallelism)
    asked = stage(queries.select("qid", "space", "q").repartition(tasks).withColumn("query", F.monotonically_increasing_id()), "queries")

    def searched(rows: DataFrame) -> DataFrame:
        return _by_box(rows, placed, query_chunk, lambda q, p: _found(q, p, width, k, table), form)

    # First a near box that has enough points: the k-th distance in there is the query's radius.
    own = _own(asked, rounds, width, k)
    first = stage(searched(own.withColumn("limit", F.lit(None).cast("double"))), "first")
    radius = first.groupBy("query").agg(F.count("*").alias("got"), F.max("distance2").alias("most")).select(
        "query", F.when(F.col("got") >= k, F.col("most")).alias("radius"))
    front = _reached(asked.join(radius, "query", "left"), rounds, width, k)
    others = front.withColumnRenamed("radius", "limit").join(own.select("query", "box"), ["query", "box"], "left_anti")
    best = F.slice(F.array_sort(F.collect_list(F.struct("distance2", F.get("payload", F.lit(0)).alias("first"),
                                                        "point", "payload"))), 1, k)
    # One list entry per reached box and neighbour, so at most k times the boxes a query reaches.
    merged = first.unionByName(searched(others)).groupBy("query").agg(best.alias("best"))
    return asked.select("query", "qid").join(merged, "query").select("qid", F.explode("best").alias("b")).select(
        "qid", "b.distance2", "b.point", "b.payload")


def _by_box(queries: DataFrame, points: DataFrame, query_chunk: int, fn, schema) -> DataFrame:
    """Cogroup by box; a box with many queries is split and its points repeated per part."""
    parts = queries.groupBy("box").agg(F.ceil(F.count("*") / query_chunk).cast("int").alias("parts"))
    q = queries.join(parts, "box").withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
    p = points.join(parts, "box").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (q.drop("parts").groupBy("box", "part")
            .cogroup(p.drop("parts").groupBy("box", "part")).applyInArrow(fn, schema))


def _cells(df: DataFrame, names: list[str]) -> DataFrame:
    """(cell, mask): the row's values over ``names``, and for each of them 1 where it is there, else 0."""
    parts = [F.col(f"c{i}") for i in range(len(names))]
    there = [F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in parts]
    return (df.select(*[number(df, n).alias(f"c{i}") for i, n in enumerate(names)])
            .select(F.array(*parts).alias("cell"), F.concat(*there).alias("mask")))


def _targets(rows: DataFrame, width: int, there: bool) -> DataFrame:
    """One row for each column that a row has, or lacks."""
    sign = "1" if there else "0"
    which = F.filter(F.array(*[F.lit(i) for i in range(width)]), lambda i: F.substring("mask", i + 1, 1) == sign)
    return rows.withColumn("t", F.explode(which))


def _smallest(rows: DataFrame, k: int) -> DataFrame:
    """(space, point, payload) with the k smallest ``y`` of each point, with bounded state per point."""
    counted = rows.groupBy("space", "point", "y").count()
    # Repeats of one target beyond k change nothing.
    spread = counted.select("space", "point", F.col("y"), F.explode(F.sequence(F.lit(1), F.least(
        F.col("count").cast("int"), F.lit(k)))).alias("copy"))
    w = Window.partitionBy("space", "point").orderBy("y", "copy")
    top = spread.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    return top.groupBy("space", "point").agg(F.array_sort(F.collect_list("y")).alias("payload"))


def knn_fill(df: DataFrame, donors: DataFrame, names: list[str], k: int, **limits) -> DataFrame:
    """Fill the gaps of each column with the mean of its k nearest donors.

    Distances run over the columns both rows have, scaled up for the ones
    missing.  A space is a target column with the columns that the receiver has
    and those that the donor has; a value that either lacks is 0 on both sides.
    So all targets and all patterns of gaps are one search, and only rows with a
    gap are joined with what it finds.  Equal receivers are looked up once.
    Rows without any distance stay missing.
    """
    width = len(names)
    receivers = stage(_cells(df, names).where(F.col("mask").contains("0")).distinct(), "receivers")
    patterns = _targets(receivers.select("mask").distinct(), width, False).withColumnRenamed("mask", "theirs")
    given = stage(_cells(donors, names), "donors")
    offers = _targets(given.select("mask").distinct(), width, True)

    def shared(mine: str, other: str) -> tuple[Column, Column]:
        """Which columns both rows have, and how many that are."""
        both = F.array(*[(F.substring(mine, i + 1, 1) == "1") & (F.substring(other, i + 1, 1) == "1") for i in range(width)])
        return both, F.size(F.filter(both, lambda b: b))

    def projected(rows: DataFrame, receiver: str, donor: str) -> DataFrame:
        both, n = shared(receiver, donor)
        place = F.transform(F.arrays_zip(F.col("cell").alias("c"), both.alias("b")), lambda z: F.when(z["b"], z["c"]).otherwise(F.lit(0.0)))
        return rows.withColumns({"place": place, "common": n, "space": F.concat_ws(":", "t", receiver, donor)}).where("common > 0")

    spots = projected(_targets(given, width, True).join(patterns, "t"), "theirs", "mask").select(
        "space", F.col("place").alias("point"), F.get("cell", F.col("t")).alias("y"))
    asked = projected(_targets(receivers, width, False).join(offers.withColumnRenamed("mask", "theirs"), "t"), "mask", "theirs")
    queries = asked.select(F.struct("cell", "t", "common", "space").alias("qid"), "space", F.col("place").alias("q"))
    # Of the donors at one spot only the k smallest targets can matter.
    near = nearest(queries, _smallest(spots, k), width, k, **limits).select(
        "qid.cell", "qid.t", (F.col("distance2") * (F.lit(float(width)) / F.col("qid.common"))).alias("d"), F.explode("payload").alias("y"))
    # At most k spots with k targets per donor pattern reach this list.
    best = F.slice(F.array_sort(F.collect_list(F.struct("d", "y"))), 1, k)
    mean = F.aggregate("b", F.lit(0.0), lambda a, x: a + x["y"]) / F.size("b")
    fills = near.groupBy("cell", "t").agg(best.alias("b")).select("cell", "t", mean.alias("fill")).groupBy("cell").agg(
        F.map_from_entries(F.collect_list(F.struct("t", "fill"))).alias("_fills"))
    gap = reduce(lambda a, b: a | b, [missing(df, n) for n in names])
    whole = {n: number(df, n) for n in names}
    gaps = df.where(gap).withColumn("_cell", F.array(*whole.values()))
    met = gaps.join(fills.withColumnRenamed("cell", "_receiver"), F.col("_cell").eqNullSafe(F.col("_receiver")), "left")
    filled = met.withColumns({n: F.coalesce(c, F.element_at("_fills", F.lit(t))) for t, (n, c) in enumerate(whole.items())})
    columns = [column(c) for c in df.columns]
    return df.where(~gap).withColumns(whole).select(*columns).unionByName(filled.select(*columns))
