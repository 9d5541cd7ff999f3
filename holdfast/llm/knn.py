"""Exact top-k search by inner product as a Voronoi join.

Vectors belong to the cell of their nearest pivot.  A summary of a cell (rows
and radius) bounds the score of a query with any vector in it from both sides:
``q.p - |q| r <= q.x <= q.p + |q| r``.  The search runs twice: within the
query's own cell, which gives a first k-th score, and within the other cells
that can still beat it.  Only those cells get a copy of the query.  Cells are
cut into blocks of bounded size, so a vector that fills a third of the table is
many tasks, and a block returns at most k rows a query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from holdfast.session import stage

#: Pivots, scale of the components, rows of the smallest and largest block, parts a large table is cut into.
PIVOTS, SCALE = 64, 1024
SMALL_BLOCK, LARGE_BLOCK, BLOCKS = 128, 65_536, 512
#: Queries that meet a block at once; products up to this size are exact in double precision.
QUERIES, EXACT = 4096, 2.0 ** 53
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def whole(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Rows of floor(scale * x) as doubles, filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = np.floor(SCALE * np.asarray(v, np.float64))
    return out


def scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond 64 bits they stop at the ends of the range."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, data.shape[1])
    if most < EXACT:
        return (queries @ data.T).astype(np.int64)
    numbers = [[int(x) for x in r] for r in data.tolist()]
    return np.array([[min(HIGH, max(LOW, sum(a * b for a, b in zip(map(int, q), r)))) for r in numbers]
                     for q in queries.tolist()], np.int64).reshape(len(queries), len(data))


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best rows other than those with its own id.

    Ties go to the smaller id.  Rows without an id, and vectors that are null or
    hold a null or a value that is not finite, take no part.  Shorter vectors
    count as filled up with zeros.  Repeated rows are all candidates.  A query
    without candidates has no rows; an empty table gives none.
    """
    cast = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), cast.alias("v"),
                     F.coalesce(is_query, F.lit(False)).alias("is_query")).where(F.col("id").isNotNull() & _usable(F.col("v")))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    # A bounded number of pivots, the same in each run.
    chosen = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()
    empty = "query_id long, rank int, vec_id long, score long"
    if not chosen:
        return df.sparkSession.createDataFrame([], empty)
    centre = whole([np.array(r["v"]) for r in chosen], width)

    def assign(batches):
        for b in batches:
            x = whole(b["v"].tolist(), width)
            near = (centre ** 2).sum(1) - 2 * x @ centre.T
            cell = near.argmin(1) if len(x) else np.zeros(0, int)
            gap = np.sqrt(((x - centre[cell]) ** 2).sum(1))
            yield pd.DataFrame({"id": b["id"], "v": b["v"], "is_query": b["is_query"], "cell": cell, "gap": gap})

    placed = stage(rows.mapInPandas(assign, "id long, v array<double>, is_query boolean, cell int, gap double"), "cells")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).orderBy("cell").collect()
    total = sum(c["n"] for c in cells)
    block = min(LARGE_BLOCK, max(SMALL_BLOCK, total // BLOCKS))
    blocks = {c["cell"]: -(-c["n"] // block) for c in cells}
    number = F.element_at(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv]), F.col("cell"))
    data = placed.select("id", "v", "cell", F.pmod(F.xxhash64("id", "v"), number).cast("int").alias("block"))
    at, n, radius = [c["cell"] for c in cells], np.array([c["n"] for c in cells]), np.array([c["radius"] for c in cells])

    def bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score with each cell; a margin covers the rounding."""
        middle, reach = x @ centre[at].T, np.sqrt((x ** 2).sum(1))[:, None] * radius[None, :]
        margin = 1e-9 * (np.abs(middle) + reach) + 1
        return middle - reach - margin, middle + reach + margin

    def solve(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(d):
            x, ids = whole(d["v"].tolist(), width), d["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            x, ids = x[order], ids[order]
            for a in range(0, len(q), QUERIES):
                part = q.iloc[a:a + QUERIES]
                found = scores(whole(part["v"].tolist(), width), x)
                for query, least, s in zip(part["query_id"].tolist(), part["least"].tolist(), found):
                    good = np.flatnonzero((s >= least) & (ids != query))
                    if len(good) > k:
                        good = good[np.argsort(-s[good].astype(object) if s.min() == LOW else -s[good], kind="stable")[:k]]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": ids[good], "score": s[good]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    def local(queries: DataFrame) -> DataFrame:
        """Queries with ``cell``, ``first`` and ``least`` against the blocks of their cells."""
        sent = queries.withColumn("block", F.explode(F.sequence(F.lit(0), number - 1)))
        return sent.groupBy("cell", "block").cogroup(data.groupBy("cell", "block")).applyInPandas(
            solve, "query_id long, vec_id long, score long")

    queries = placed.where("is_query").select(F.col("id").alias("query_id"), "v", "cell")
    first = stage(_best(local(queries.withColumn("least", F.lit(LOW))), k).drop("rank"), "own-cell")
    known = first.groupBy("query_id").agg(F.count("*").alias("found"), F.min("score").alias("kth"))

    def reach(batches):
        for b in batches:
            low, high = bounds(whole(b["v"].tolist(), width))
            sent = []
            for i, (found, kth, own) in enumerate(zip(b["found"], b["kth"], b["cell"])):
                least = float(kth) if found >= k else -math.inf
                # The k-th best lower bound of whole cells also bounds the k-th score; one row may be the query itself.
                order = np.argsort(-low[i], kind="stable")
                enough = np.searchsorted(np.cumsum(n[order]), k + 1)
                if enough < len(order):
                    least = max(least, low[i][order[enough]])
                for j in np.flatnonzero(high[i] >= least):
                    if at[j] != own:
                        sent.append((i, at[j], max(LOW, math.floor(least)) if least > LOW else LOW))
            rows = [s[0] for s in sent]
            yield pd.DataFrame({"query_id": b["query_id"].iloc[rows].to_numpy(), "v": b["v"].iloc[rows].to_numpy(),
                                "cell": [s[1] for s in sent], "least": [s[2] for s in sent]})

    asked = queries.join(known, "query_id", "left").select(
        "query_id", "v", "cell", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("kth", F.lit(0)).alias("kth"))
    rest = local(asked.mapInPandas(reach, "query_id long, v array<double>, cell int, least long"))
    best = _best(first.unionByName(rest), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
