"""Ranked lexical search with hashed max-sketches as upper bounds.

*Sketch.*  Each term of a document has an impact, the part of its score that does
not depend on the query's weights.  Hashed to ``WIDTH`` coordinates, the impacts
of a document fold into the largest one of each coordinate.

*Bound.*  The weights of a query's terms times the sketch at their coordinates is
at least the document's score, since weights are not negative.  All queries of a
batch are looked up in the sketches of a block of documents at once.

*Rescoring.*  A block's documents are scored exactly in the order of falling
bounds, in whole numbers, until the bound is below the query's k-th best score so
far.  The threshold is kept from block to block of a task, so later blocks score
few documents.  A task hands on its best k of each query; the best k of those are
the answer.

Two scans of the documents make the answer: one counts documents, terms and the
documents of each queried term, one searches.  Terms are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.hashing import NO_TERM, words
from holdfast.llm.text import text_of
from holdfast.session import stage

#: Coordinates of a sketch, and documents of a block at most; a power of two each.
WIDTH, BLOCK = 1024, 512
#: Cells of a block's tables: with many queried terms the blocks are smaller.
CELLS = 1 << 21
#: Queries and their terms that one scan answers; more queries take more scans.
QUERIES, TERMS = 1024, 1 << 16
#: Fixed values of the score: parts in a thousand of a term's weight, and the share of a document's length that counts.
SCALE, HALF = 1000, 50
#: Parts in which the best of a query are merged first.
SALT = 64

_FORM = "query int, doc_id long, score long"


@dataclass(frozen=True)
class Batch:
    """Terms of a batch of queries: query number and hash of each, sorted by both, and the weight of each."""

    query: np.ndarray
    code: np.ndarray
    weight: np.ndarray


def _counted(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For stretches of texts: the first, number of terms of each text, and text, hash and count of each distinct term."""
    for first, codes, begin in words(texts, True, NO_TERM):
        n = np.diff(begin)
        doc = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((codes, doc))
        codes, doc = codes[order], doc[order]
        new = np.ones(len(codes), bool)
        new[1:] = (np.diff(doc) != 0) | (codes[1:] != codes[:-1])
        at = np.flatnonzero(new)
        yield first, n, doc[at], codes[at], np.diff(np.append(at, len(codes)))


def _found(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``codes`` are among the sorted ones, and their places there."""
    if not len(sorted_codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    hit = np.flatnonzero(sorted_codes[at] == codes)
    return hit, at[hit]


def query_terms(queries: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, code``: the distinct terms of each item, as signed 64-bit hashes."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, doc, codes, _ in _counted(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + first)), pa.array(codes.view(np.int64))],
                                                 ["item", "code"])

    return queries.select(F.col(f"`{item_id}`").cast("long").alias("item"), text_of(text).alias("text")).mapInArrow(
        terms, "item long, code long").distinct()


def _statistics(docs: DataFrame, codes: np.ndarray) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all terms, and the documents of each of the sorted ``codes``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(len(codes), np.int64), 0, 0
        for batch in batches:
            for _, n, _, found, _ in _counted(batch.column(1)):
                n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
                df += np.bincount(_found(codes, found)[1], minlength=len(codes)).astype(np.int64)
        some = np.flatnonzero(df)
        keys = pa.array([None, *codes[some].view(np.int64).tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([keys, pa.array([n_docs, *df[some].tolist()]), pa.array([n_terms] + [0] * len(some))],
                                         ["code", "n", "terms"])

    sums = docs.mapInArrow(count, "code long, n long, terms long").groupBy("code").agg(F.sum("n").alias("n"), F.sum("terms").alias("terms"))
    rows = sums.collect()
    whole = next((r for r in rows if r["code"] is None), None)
    return (whole["n"] if whole else 0), (whole["terms"] if whole else 0), {r["code"]: r["n"] for r in rows if r["code"] is not None}


def impacts(tf: np.ndarray, doc: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What ``tf`` occurrences in document number ``doc`` add to its score for each unit of weight; ``n`` are all lengths."""
    m = np.array([100 - HALF + HALF * x * n_docs // n_terms for x in n.tolist()], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])


def weight(df: int, n_docs: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Search:
    """Best documents of each query of a batch, block after block."""

    def __init__(self, batch: Batch, n_docs: int, n_terms: int, k: int, width: int = WIDTH):
        self.k, self.width, self.n_docs, self.n_terms = k, width, n_docs, n_terms
        self.codes, at = np.unique(batch.code, return_inverse=True)
        count = int(batch.query.max()) + 1
        begin = np.searchsorted(batch.query, np.arange(count + 1))
        self.terms = [at[a:b] for a, b in zip(begin, begin[1:])]
        self.weights = [batch.weight[a:b] for a, b in zip(begin, begin[1:])]
        self.lookup = np.zeros((width, count))
        np.add.at(self.lookup, (self._place(batch.code), batch.query), batch.weight)
        self.rows = max(16, min(BLOCK, CELLS // max(len(self.codes), width, count)))
        self.least = np.zeros(count, np.int64)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * count
        self.scored = 0

    def _place(self, codes: np.ndarray) -> np.ndarray:
        return (codes % np.uint64(self.width)).astype(np.int64)

    def read(self, ids: np.ndarray, no_id: np.ndarray, texts: pa.Array) -> None:
        for first, n, doc, codes, tf in _counted(texts):
            impact = impacts(tf, doc, n, self.n_docs, self.n_terms)
            for a in range(0, len(n), self.rows):
                b = min(a + self.rows, len(n))
                x, y = np.searchsorted(doc, [a, b])
                self._block(ids[first + a:first + b], no_id[first + a:first + b], doc[x:y] - a, codes[x:y], impact[x:y])

    def _block(self, ids: np.ndarray, no_id: np.ndarray, doc: np.ndarray, codes: np.ndarray, impact: np.ndarray) -> None:
        sketch = np.zeros((len(ids), self.width))
        np.maximum.at(sketch, (doc, self._place(codes)), impact)
        # Whole numbers below 2^53 are exact in floating point; a margin covers larger ones.
        bounds = sketch @ self.lookup * (1 + 1e-9)
        asked = np.flatnonzero((bounds >= np.maximum(self.least, 1)).any(axis=0))
        if not len(asked):
            return
        hit, at = _found(self.codes, codes)
        exact = np.zeros((len(ids), len(self.codes)), np.int64)
        exact[doc[hit], at] = impact[hit]
        for q in asked.tolist():
            bound = bounds[:, q]
            order = np.flatnonzero(bound >= max(self.least[q], 1))
            order = order[np.argsort(-bound[order], kind="stable")]
            for a in range(0, len(order), self.k):
                some = order[a:a + self.k]
                some = some[bound[some] >= max(self.least[q], 1)]
                if not len(some):
                    break
                self.scored += len(some)
                score = exact[np.ix_(some, self.terms[q])] @ self.weights[q]
                good = score >= max(self.least[q], 1)
                self._merge(q, score[good], ids[some[good]], no_id[some[good]])

    def _merge(self, q: int, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        old = self.best[q]
        score, ids, no_id = np.concatenate([old[0], score]), np.concatenate([old[1], ids]), np.concatenate([old[2], no_id])
        first = np.lexsort((ids, no_id, -score))[:self.k]
        self.best[q] = score[first], ids[first], no_id[first]
        if len(first) == self.k:
            self.least[q] = score[first[-1]]


def _searcher(batch: Batch, n_docs: int, n_terms: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Search(batch, n_docs, n_terms, k)
        for rows in batches:
            no_id = rows.column(0).is_null().to_numpy(zero_copy_only=False)
            state.read(rows.column(0).fill_null(0).to_numpy(zero_copy_only=False), no_id, rows.column(1))
        for q, (score, ids, no_id) in enumerate(state.best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(score), q, np.int32)), pa.array(ids, mask=no_id), pa.array(score)], ["query", "doc_id", "score"])

    return search


def lexical_search(docs: DataFrame, queries: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", query_text: str = "text", queries_at_once: int = QUERIES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, with
    A-Z as a-z.  Null and empty texts have no terms: such documents are never
    found and count nowhere, such items have no rows.  Texts are read whole.
    Equal scores are ordered by id, rows without an id last.  A repeated row is a
    document of its own; rows with the same item id are one item with all their
    terms, and so are those without one.  Other columns are not read.  Empty
    tables give no rows.
    """
    spark = docs.sparkSession
    wanted = stage(query_terms(queries, item_id, query_text), "query_terms")
    size = wanted.agg(F.count("*").alias("terms"), F.countDistinct(F.struct("item")).alias("items")).first()
    n_batches = max(1, math.ceil(size["items"] / queries_at_once), math.ceil(size["terms"] / TERMS))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(n_batches):
        # One batch is some thousand queries whatever the number of all.
        terms = wanted.where(F.pmod(F.xxhash64("item"), F.lit(n_batches)) == b).collect()
        if not terms:
            continue
        items = sorted({r["item"] for r in terms}, key=lambda i: (i is None, i))
        number = {i: q for q, i in enumerate(items)}
        code = np.array([r["code"] for r in terms], np.int64).view(np.uint64)
        n_docs, n_terms, df = _statistics(rows, np.unique(code))
        if not n_docs:
            break
        query = np.array([number[r["item"]] for r in terms], np.int32)
        order = np.lexsort((code, query))
        weights = np.array([weight(df.get(r["code"], 0), n_docs) for r in terms], np.int64)
        batch = Batch(query[order], code[order], weights[order])
        found = rows.mapInArrow(_searcher(batch, n_docs, n_terms, k), _FORM)
        names = spark.createDataFrame(list(enumerate(items)), "query int, item_id long")
        out = out.unionByName(_best(found, k).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query, first in parts, so that the best of all tasks never meet in one."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALT))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
    some = some.where(F.col("rank") <= k).drop("rank", "part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
