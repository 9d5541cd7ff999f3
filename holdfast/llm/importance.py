"""Quality by importance resampling: hashed n-gram models of good and of all text, Gumbel top-k.

Two bags of hashed words and word pairs are counted: over a bounded sample of
labelled good documents, and over all documents.  A document's weight is the
mean log ratio of its n-grams under the two, and documents are drawn without
replacement in proportion to ``exp(weight * sharpness)`` by adding Gumbel noise
and keeping the k highest sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.selection import order_statistics
from holdfast.llm.hashing import grams, words
from holdfast.llm.text import free_name, text_of
from holdfast.session import stage

#: Buckets of the models, most labelled documents of the good model, and what a mean log ratio is multiplied by.
BUCKETS, LABELLED, SHARPNESS = 16_384, 20_000, 40.0
COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("good", pa.int64())])


def _buckets(codes: np.ndarray, begin: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs of words, and the text each belongs to."""
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    same = text[1:] == text[:-1]
    pairs = grams(codes, 2)[same] if len(codes) > 1 else codes[:0]
    return (np.concatenate([codes, pairs]) % np.uint64(buckets)).astype(np.int64), np.concatenate([text, text[:-1][same] if len(text) else text])


def fit(df: DataFrame, good: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
        labelled: int = LABELLED) -> list[float]:
    """Log ratio of each bucket, good to all text, smoothed by one.

    ``good`` holds the ids of good documents; the ``labelled`` first of them in
    the order of a hash make the good model, the only thing here that is fitted
    on a sample.  All documents count for the model of all text.
    """
    name = free_name(df, "good_id")
    chosen = good.select(F.col(good.columns[0]).alias(name)).where(F.col(name).isNotNull()).distinct()
    chosen = chosen.orderBy(F.xxhash64(name), name).limit(labelled)
    marked = df.join(F.broadcast(chosen), F.col(f"`{doc_id}`") == F.col(name), "left").select(
        text_of(text).alias("text"), F.col(name).isNotNull().alias("good"))

    def count(batches):
        raw, of_good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            is_good = np.array(batch.column(1).to_pylist(), bool)
            for first, codes, begin in words(batch.column(0), lower=False):
                bucket, at = _buckets(codes, begin, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                of_good += np.bincount(bucket[is_good[first + at]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(of_good[seen])], schema=COUNTS)

    rows = marked.mapInArrow(count, "bucket int, raw long, good long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()
    raw, of_good = np.ones(buckets), np.ones(buckets)
    for r in rows:
        raw[r["bucket"]] += r["raw"]
        of_good[r["bucket"]] += r["good"]
    return (np.log(of_good / of_good.sum()) - np.log(raw / raw.sum())).tolist()


def score(df: DataFrame, ratios: list[float], text: str = "text", into: str = "log_ratio") -> DataFrame:
    """Adds the mean log ratio of a text's n-grams; 0 for a text without words."""
    table, buckets = np.array(ratios), len(ratios)

    @F.arrow_udf("double")
    def mean_ratio(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, codes, begin in words(texts, lower=False):
            bucket, at = _buckets(codes, begin, buckets)
            n = np.bincount(at, minlength=len(begin) - 1)
            out.append(np.bincount(at, table[bucket], len(begin) - 1) / np.maximum(n, 1))
        return pa.array(np.concatenate(out))

    return df.withColumn(into, mean_ratio(text_of(text)))


def gumbel(*parts: Column) -> Column:
    """Gumbel noise that depends on its arguments alone."""
    u = (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def resample(df: DataFrame, good: DataFrame, share: float, doc_id: str = "doc_id", text: str = "text", seed: int = 0,
             sharpness: float = SHARPNESS, buckets: int = BUCKETS, labelled: int = LABELLED) -> DataFrame:
    """Id, ``log_ratio``, ``key`` and ``kept`` of each row; ``kept`` marks the ``share`` of all rows with the highest keys.

    A null or empty text weighs nothing (ratio 0), so noise alone decides.
    Rows whose key equals that of the last one kept (repeated rows) are kept
    with it.  Without good documents all weights are alike; an empty table
    gives no rows.  The noise depends on id, text and seed: reruns agree.
    """
    ratios = fit(df, good, doc_id, text, buckets, labelled)
    rows = score(df.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text")), ratios)
    noise = gumbel(F.lit(seed), F.col("doc_id"), F.xxhash64("text"))
    rows = stage(rows.select("doc_id", "log_ratio", (F.lit(sharpness) * F.col("log_ratio") + noise).alias("key")), "scores")
    n = rows.count()
    k = round(share * n)
    if not 0 < k < n:
        return rows.withColumn("kept", F.lit(k >= n))
    border = order_statistics(rows, {"key": F.col("key")}, {"key": [n - k]}, {"key": n})[("key", n - k)].value
    return rows.withColumn("kept", F.col("key") >= border)
