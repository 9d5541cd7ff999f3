"""BPE encoding of whole texts; long ones by tree concatenation.

A text above the leaf size is cut into leaves that Spark encodes as rows of
their own.  Neighbours are then joined pairwise.  Near a join the ids of the two
sides may be wrong, so a window around it is encoded again and grows until its
tokens agree with a token of the left side and with one of the right side: same
id, same place.  Whether neighbouring tokens can stand side by side depends on
these two alone, so the ids left of the first agreement, the window's ids and the
ids right of the second are those of the whole text.  A window that reaches both
ends is the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from holdfast.llm.codec import Codec, codec
from holdfast.llm.text import free_name, text_of

#: Characters of a leaf, and of each side of the first window at a join.
LEAF, WINDOW = 32_768, 64

#: Leaves that one task joins before it meets the rest of a text; encoded leaves that leave a task at a time.
BLOCK, AT_ONCE = 64, 16
#: Chunks of each kind that a worker remembers here, where several of them wait beside one another.
REMEMBERED = 400_000

#: Id, start and end of each token, one row a token; places are code points.
Tokens = np.ndarray
Finish = Callable[[Codec, list[int]], object]


def packed(tokens: Tokens) -> bytes:
    """Number of tokens, then ids, distances and lengths one after another, compressed; some two bytes a token."""
    ids, start, stop = tokens.T
    columns = np.concatenate([ids, start - np.concatenate([[0], stop[:-1]]), stop - start]).astype("<i4")
    return len(tokens).to_bytes(8, "little") + pa.compress(columns.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> Tokens:
    n = int.from_bytes(data[:8], "little")
    ids, gap, length = np.frombuffer(pa.decompress(data[8:], 12 * n, codec="zstd", asbytes=True), "<i4").reshape(3, n)
    stop = np.cumsum(gap + length)
    return np.stack([ids, stop - length, stop], axis=1).astype(np.int32)


def _clean(tokens: Tokens, k: int) -> bool:
    """Whether the token covers characters of its own."""
    _, a, b = tokens[k]
    return a < b and (k == 0 or tokens[k - 1][2] <= a) and (k + 1 == len(tokens) or b <= tokens[k + 1][1])


def _moved(tokens: Tokens, by: int) -> Tokens:
    return tokens + np.array([0, by, by], np.int32)


def join(encode: Callable[[str], Tokens], left: tuple[str, Tokens], right: tuple[str, Tokens],
         window: int = WINDOW) -> tuple[str, Tokens]:
    """The tokens of two neighbouring texts as one text, from the tokens of each."""
    text, middle = left[0] + right[0], len(left[0])
    after = _moved(right[1], middle)
    while True:
        low, high = max(0, middle - window), min(len(text), middle + window)
        inside = _moved(encode(text[low:high]), low)
        if low == 0 and high == len(text):
            return text, inside
        first = _agreement(left[1], inside, False, low, high) if low > 0 else (-1, -1)
        last = _agreement(after, inside, True, low, high) if high < len(text) else (len(after), len(inside))
        if first is not None and last is not None and first[1] < last[1]:
            return text, np.concatenate([left[1][:first[0] + 1], inside[first[1] + 1:last[1]], after[last[0]:]])
        window *= 2


def _agreement(side: Tokens, inside: Tokens, forward: bool, low: int, high: int) -> tuple[int, int] | None:
    """Places in ``side`` and ``inside`` of the first token, or the last one, that both have between two characters."""
    near = np.flatnonzero((side[:, 1] >= low) & (side[:, 2] <= high))
    known = {tuple(side[k].tolist()): k for k in near.tolist() if _clean(side, k)}
    for k in range(len(inside)) if forward else range(len(inside) - 1, -1, -1):
        if (at := known.get(tuple(inside[k].tolist()))) is not None and _clean(inside, k):
            return at, k
    return None


def concatenate(encode: Callable[[str], Tokens], leaves: list[tuple[str, Tokens]]) -> tuple[str, Tokens]:
    """Joins neighbours level by level."""
    while len(leaves) > 1:
        pairs = [leaves[k:k + 2] for k in range(0, len(leaves), 2)]
        leaves = [join(encode, *p) if len(p) == 2 else p[0] for p in pairs]
    return leaves[0] if leaves else ("", np.zeros((0, 3), np.int32))


def ids_of(_: Codec, ids: list[int]) -> np.ndarray:
    """Four bytes a token while a batch of texts is gathered."""
    return np.array(ids, np.int32)


def round_trip(c: Codec, ids: list[int]) -> dict[str, object]:
    """The ids with their number and a digest of the text that they decode to, all from one visit to a worker."""
    return {"n_tokens": len(ids), "ids": ids_of(c, ids), "decoded_sha256": sha256(c.decode(ids).encode()).hexdigest()}


#: What ``round_trip`` returns, as Spark names it.
ROUND_TRIP = "struct<n_tokens:long,ids:array<int>,decoded_sha256:string>"


def encode_leaves(vocabulary: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a ``leaf`` get its ``tokens``; a few leaves leave at a time, packed."""
    c = codec(vocabulary, REMEMBERED)
    for rows in batches:
        for a in range(0, len(rows), AT_ONCE):
            part = rows.slice(a, AT_ONCE)
            found = [packed(c.tokens(t.as_py())) for t in part["leaf"]]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], [*part.schema.names, "tokens"])


def encode_texts(df: DataFrame, vocabulary: str, text: str = "text", into: str = "ids", finish: Finish = ids_of,
                 returns: str = "array<int>", leaf: int = LEAF, keep: bool = True) -> DataFrame:
    """Adds the ids of each text under ``into``, or what ``finish(codec, ids)`` makes of them (of type ``returns``).

    ``vocabulary`` is the path of a ``tokenizers`` file that every executor can
    open.  A null text counts as empty and has no ids.  Texts of any length are
    encoded whole; equal long texts are encoded once, and repeated rows get the
    same ids each.  Empty tables stay empty; other columns pass through, one
    that is named ``into`` is replaced.  Workers ``keep`` the chunks they remember
    for their next task, or give the memory back to the steps that follow.
    """
    df = df.drop(into)
    kind = T._parse_datatype_string(returns)
    arrow = to_arrow_type(kind)

    @F.arrow_udf(returns)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(vocabulary, REMEMBERED)
        for texts in batches:
            yield pa.array([finish(c, np.frombuffer(c.encode(t.as_py()), c.dtype).tolist()) for t in texts], arrow)
        if not keep:
            c.forget()
            pa.default_memory_pool().release_unused()

    whole, key = text_of(text), free_name(df, "text_key")
    long = F.length(whole) > leaf
    short = df.where(~long).withColumn(into, encode(whole))
    rest = df.where(long).withColumn(key, F.sha2(whole, 256))
    leaves = rest.groupBy(key).agg(F.first(whole).alias("text")).select(
        F.col(key).alias("key"), F.posexplode(F.transform(
            F.sequence(F.lit(0), F.floor((F.length("text") - 1) / leaf).cast("int")),
            lambda i: F.substring("text", i * leaf + 1, F.lit(leaf)))).alias("no", "leaf"))

    def joined(rows: pd.DataFrame) -> tuple[str, Tokens]:
        rows = rows.sort_values("no")
        return concatenate(codec(vocabulary, REMEMBERED).tokens, [
            (t, unpacked(x)) for t, x in zip(rows["leaf"], rows["tokens"])])

    def join_block(rows: pd.DataFrame) -> pd.DataFrame:
        text, tokens = joined(rows)
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "no": [rows["no"].min() // BLOCK], "leaf": [text],
                             "tokens": [packed(tokens)]})

    def join_text(rows: pd.DataFrame) -> pd.DataFrame:
        ids = joined(rows)[1][:, 0].tolist()
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "out": [finish(codec(vocabulary, REMEMBERED), ids)]})

    # Leaves of one text are dealt out to several tasks, so are blocks of them; the blocks meet at the text's key.
    form = "key string, no int, leaf string, tokens binary"
    coded = leaves.repartition("key", "no").mapInArrow(partial(encode_leaves, vocabulary), form)
    blocks = coded.groupBy("key", F.floor(F.col("no") / BLOCK)).applyInPandas(join_block, form)
    texts = blocks.groupBy("key").applyInPandas(join_text, f"key string, out {returns}")
    texts = texts.select(F.col("key").alias(key), F.col("out").alias(into))
    return short.unionByName(rest.join(texts, key).drop(key))


def decode_ids(df: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text of each array of ids, special tokens included; null ids give a null text."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        c = codec(vocabulary, REMEMBERED)
        return pa.array([None if (x := r.as_py()) is None else c.decode(x) for r in rows], pa.string())

    return df.withColumn(into, decode(F.col(f"`{ids}`")))
