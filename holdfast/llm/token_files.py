"""Token ids as flat binary files with 64-bit offsets, read back through memory maps.

``name.bin`` holds the ids of its documents one after another as little-endian
unsigned integers of the smallest width that fits the vocabulary;
``name.offsets`` the n + 1 positions at which documents begin and end, and
``name.docs`` their n ids, both as little-endian 64-bit integers.  Files follow
one another in ascending order of document id, so the position of a file in the
whole stream is the prefix sum of the counts before it.

The folder has to be one that every executor sees.  Files get names of their own
for each attempt of a task; a Parquet table of the finished attempts names the
valid ones, so lost executors and repeated tasks leave no doubt.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.codec import codec
from holdfast.llm.text import text_of

MANIFEST = "part int, name string, docs long, no_id long, tokens long, dtype string"
MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("no_id", pa.int64()),
                            ("tokens", pa.int64()), ("dtype", pa.string())])
#: Documents that a reader hands on at a time.
BATCH = 4096


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_tokens(df: DataFrame, folder: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int | None = 0) -> DataFrame:
    """Encodes each whole text, adds ``end_id``, and writes the files in ascending order of document id.

    Returns the table of files.  A null text has no ids but the end id; rows
    without an id come first; rows with equal ids are ordered by a hash of their
    texts, so equal rows are the only ones whose order is open.  An empty table
    writes no files.  Other columns are not read.
    """
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        end = b"" if end_id is None else np.array([end_id], c.dtype).tobytes()
        name = f"tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        system, path = _open(folder)
        offsets, docs, no_id, out = array("q", [0]), array("q"), 0, None
        for batch in batches:
            if out is None:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}.bin")
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = c.encode(t) + end
                out.write(packed)
                offsets.append(offsets[-1] + len(packed) // c.dtype.itemsize)
                docs.append(0 if d is None else d)
                no_id += d is None
        if out is not None:
            out.close()
            for kind, numbers in (("offsets", offsets), ("docs", docs)):
                with system.open_output_stream(f"{path}/{name}.{kind}") as f:
                    f.write(np.array(numbers, "<i8").tobytes())
            row = [TaskContext.get().partitionId(), name, len(docs), no_id, offsets[-1], c.dtype.str]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], MANIFEST_ARROW.names).cast(MANIFEST_ARROW)

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/files")
    return df.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/files")


def _mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """A file as an array; memory-mapped where the file system allows it."""
    system, path = _open(folder)
    if isinstance(system, fs.LocalFileSystem):
        source = pa.memory_map(f"{path}/{name}")
    else:
        source = system.open_input_file(f"{path}/{name}")
    with source as f:
        return np.frombuffer(f.read_buffer(), dtype)


def list_of_ids(ids: np.ndarray) -> list[int]:
    return ids.tolist()


def crc32(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def read_tokens(spark: SparkSession, folder: str, into: str = "ids", finish: Callable[[np.ndarray], object] = list_of_ids,
                returns: str = "array<long>") -> DataFrame:
    """``doc_id, start, n_tokens`` of each document and its ids, or what ``finish(ids)`` makes of them.

    ``start`` counts the ids of all documents before.  The driver reads one row
    per file and adds up their counts.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/files").orderBy("part").collect()
    base, rows = 0, []
    for f in files:
        rows.append((*f, base))
        base += f["tokens"]
    schema = f"doc_id long, start long, n_tokens long, {into} {returns}"
    if not rows:
        return spark.createDataFrame([], schema)
    table = spark.createDataFrame(rows, f"{MANIFEST}, base long").repartition(len(rows))

    def read(batches):
        for batch in batches:
            for f in batch.itertuples():
                ids = _mapped(folder, f"{f.name}.bin", f.dtype)
                offsets, docs = _mapped(folder, f"{f.name}.offsets", "<i8"), _mapped(folder, f"{f.name}.docs", "<i8")
                for a in range(0, f.docs, BATCH):
                    b = min(a + BATCH, f.docs)
                    yield pd.DataFrame({
                        "doc_id": pd.array(docs[a:b], "Int64").copy() if a >= f.no_id else
                        pd.array([None if k < f.no_id else int(docs[k]) for k in range(a, b)], "Int64"),
                        "start": offsets[a:b] + f.base, "n_tokens": np.diff(offsets[a:b + 1]),
                        into: [finish(ids[offsets[k]:offsets[k + 1]]) for k in range(a, b)]})

    return table.mapInPandas(read, schema)
