"""Micro-batch scoring of file and Kafka streams."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from holdfast import settings
from holdfast.functions.expressions import stream_tier
from holdfast.operators.business import tier_summary
from holdfast.plans.score import score_rows
from holdfast.sources.artefacts import ModelStore

log = logging.getLogger(__name__)


class ModelScorer:
    """Scores with the newest published model and keeps the old one when a reload fails."""

    def __init__(self, store: ModelStore, label: str = settings.LABEL, key: str = settings.ID):
        self.store, self.label, self.key = store, label, key
        self.version: str | None = None
        self._loaded = None

    def refresh(self) -> None:
        try:
            newest = self.store.latest()
            if newest is not None and newest != self.version:
                self._loaded, self.version = self.store.load(newest), newest
        except Exception as error:  # noqa: BLE001 - a broken new version must not stop the stream
            log.error("reload failed, version %s stays in use: %s", self.version, error)
        if self._loaded is None:
            raise FileNotFoundError(f"no usable model in {self.store.folder}")

    def __call__(self, df: DataFrame) -> DataFrame:
        self.refresh()
        preprocessor, model, metadata = self._loaded
        return score_rows(df, preprocessor, model, metadata.get("features"), self.label, self.key)


#: What a batch ended as; one file per batch, written after its rows.
LEDGER = "batch_index int, outcome string, rows_in long, rows_out long, error_class string, error string"
#: Errors of the machines: the batch may go well elsewhere or later, so they end the query and the batch is tried again.
LOST = re.compile("ExecutorLost|executor lost|No space left|FetchFailed|OutOfMemory|MetadataFetchFailed|SparkContext was shut down|IOException")
#: A Spark error condition; the one below says no more than that a task ended.
CONDITION, ENDED = re.compile(r"\[([A-Z][A-Z_]+)(?:\.[A-Z_]+)*\]"), {"TASK_WRITE_FAILED"}


def error_class(error: Exception) -> str | None:
    """The condition or the type of an error that the rows cause; None for lost executors, full disks and the like."""
    text = str(error)
    if isinstance(error, (OSError, MemoryError)) or LOST.search(text):
        return None
    named = [c for c in CONDITION.findall(text) if c not in ENDED]
    if named:
        return named[0]
    of_spark = type(error).__module__.startswith(("pyspark.", "py4j."))
    # What Spark reports without a condition is not known to come from the rows.
    return type(error).__name__ if not of_spark or isinstance(error, (AnalysisException, PythonException)) else None


def batch_writer(score: Callable[[DataFrame], DataFrame], output: str, failed: str,
                 numbered: bool = True) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: score, relabel the tier, write one folder per batch, then its line of the ledger.

    Rows count once the ledger has their batch, and the ledger has one outcome
    of each batch, the last: a repeated batch replaces what it ended as before,
    be it scored or failed.  A batch whose rows cannot be scored goes to
    ``failed`` with its error and the stream goes on.  Errors of the machines
    end the query before the offset is committed, so nothing is lost.
    """

    def write(df: DataFrame, epoch: int) -> None:
        index, rows_in = epoch + 1, df.count()
        try:
            rows = score(df)
            if numbered:
                rows = rows.withColumns({"risk_tier": stream_tier(F.col("churn_probability")),
                                         "batch_index": F.lit(index)})
            rows.write.mode("overwrite").json(f"{output}/batch={index}")
            line = (index, "scored", rows_in, rows_in, None, None)
        except Exception as error:  # noqa: BLE001 - the rows are kept with their error
            kind = error_class(error)
            if kind is None:
                raise
            log.error("batch %s failed: %s", index, error)
            kept = df.select(F.to_json(F.struct("*")).alias("row"), F.lit(str(error)).alias("error"),
                             F.lit(index).alias("batch_index"))
            kept.write.mode("overwrite").json(f"{failed}/batch={index}")
            line = (index, "failed", rows_in, 0, kind, str(error))
        # One line, so one file, which is there as a whole or not at all.
        done = df.sparkSession.createDataFrame([line], LEDGER).coalesce(1)
        done.write.mode("overwrite").json(f"{output}-ledger/batch={index}")

    return write


def read_ledger(spark: SparkSession, output: str) -> DataFrame:
    """The outcome of each batch so far."""
    return spark.read.schema(LEDGER).json(f"{output}-ledger/batch=*")


def _of_outcome(spark: SparkSession, folder: str, output: str, outcome: str, schema: T.StructType) -> DataFrame:
    """The rows below ``folder`` of the batches that ended so."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    ended = read_ledger(spark, output).where(F.col("outcome") == outcome).select(F.col("batch_index").alias("batch")).distinct()
    if ended.isEmpty():
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(whole).option("basePath", folder).json(f"{folder}/batch=*")
    # One row per batch, and few batches for a folder.
    return rows.join(ended, "batch", "left_semi").select(*[F.col(f"`{f.name}`") for f in schema.fields])


def read_failed(spark: SparkSession, output: str, failed: str | None = None) -> DataFrame:
    """``row, error, batch_index`` of the rows in batches that failed."""
    schema = T._parse_datatype_string("row string, error string, batch_index int")
    return _of_outcome(spark, failed or f"{output}-failed", output, "failed", schema)


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, file_format: str = "parquet",
                files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.format(file_format).schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger).load(folder))


def run_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], output: str, checkpoint: str,
               failed: str | None = None, numbered: bool = True, once: bool = True) -> StreamingQuery:
    """Start the scoring query; ``once`` takes what is available and ends.

    Batches that fail are kept in ``failed``, by default beside the output.
    """
    writer = (stream.writeStream.foreachBatch(batch_writer(score, output, failed or f"{output}-failed", numbered))
              .option("checkpointLocation", checkpoint))
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_scored(spark: SparkSession, output: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches that the ledger counts as scored."""
    return _of_outcome(spark, output, output, "scored", schema)


def run_summary(scored: DataFrame, seconds: float | None = None) -> DataFrame:
    """Rows, percentage per tier and, with ``seconds``, rows per second."""
    return tier_summary(scored, "risk_tier", seconds)


def query_seconds(query: StreamingQuery) -> float:
    """Time the batches of a query took, from its progress reports."""
    return sum(p["batchDuration"] if isinstance(p, dict) else p.batchDuration for p in query.recentProgress) / 1000.0
