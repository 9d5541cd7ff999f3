"""Kafka messages; the connector package has to be on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON values to columns; a value that is no such object gives null columns."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def encode_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON value per row, missing fields included."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def read_topic(spark: SparkSession, servers: str, topic: str, schema: T.StructType,
               group: str | None = None, rows_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if group:
        reader = reader.option("kafka.group.id", group)
    if rows_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", rows_per_trigger)
    return decode_messages(reader.load(), schema)


def write_topic(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    (encode_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("kafka.acks", "all").option("topic", topic).save())
