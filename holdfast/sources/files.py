"""Customer CSV files, split tables and scored JSON lines."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import settings
from holdfast.functions.expressions import column, is_text, present, to_number, yes_no
from holdfast.operators.quality import quality_report

FORMATS = ("csv", "parquet")


class SchemaError(ValueError):
    """Expected columns are missing."""


def check_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """Raise when an expected column is missing; return the extra ones."""
    absent = [c for c in expected if c not in df.columns]
    if absent:
        raise SchemaError(f"missing columns: {absent}")
    return [c for c in df.columns if c not in expected]


def coerce_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    names = [n for n in present(df, columns) if is_text(df, n)]
    return df.withColumns({n: to_number(column(n)) for n in names}) if names else df


def map_yes_no(df: DataFrame, columns: list[str]) -> DataFrame:
    """Yes to 1, No to 0 and other texts to null; numeric columns stay as they are."""
    names = [n for n in present(df, columns) if is_text(df, n)]
    return df.withColumns({n: yes_no(column(n)) for n in names}) if names else df


def opened(read, path: str) -> DataFrame:
    """The frame of ``read()``; a missing path raises FileNotFoundError."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() and "PATH_NOT_FOUND" in error.getCondition():
            raise FileNotFoundError(path) from error
        raise


def read_raw_csv(spark: SparkSession, path: str, integers: list[str] = settings.INTEGER_COLUMNS,
                 doubles: list[str] = settings.DOUBLE_COLUMNS) -> DataFrame:
    """A CSV file with header; columns are matched by name and typed by declaration.

    Texts that stand for a missing value become null.  No type inference, so
    the file is read once and only for the columns in use.
    """
    text = opened(lambda: spark.read.option("header", True).option("escape", '"')
                  .option("emptyValue", "").csv(path), path)

    def value(name: str) -> Column:
        c = F.when(~column(name).isin(settings.CSV_MISSING), column(name))
        if name in integers:
            return to_number(c).cast("int")
        return to_number(c) if name in doubles else c

    return text.select(*[value(n).alias(n) for n in text.columns])


def ingest(spark: SparkSession, path: str, expected: list[str] = settings.EXPECTED_COLUMNS,
           numbers: list[str] = settings.COERCED_COLUMNS, binary: list[str] = settings.YES_NO_COLUMNS) -> DataFrame:
    """Read, check the column names, coerce numbers, map Yes/No."""
    raw = read_raw_csv(spark, path)
    check_columns(raw, expected)
    return map_yes_no(coerce_numbers(raw, numbers), binary)


def ingest_with_report(spark: SparkSession, path: str, label: str = settings.LABEL, key: str = settings.ID,
                       **options) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The ingested rows, and the quality report of this load: nulls, duplicates, label rate."""
    df = ingest(spark, path, **options)
    return df, quality_report(df, label, key)


def write_splits(parts: dict[str, DataFrame], folder: str, file_format: str = "csv") -> None:
    """One table per split under ``folder``, and their schema as JSON text."""
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format!r}; choose from {list(FORMATS)}")
    for name, df in parts.items():
        writer = df.write.mode("overwrite")
        path = f"{folder}/{name}.{file_format}"
        writer.option("header", True).option("escape", '"').csv(path) if file_format == "csv" else writer.parquet(path)
    first = next(iter(parts.values()))
    first.sparkSession.createDataFrame([(first.schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{folder}/schema")


def load_splits(spark: SparkSession, folder: str, file_format: str = "csv",
                names: list[str] = settings.SPLITS) -> dict[str, DataFrame]:
    rows = opened(lambda: spark.read.text(f"{folder}/schema", wholetext=True), f"{folder}/schema").collect()
    schema = T.StructType.fromJson(json.loads(rows[0]["value"]))
    parts = {}
    for name in names:
        path = f"{folder}/{name}.{file_format}"
        reader = spark.read.schema(schema)
        if file_format == "csv":
            parts[name] = opened(lambda: reader.option("header", True).option("escape", '"').csv(path), path)
        else:
            parts[name] = opened(lambda: reader.parquet(path), path)
    return parts


def append_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row, added to what is there."""
    df.write.mode("append").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return opened(lambda: spark.read.schema(schema).json(path), path)
