"""Fitted state, models and their versions on storage that every executor reaches."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from holdfast.plans.prepare import Preprocessor
from holdfast.sources.files import opened


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    text = json.dumps(value, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str):
    rows = opened(lambda: spark.read.text(path, wholetext=True), path).collect()
    return json.loads(rows[0]["value"])


def save_metadata(spark: SparkSession, metadata: dict, path: str) -> None:
    write_json(spark, metadata, path)


def load_metadata(spark: SparkSession, path: str) -> dict:
    return read_json(spark, path)


def save_preprocessor(spark: SparkSession, preprocessor: Preprocessor, path: str) -> None:
    """The state as JSON, fitted lookup tables as parquet beside it."""
    tables = {f"{step}/{i}": (name, table) for step, operator in preprocessor.steps().items()
              for i, (name, table) in enumerate(sorted(operator.tables.items()))}
    for where, (_, table) in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/tables/{where}")
    saved = preprocessor.to_dict()
    saved["tables"] = {where: name for where, (name, _) in tables.items()}
    write_json(spark, saved, f"{path}/state")


def load_preprocessor(spark: SparkSession, path: str) -> Preprocessor:
    saved = read_json(spark, f"{path}/state")
    preprocessor = Preprocessor.from_dict(saved)
    for where, name in saved.get("tables", {}).items():
        step = where.split("/")[0]
        getattr(preprocessor, step).tables[name] = spark.read.parquet(f"{path}/tables/{where}")
    return preprocessor


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except AnalysisException as error:
        raise FileNotFoundError(path) from error


class ModelStore:
    """Versioned champions.

    A version counts once its commit file is there.  Each position has one such
    file, which is created only if it is absent, so of two publishers at the same
    time one gets the next position.  Readers list the folder; no table is read.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _commits(self, position: int | None = None):
        """The file system, and the folder of the commits or one of them."""
        name = "" if position is None else f"/{position:012d}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def positions(self) -> list[int]:
        """Positions with a commit, the newest first; a file that is still empty is none yet."""
        fs, path = self._commits()
        if not fs.exists(path):
            return []
        return sorted((int(f.getPath().getName()) for f in fs.listStatus(path) if f.getLen() > 0), reverse=True)

    def version_at(self, position: int) -> str:
        fs, path = self._commits(position)
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def commit(self, version: str) -> int:
        """Gives the version the next free position."""
        position = max(self.positions(), default=0) + 1
        while True:
            fs, path = self._commits(position)
            # A local file system looks first and creates then, so two may pass; a new file there is made in one step.
            local = fs.getUri().getScheme() == "file"
            if local:
                fs.mkdirs(path.getParent())
                if not self.spark._jvm.java.io.File(path.toUri().getPath()).createNewFile():
                    position += 1
                    continue
            try:
                out = fs.create(path, local)
            except Exception:  # noqa: BLE001 - another publisher was first, or the folder cannot be written
                if local or not fs.exists(path):
                    raise
                position += 1
                continue
            out.write(bytearray(version, "utf-8"))
            out.close()
            return position

    def publish(self, preprocessor: Preprocessor | None, model: PipelineModel, metadata: dict) -> str:
        version = uuid.uuid4().hex
        path = f"{self.folder}/versions/{version}"
        save_model(model, f"{path}/model")
        if preprocessor is not None:
            save_preprocessor(self.spark, preprocessor, f"{path}/preprocessor")
        save_metadata(self.spark, {**metadata, "has_preprocessor": preprocessor is not None}, f"{path}/metadata")
        self.commit(version)
        return version

    def latest(self) -> str | None:
        newest = self.positions()
        return self.version_at(newest[0]) if newest else None

    def metadata(self, version: str | None = None) -> dict:
        version = version or self.latest()
        if version is None:
            raise FileNotFoundError(f"no model was published in {self.folder}")
        return load_metadata(self.spark, f"{self.folder}/versions/{version}/metadata")

    def load(self, version: str | None = None) -> tuple[Preprocessor | None, PipelineModel, dict]:
        version = version or self.latest()
        metadata = self.metadata(version)
        path = f"{self.folder}/versions/{version}"
        fitted = load_preprocessor(self.spark, f"{path}/preprocessor") if metadata["has_preprocessor"] else None
        return fitted, load_model(f"{path}/model"), metadata
