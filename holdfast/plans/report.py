"""What a training run leaves behind: the champion, its chart tables, and a manifest that is written last."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.ordering import running_totals
from holdfast.operators.evaluate import chart_thresholds, score_counts
from holdfast.operators.models import feature_importance
from holdfast.plans.prepare import Preprocessor
from holdfast.plans.train import TrainingRun
from holdfast.session import stage
from holdfast.sources.artefacts import ModelStore, read_json, write_json


def _rates(tp: Column, fp: Column, fn: Column) -> list[Column]:
    return [F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
            F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
            F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1")]


def chart_tables(df: DataFrame, label: str, score: str, threshold: float = 0.5, bins: int = 10,
                 thresholds: list[float] | None = None) -> dict[str, DataFrame]:
    """The tables behind the charts of one scored set, by name.

    ``roc`` and ``pr`` have a row per distinct score, ``confusion`` the four cells
    at ``threshold``, ``calibration`` equal right-closed bins without empty ones,
    ``thresholds`` the rates at each threshold.  The rows are read once: all tables
    come from one written table of counts per score.  Rows without a score or a
    label of 0 or 1 do not count; without both classes there is no curve.
    """
    counts = stage(score_counts(df, label, score).where("pos + neg > 0").withColumn("score", F.col("score").cast("double")), "counts")
    p, n = counts.agg(F.sum("pos"), F.sum("neg")).first()
    if not p or not n:
        raise ValueError("both classes are needed for the charts")
    curve = stage(running_totals(counts, [F.desc("score")], {"tp": "pos", "fp": "neg"}), "curve")
    hit = F.col("score") >= threshold
    cells = [F.struct(F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"), F.col(f"n{actual}{predicted}").alias("n"))
             for actual in (0, 1) for predicted in (0, 1)]
    confusion = counts.agg(*[F.sum(F.when(hit == F.lit(bool(predicted)), F.col("pos" if actual else "neg")).otherwise(0)).alias(
        f"n{actual}{predicted}") for actual in (0, 1) for predicted in (0, 1)])
    edges = [float(e) for e in np.linspace(0.0, 1.0, bins + 1)[1:-1]]
    number = sum(((F.col("score") > e).cast("int") for e in edges), F.lit(0))
    rows = F.col("pos") + F.col("neg")
    calibration = counts.groupBy(number.alias("bin")).agg(
        (F.sum(F.col("score") * rows) / F.sum(rows)).alias("mean_score"), (F.sum("pos") / F.sum(rows)).alias("positive_share"),
        F.sum(rows).alias("n"))
    at = F.array(*[F.lit(float(t)) for t in (chart_thresholds() if thresholds is None else thresholds)])
    swept = counts.select("score", "pos", "neg", F.explode(at).alias("threshold")).groupBy("threshold").agg(
        F.sum(F.when(F.col("score") >= F.col("threshold"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("score") >= F.col("threshold"), F.col("neg")).otherwise(0)).alias("fp"))
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    return {
        "roc": curve.select(F.col("score").alias("threshold"), (fp / float(n)).alias("fpr"), (tp / float(p)).alias("tpr")),
        "pr": curve.select(F.col("score").alias("threshold"), (tp / (tp + fp)).alias("precision"), (tp / float(p)).alias("recall")),
        "confusion": confusion.select(F.inline(F.array(*cells))),
        "calibration": calibration,
        "thresholds": swept.select("threshold", *_rates(tp, fp, F.lit(float(p)) - tp)),
    }


def write_tables(spark: SparkSession, folder: str, tables: dict[str, DataFrame], facts: dict | None = None) -> str:
    """Writes the tables into a run folder of their own and names it in its manifest, which comes last; returns the folder."""
    run = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{run}/{name}")
    write_json(spark, {**(facts or {}), "tables": sorted(tables)}, f"{run}/manifest")
    return run


def read_tables(spark: SparkSession, run: str) -> tuple[dict[str, DataFrame], dict]:
    """The tables and facts of a finished run; one without a manifest was not finished."""
    try:
        facts = read_json(spark, f"{run}/manifest")
    except (FileNotFoundError, AnalysisException) as error:
        raise FileNotFoundError(f"{run} has no manifest, so it is no finished run") from error
    return {name: spark.read.parquet(f"{run}/{name}") for name in facts["tables"]}, facts


def save_run(run: TrainingRun, preprocessor: Preprocessor | None, store: ModelStore, folder: str, label: str,
             learning: DataFrame | None = None) -> str:
    """Publishes the champion and writes its tables: results of all models, charts, importance, learning curve if given."""
    spark = store.spark
    tables = {"results": run.results, **chart_tables(run.scores, label, "score", run.metadata["optimal_threshold"]),
              "importance": feature_importance(run.model, run.features, spark)}
    if learning is not None:
        tables["learning_curve"] = learning
    version = store.publish(preprocessor, run.model, run.metadata)
    return write_tables(spark, folder, tables, {**run.metadata, "version": version})
