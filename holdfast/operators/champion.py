"""Choosing among the evaluated models of one run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column


def elect_champion(results: DataFrame, metric: str = settings.CHAMPION_METRIC, order: str = "position") -> DataFrame:
    """The row with the highest metric; NaN is passed over and the first of equals wins."""
    value = column(metric).cast("double")
    best = results.where(value.isNotNull() & ~F.isnan(value)).orderBy(value.desc(), column(order).asc()).limit(1)
    rows = best.collect()
    if not rows:
        raise RuntimeError(f"no model has a valid {metric!r}")
    return results.sparkSession.createDataFrame(rows, results.schema)


def compare_models(results: DataFrame, metric: str = settings.CHAMPION_METRIC, order: str = "position") -> DataFrame:
    """All models, best metric first; a missing metric counts as -1."""
    value = F.coalesce(column(metric).cast("double"), F.lit(-1.0))
    return results.withColumn("rank_value", value).orderBy(F.desc("rank_value"), column(order))
