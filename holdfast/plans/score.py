"""Scoring of raw customer rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, present, risk_tier, round_to
from holdfast.operators.models import aligned, with_score
from holdfast.plans.prepare import Preprocessor

_RAW = "_raw"


def scoring_rows(df: DataFrame, label: str = settings.LABEL) -> DataFrame:
    """What a model may see: everything but the label."""
    return df.drop(*present(df, [label]))


def tiered(df: DataFrame, score: str, high: float = settings.HIGH_RISK,
           medium: float = settings.MEDIUM_RISK) -> DataFrame:
    """Adds the rounded probability, and prediction and tier from the unrounded one."""
    s = column(score)
    known = s.isNotNull()
    return df.withColumns({
        "churn_probability": round_to(s, 6),
        "prediction": F.when(known, (s >= 0.5).cast("int")),
        "risk_tier": F.when(known, risk_tier(s, high, medium)),
    })


def score_rows(df: DataFrame, preprocessor: Preprocessor | None, model: PipelineModel,
               features: list[str] | None = None, label: str = settings.LABEL, key: str = settings.ID,
               high: float = settings.HIGH_RISK, medium: float = settings.MEDIUM_RISK) -> DataFrame:
    """The raw rows with probability, prediction and risk tier; lazy, for batches and streams."""
    rows = scoring_rows(df, label)
    names = rows.columns
    carried = rows.withColumn(_RAW, F.struct(*[column(n) for n in names]))
    if preprocessor is not None:
        if preprocessor.outliers.options.get("action") == "remove":
            raise ValueError("outlier removal would drop rows to score; use the action 'cap'")
        carried = preprocessor.transform(carried)
    wanted = aligned(carried, features, label, key)
    scored = with_score(carried.select(_RAW, *[column(w).cast("double").alias(w) for w in wanted]), model, "_score")
    out = tiered(scored.select(_RAW, "_score"), "_score")
    return out.select(f"{_RAW}.*", "churn_probability", "prediction", "risk_tier")


def predict(df: DataFrame, preprocessor: Preprocessor | None, model: PipelineModel, **options) -> DataFrame:
    """``score_rows`` for a batch, which must not be empty."""
    if df.isEmpty():
        raise ValueError("the frame to score is empty")
    return score_rows(df, preprocessor, model, **options)
