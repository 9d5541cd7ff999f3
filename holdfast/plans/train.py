"""A full training run: several models, one champion."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from holdfast import settings
from holdfast.operators.champion import elect_champion
from holdfast.operators.evaluate import best_threshold, evaluate
from holdfast.operators.models import feature_columns, with_score
from holdfast.plans.search import Task, Trained, train_model

RESULT_SCHEMA = ("position int, model_name string, best_params string, cv_mean double, cv_std double, "
                 "search_score double, accuracy double, precision double, recall double, f1 double, "
                 "roc_auc double, pr_auc double, optimal_threshold double")


@dataclass
class TrainingRun:
    results: DataFrame
    champion: str
    model: PipelineModel
    features: list[str]
    metadata: dict
    #: Label and score of the champion on the test rows.
    scores: DataFrame


def train_and_validate(train: DataFrame, val: DataFrame, task: Task, grid: dict | None = None,
                       threshold_metric: str = "f1", **search) -> tuple[Trained, dict]:
    """One model: search and fit, metrics at 0.5 on the validation rows, best threshold."""
    trained = train_model(train, task, grid, **search)
    scored = with_score(val.select(task.label, *task.features), trained.model).select(task.label, "score").persist()
    try:
        metrics = evaluate(scored, task.label, "score").first().asDict()
        threshold = best_threshold(scored, task.label, "score", threshold_metric).first()["threshold"]
    finally:
        scored.unpersist()
    return trained, {**metrics, "optimal_threshold": threshold}


def run_training(train: DataFrame, val: DataFrame, test: DataFrame, *, label: str = settings.LABEL,
                 key: str = settings.ID, models: list[str] | None = None, grids: dict | None = None,
                 metric: str = settings.CHAMPION_METRIC, imbalance: str = "smote",
                 threshold_metric: str = "f1", seed: int = settings.SEED, parallelism: int = 2,
                 **search) -> TrainingRun:
    """Train, validate, elect by the validation metric, test the champion at its threshold.

    The results table belongs to this run only.
    """
    names = list(settings.GRIDS) if models is None else models
    if not names:
        raise ValueError("no models to train")
    features = feature_columns(train, label, key)
    fitted: dict[str, Trained] = {}
    rows = []
    for position, name in enumerate(names):
        task = Task(name, features, label, key, imbalance, metric=metric, seed=seed, parallelism=parallelism)
        grid = (grids or settings.GRIDS)[name]
        trained, m = train_and_validate(train, val, task, grid, threshold_metric, **search)
        fitted[name] = trained
        rows.append((position, name, json.dumps(trained.params), trained.cv_mean, trained.cv_std,
                     trained.search_score, m["accuracy"], m["precision"], m["recall"], m["f1"], m["roc_auc"],
                     m["pr_auc"], m["optimal_threshold"]))
    results = train.sparkSession.createDataFrame(rows, RESULT_SCHEMA)
    winner = elect_champion(results, metric).first()
    model = fitted[winner["model_name"]].model
    scored = with_score(test.select(label, *features), model).select(label, "score")
    tested = evaluate(scored, label, "score", winner["optimal_threshold"]).first().asDict()
    metadata = {
        "model_name": winner["model_name"],
        "best_params": json.loads(winner["best_params"]),
        "val_metrics": {m: winner[m] for m in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")},
        "test_metrics": tested,
        "optimal_threshold": winner["optimal_threshold"],
        "champion_metric": metric,
        "features": features,
        "trained_at": datetime.now(timezone.utc).isoformat(),
    }
    return TrainingRun(results, winner["model_name"], model, features, metadata, scored)
