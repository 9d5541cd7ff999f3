"""Parameter search and cross-validation over fold columns."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.operators.evaluate import evaluate
from holdfast.operators.models import fit_model, with_score
from holdfast.operators.oversample import oversample
from holdfast.operators.split import assign_folds, sample_rows
from holdfast.session import stage

IMBALANCE = ("smote", "class_weight", "none")


@dataclass
class Task:
    """What all fits of one model share."""

    name: str
    features: list[str]
    label: str
    key: str
    imbalance: str = "smote"
    neighbours: int = 5
    metric: str = settings.CHAMPION_METRIC
    seed: int = settings.SEED
    parallelism: int = 2

    def __post_init__(self):
        if self.imbalance not in IMBALANCE:
            raise ValueError(f"unknown imbalance strategy {self.imbalance!r}; choose from {list(IMBALANCE)}")

    def balanced(self, train: DataFrame) -> DataFrame:
        """Training rows; oversampled ones are written once because every fit scans them."""
        rows = train.select(self.key, self.label, *self.features)
        if self.imbalance != "smote":
            return rows
        return stage(oversample(rows, self.key, self.label, self.features, self.neighbours, self.seed), "balanced")

    def fit(self, rows: DataFrame, params: dict | None) -> PipelineModel:
        return fit_model(rows, self.name, self.features, self.label, params, self.seed,
                         self.imbalance == "class_weight")

    def score(self, model: PipelineModel, rows: DataFrame) -> float:
        scored = with_score(rows.select(self.label, *self.features), model).select(self.label, "score")
        return evaluate(scored, self.label, "score").first()[self.metric]


def param_grid(grid: dict) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in product(*[grid[n] for n in names])]


def drawn_params(grid: dict, draws: int | None, seed: int) -> list[dict]:
    """A seeded draw without repeats; the whole grid when it is not larger or ``draws`` is None."""
    points = param_grid(grid)
    if draws is None or draws >= len(points):
        return points
    return random.Random(seed).sample(points, draws)


def fold_scores(df: DataFrame, task: Task, candidates: list[dict], folds: int) -> list[list[float]]:
    """Scores per candidate and fold; each fold's training rows are balanced once."""
    marked = stage(assign_folds(df, task.key, task.label, folds, task.seed), "folds")
    scores: list[list[float]] = [[] for _ in candidates]
    for fold in range(folds):
        train = task.balanced(marked.where(F.col("fold") != fold))
        held_out = marked.where(F.col("fold") == fold)

        def run(params):
            return task.score(task.fit(train, params), held_out)

        with ThreadPoolExecutor(max(1, task.parallelism)) as pool:
            for i, value in enumerate(pool.map(inheritable_thread_target(df.sparkSession)(run), candidates)):
                scores[i].append(value)
    return scores


def search(df: DataFrame, task: Task, grid: dict, draws: int | None = settings.SEARCH_DRAWS,
           folds: int = settings.SEARCH_FOLDS) -> tuple[dict, float]:
    """(best parameters, their mean score); the first of equals wins."""
    candidates = drawn_params(grid, draws, task.seed)
    means = [fmean(s) for s in fold_scores(df, task, candidates, folds)]
    best = max(range(len(candidates)), key=lambda i: means[i])
    return candidates[best], means[best]


@dataclass
class Trained:
    model: PipelineModel
    params: dict
    cv_mean: float
    cv_std: float
    search_score: float


def train_model(df: DataFrame, task: Task, grid: dict | None = None, draws: int | None = settings.SEARCH_DRAWS,
                search_folds: int = settings.SEARCH_FOLDS, folds: int = settings.CV_FOLDS) -> Trained:
    """Search on inner folds, score the winner on outer folds, refit on all rows."""
    grid = settings.GRIDS[task.name] if grid is None else grid
    params, search_score = search(df, task, grid, draws, search_folds)
    outer = fold_scores(df, task, [params], folds)[0]
    model = task.fit(task.balanced(df), params)
    return Trained(model, params, fmean(outer), pstdev(outer), search_score)


def learning_curve(df: DataFrame, task: Task, params: dict | None = None, steps: int = 5, folds: int = 3) -> DataFrame:
    """(size, train_mean, train_std, val_mean, val_std) for 10 % to 100 % of the training rows."""
    marked = stage(assign_folds(df, task.key, task.label, folds, task.seed), "folds")
    results: dict[float, list[tuple[int, float, float]]] = {}
    for fold in range(folds):
        rows, held_out = marked.where(F.col("fold") != fold), marked.where(F.col("fold") == fold)
        n = rows.count()
        for step in range(steps):
            share = 0.1 + step * 0.9 / (steps - 1)
            size = int(n * share)
            part = stage(sample_rows(rows, task.key, size, task.seed), "part")
            model = task.fit(task.balanced(part), params)
            results.setdefault(share, []).append((size, task.score(model, part), task.score(model, held_out)))
    table = [(min(r[0] for r in rs), fmean(r[1] for r in rs), pstdev([r[1] for r in rs]),
              fmean(r[2] for r in rs), pstdev([r[2] for r in rs])) for rs in results.values()]
    return df.sparkSession.createDataFrame(
        table, "size long, train_mean double, train_std double, val_mean double, val_std double").orderBy("size")
