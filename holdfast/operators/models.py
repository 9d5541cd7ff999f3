"""Classifier presets on MLlib, class weights and feature assembly."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import settings
from holdfast.functions.expressions import column

DEEPEST = 30
WEIGHT = "_weight"
COLUMNS = {"featuresCol": "features", "labelCol": "_label"}


def feature_columns(df: DataFrame, label: str = settings.LABEL, key: str = settings.ID) -> list[str]:
    """Numeric columns and one-hot vectors without the label and the id; the label has to be there."""
    if label not in df.columns:
        raise KeyError(f"label column {label!r} not found; available: {df.columns}")
    return serving_columns(df, label, key)


def serving_columns(df: DataFrame, label: str = settings.LABEL, key: str = settings.ID) -> list[str]:
    return [f.name for f in df.schema.fields
            if (isinstance(f.dataType, T.NumericType) or isinstance(f.dataType, VectorUDT) and f.name.endswith("_onehot"))
            and f.name not in (label, key)]


def aligned(df: DataFrame, wanted: list[str] | None, label: str = settings.LABEL, key: str = settings.ID) -> list[str]:
    """Training features in training order; without a list, the numeric columns."""
    if wanted is None:
        return serving_columns(df, label, key)
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise KeyError(f"features missing from the rows to score: {absent}")
    return list(wanted)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight n_rows / (n_classes * n)."""
    counts = df.groupBy(column(label).alias("label")).agg(F.count("*").alias("n"))
    packed = counts.agg(F.collect_list(F.struct("label", "n")).alias("c"), F.sum("n").alias("rows"),
                        F.count("*").alias("classes"))
    return packed.select(F.inline("c"), "rows", "classes").select(
        "label", "n", (F.col("rows") / (F.col("classes") * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = WEIGHT) -> DataFrame:
    weight = F.when(F.lit(False), F.lit(1.0))
    for r in class_weights(df, label).collect():
        weight = weight.when(column(label) == F.lit(r["label"]), F.lit(r["weight"]))
    return df.withColumn(name, weight)


def _logistic(p: dict, rows: int, seed: int):
    return LogisticRegression(regParam=1.0 / (float(p.get("C", 1.0)) * max(rows, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=int(p.get("max_iter", 500)), **COLUMNS)


def _tree(p: dict, rows: int, seed: int):
    depth = p.get("max_depth", 5)
    return DecisionTreeClassifier(maxDepth=DEEPEST if depth is None else int(depth),
                                  minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                                  impurity=str(p.get("criterion", "gini")), seed=seed, **COLUMNS)


def _forest(p: dict, rows: int, seed: int):
    depth = p.get("max_depth")
    return RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)),
                                  maxDepth=DEEPEST if depth is None else int(depth),
                                  minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                                  featureSubsetStrategy=str(p.get("max_features", "sqrt")),
                                  bootstrap=bool(p.get("bootstrap", True)), seed=seed, **COLUMNS)


def _boosted(p: dict, rows: int, seed: int):
    share = float(p.get("colsample_bytree", 0.8))
    return GBTClassifier(maxIter=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth", 3)),
                         stepSize=float(p.get("learning_rate", 0.1)), subsamplingRate=float(p.get("subsample", 0.8)),
                         featureSubsetStrategy="all" if share >= 1.0 else str(share),
                         minInfoGain=float(p.get("gamma", 0.0)),
                         minInstancesPerNode=int(p.get("min_child_weight", 1)), seed=seed, **COLUMNS)


def _boosted_deep(p: dict, rows: int, seed: int):
    return GBTClassifier(maxIter=int(p.get("iterations", 100)), maxDepth=int(p.get("depth", 6)),
                         stepSize=float(p.get("learning_rate", 0.03)), maxBins=int(p.get("border_count", 64)),
                         seed=seed, **COLUMNS)


MODELS = {
    "logistic_regression": _logistic,
    "decision_tree": _tree,
    "random_forest": _forest,
    "xgboost": _boosted,
    "catboost": _boosted_deep,
}
# The first boosting preset never takes class weights.
UNWEIGHTED = {"xgboost"}


def list_models() -> list[str]:
    return sorted(MODELS)


def default_params(name: str, grids: dict | None = None) -> dict:
    """The first value of every grid list."""
    grid = (settings.GRIDS if grids is None else grids).get(name, {})
    return {k: v[0] if isinstance(v, list) and v else v for k, v in grid.items()}


def create_model(name: str, params: dict | None = None, rows: int = 1, seed: int = settings.SEED,
                 class_weight: bool = False):
    """An unfitted estimator; ``rows`` sets the strength of the logistic penalty."""
    name = name.strip()
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; choose from {list_models()}")
    merged = {**default_params(name), **(params or {})}
    estimator = MODELS[name](merged, rows, seed)
    weighted = (class_weight and name not in UNWEIGHTED) or merged.get("class_weight") == "balanced"
    return estimator.setWeightCol(WEIGHT) if weighted else estimator


def assembler(features: list[str], invalid: str) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid=invalid)


def fit_model(df: DataFrame, name: str, features: list[str], label: str, params: dict | None = None,
              seed: int = settings.SEED, class_weight: bool = False) -> PipelineModel:
    """Assembler and classifier as one model; training rows must be complete."""
    estimator = create_model(name, params, df.count(), seed, class_weight)
    rows = df.withColumn("_label", column(label).cast("double"))
    if estimator.isDefined("weightCol"):
        rows = with_class_weight(rows, "_label")
    keep = ["features", "_label"] + ([WEIGHT] if estimator.isDefined("weightCol") else [])
    ready = assembler(features, "error").transform(rows).select(*keep).persist()
    try:
        fitted = estimator.fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel([assembler(features, "keep"), fitted])


def with_score(df: DataFrame, model: PipelineModel, name: str = "score") -> DataFrame:
    """Adds the probability of the positive class; null when the model cannot tell."""
    order = df.columns
    p = F.get(vector_to_array("probability"), F.lit(1))
    scored = model.transform(df).withColumn(name, F.when(~F.isnan(p), p))
    return scored.select(*[column(c) for c in order if c != name], name)


def feature_importance(model: PipelineModel, features: list[str], spark, top: int = 20) -> DataFrame:
    """(feature, importance), largest first: tree importances or absolute coefficients."""
    fitted = model.stages[-1]
    if hasattr(fitted, "featureImportances"):
        values = fitted.featureImportances.toArray()
    elif hasattr(fitted, "coefficients"):
        values = abs(fitted.coefficients.toArray())
    else:
        raise TypeError(f"{type(fitted).__name__} has no feature importances")
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(top)
