"""Classifier evaluation over a (label, score) table.

Everything starts from counts per distinct score or per threshold step, so a
score shared by a third of the rows is one partial aggregate, and curves run
over distinct scores only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, safe_ratio
from holdfast.functions.ordering import running_totals
from holdfast.session import stage

SWEEP_METRICS = ("f1", "recall", "precision", "cost")


def default_thresholds() -> list[float]:
    return [float(t) for t in np.arange(settings.THRESHOLD_START, settings.THRESHOLD_STOP + 1e-9,
                                        settings.THRESHOLD_STEP)]


def chart_thresholds(n: int = 100) -> list[float]:
    return [float(t) for t in np.linspace(0.0, 1.0, n)]


def _rates(df: DataFrame) -> DataFrame:
    """Adds precision, recall and f1 to tp, fp, fn columns."""
    return df.withColumns({
        "precision": safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        "f1": safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
    })


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    positive, predicted = column(label) == 1, column(score) >= threshold
    return df.agg(F.count_if(~positive & ~predicted).alias("tn"), F.count_if(~positive & predicted).alias("fp"),
                  F.count_if(positive & ~predicted).alias("fn"), F.count_if(positive & predicted).alias("tp"))


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: accuracy, precision, recall, f1; a zero denominator gives 0."""
    cells = _rates(confusion(df, label, score, threshold))
    hits = F.col("tp") + F.col("tn")
    return cells.withColumn("accuracy", safe_ratio(hits, hits + F.col("fp") + F.col("fn"))).select(
        "accuracy", "precision", "recall", "f1")


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """(actual, predicted, n, share) with the share taken per actual class."""
    cells = confusion(df, label, score, threshold)
    entries = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("n"),
                        safe_ratio(F.col(n), F.col(n) + F.col(other)).alias("share"))
               for a, p, n, other in [(0, 0, "tn", "fp"), (0, 1, "fp", "tn"), (1, 0, "fn", "tp"), (1, 1, "tp", "fn")]]
    return cells.select(F.inline(F.array(*entries)))


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """(row, precision, recall, f1, support) per class, accuracy and both means."""
    cells = confusion(df, label, score, threshold)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, tp + fn
    per = {"0": (safe_ratio(tn, tn + fn), safe_ratio(tn, n0), safe_ratio(2 * tn, 2 * tn + fn + fp), n0),
           "1": (safe_ratio(tp, tp + fp), safe_ratio(tp, n1), safe_ratio(2 * tp, 2 * tp + fp + fn), n1)}
    accuracy = safe_ratio(tp + tn, n0 + n1)
    rows = dict(per)
    rows["accuracy"] = (accuracy, accuracy, accuracy, n0 + n1)
    # A class without rows and without predictions does not count in the macro mean.
    seen = [((n0 + fn) > 0).cast("int"), ((n1 + fp) > 0).cast("int")]
    rows["macro avg"] = tuple(safe_ratio(per["0"][i] * seen[0] + per["1"][i] * seen[1], seen[0] + seen[1])
                              for i in range(3)) + (n0 + n1,)
    rows["weighted avg"] = tuple(safe_ratio(per["0"][i] * n0 + per["1"][i] * n1, n0 + n1)
                                 for i in range(3)) + (n0 + n1,)
    entries = [F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.alias("support")) for name, (p, r, f, s) in rows.items()]
    return cells.select(F.inline(F.array(*entries)))


def cost_analysis(df: DataFrame, label: str, score: str, threshold: float = 0.5,
                  fp_cost: float = settings.FALSE_POSITIVE_COST,
                  fn_cost: float = settings.FALSE_NEGATIVE_COST) -> DataFrame:
    cells = confusion(df, label, score, threshold)
    fp, fn = F.col("fp") * F.lit(float(fp_cost)), F.col("fn") * F.lit(float(fn_cost))
    return cells.select("tp", "fp", "fn", "tn", F.lit(float(fp_cost)).alias("fp_cost_per_instance"),
                        F.lit(float(fn_cost)).alias("fn_cost_per_instance"), fp.alias("fp_cost_total"),
                        fn.alias("fn_cost_total"), (fp + fn).alias("total_cost"))


def sweep(df: DataFrame, label: str, score: str, thresholds: list[float] | None = None,
          fp_cost: float = settings.FALSE_POSITIVE_COST,
          fn_cost: float = settings.FALSE_NEGATIVE_COST) -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall, f1, total_cost) for all thresholds in one pass."""
    thresholds = sorted(default_thresholds() if thresholds is None else thresholds)
    step = F.when(column(score).isNull(), F.lit(-1))
    for i in reversed(range(len(thresholds))):
        step = step.when(column(score) >= thresholds[i], F.lit(i))
    step = step.otherwise(F.lit(-1))
    per_step = df.groupBy(step.alias("step")).agg(F.count("*").alias("n"),
                                                  F.count_if(column(label) == 1).alias("pos"))
    # One entry per threshold step, so the list has a known, small length.
    packed = per_step.agg(F.collect_list(F.struct("step", "n", "pos")).alias("steps"))
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])
    rows = packed.select("steps", F.inline(grid))

    def above(field: str, everything: bool = False) -> Column:
        kept = F.col("steps") if everything else F.filter("steps", lambda s: s["step"] >= F.col("i"))
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda a, s: a + s[field])

    counts = rows.select("threshold", above("pos").alias("tp"), (above("n") - above("pos")).alias("fp"),
                         (above("pos", True) - above("pos")).alias("fn"))
    return _rates(counts).withColumn("total_cost", F.col("fp") * F.lit(float(fp_cost))
                                     + F.col("fn") * F.lit(float(fn_cost)))


def best_thresholds(df: DataFrame, label: str, score: str, metrics: list[str],
                    thresholds: list[float] | None = None, **costs) -> DataFrame:
    """(metric, threshold, metric_value, f1, precision, recall): per metric the first threshold
    with its highest value, all from one sweep."""
    swept = sweep(df, label, score, thresholds, **costs)
    row = F.struct("threshold", "f1", "precision", "recall")
    best, entries = [], []
    for i, metric in enumerate(metrics):
        by = metric if metric in SWEEP_METRICS else "f1"
        value = -F.col("total_cost") if by == "cost" else F.col(by)
        best += [F.max_by(row, F.struct(value, -F.col("threshold"))).alias(f"r{i}"), F.max(value).alias(f"v{i}")]
        entries.append(F.struct(F.lit(metric).alias("metric"), F.col(f"r{i}.threshold").alias("threshold"),
                                F.col(f"v{i}").alias("metric_value"),
                                *[F.col(f"r{i}.{c}").alias(c) for c in ("f1", "precision", "recall")]))
    return swept.agg(*best).select(F.inline(F.array(*entries)))


def best_threshold(df: DataFrame, label: str, score: str, metric: str = "f1",
                   thresholds: list[float] | None = None, **costs) -> DataFrame:
    """One row: threshold, metric_value, f1, precision, recall."""
    return best_thresholds(df, label, score, [metric], thresholds, **costs).drop("metric")


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg) per distinct score."""
    return (df.where(column(score).isNotNull()).groupBy(column(score).alias("score"))
            .agg(F.count_if(column(label) == 1).alias("pos"), F.count_if(column(label) == 0).alias("neg")))


def curve(df: DataFrame, label: str, score: str, slices: int | None = None) -> tuple[DataFrame, int, int]:
    """((score, pos, neg, tp, fp) from the highest score down, all positives, all negatives)."""
    counts = stage(score_counts(df, label, score), "scores")
    positives, negatives = counts.agg(F.sum("pos"), F.sum("neg")).first()
    if not positives or not negatives:
        raise ValueError("both classes are needed for a curve")
    ordered = running_totals(counts, [F.desc("score")], {"tp": "pos", "fp": "neg"}, slices=slices)
    return ordered, positives, negatives


def _roc_auc(positives: int, negatives: int) -> Column:
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return area / F.lit(float(positives)) / F.lit(float(negatives))


def _average_precision(positives: int) -> Column:
    return F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))) / F.lit(float(positives))


def roc_auc(df: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    ordered, p, n = curve(df, label, score, slices)
    return ordered.agg(_roc_auc(p, n).alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    """Sum of precision times recall gain; no interpolation between points."""
    ordered, p, _ = curve(df, label, score, slices)
    return ordered.agg(_average_precision(p).alias("average_precision"))


def roc_points(df: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin with an infinite threshold."""
    ordered, p, n = curve(df, label, score, slices)
    points = ordered.select(F.col("score").alias("threshold"), (F.col("fp") / F.lit(float(n))).alias("fpr"),
                            (F.col("tp") / F.lit(float(p))).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                            F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def pr_points(df: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    """(threshold, precision, recall, base_rate) per distinct score, and the final (1, 0) point."""
    ordered, p, n = curve(df, label, score, slices)
    base = F.lit(p / (p + n)).alias("base_rate")
    points = ordered.select(F.col("score").alias("threshold"),
                            (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                            (F.col("tp") / F.lit(float(p))).alias("recall"), base)
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                                          F.lit(0.0).alias("recall"), base)
    return points.unionByName(end)


def _metrics(threshold: float, positives: Column, negatives: Column) -> list[Column]:
    hit = F.col("score") >= threshold
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    gain = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return [F.sum(F.when(~hit, F.col("neg")).otherwise(0)).alias("tn"),
            F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"),
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
            (area / positives / negatives).alias("roc_auc"), (gain / positives).alias("pr_auc")]


def evaluate_scores(df: DataFrame, label: str, scores: dict[str, str], threshold: float = 0.5,
                    slices: int | None = None) -> DataFrame:
    """Per named score column one row with every metric at the threshold, roc_auc and pr_auc.

    All scores share one pass: counts per (name, score), then running totals
    that start afresh with each name.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), column(c).cast("double").alias("score"))
                      for n, c in scores.items()])
    counts = stage(df.select(column(label).alias("_y"), F.inline(pairs)).where(F.col("score").isNotNull())
                   .groupBy("name", "score").agg(F.count_if(F.col("_y") == 1).alias("pos"),
                                                 F.count_if(F.col("_y") == 0).alias("neg")), "scores")
    totals = {r["name"]: r for r in counts.groupBy("name").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}
    lacking = [n for n in scores if n not in totals or not totals[n]["pos"] or not totals[n]["neg"]]
    if lacking:
        raise ValueError(f"both classes are needed to evaluate {lacking}")
    ordered = running_totals(counts, [F.desc("score")], {"tp": "pos", "fp": "neg"}, "name", slices)

    def whole(field: str) -> Column:
        every = [x for n, r in totals.items() for x in (F.lit(n), F.lit(float(r[field])))]
        return F.element_at(F.create_map(*every), F.col("name"))

    own = ordered.withColumns({"all_p": whole("pos"), "all_n": whole("neg")})
    rows = own.groupBy("name").agg(*_metrics(threshold, F.first("all_p"), F.first("all_n")))
    return _rates(rows).select(
        "name", F.lit(float(threshold)).alias("threshold"),
        safe_ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("accuracy"),
        "precision", "recall", "f1", "roc_auc", "pr_auc", "tn", "fp", "fn", "tp")


def evaluate(df: DataFrame, label: str, score: str, threshold: float = 0.5,
             slices: int | None = None) -> DataFrame:
    """One row with every metric at the threshold, roc_auc and pr_auc."""
    return evaluate_scores(df, label, {score: score}, threshold, slices).drop("name")


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """(bin, mean_score, positive_share, n) over equal right-closed bins; empty bins are left out."""
    edges = [float(e) for e in np.linspace(0.0, 1.0, bins + 1)[1:-1]]
    index = F.when(F.lit(False), F.lit(0))
    for i, edge in enumerate(edges):
        index = index.when(column(score) <= edge, F.lit(i))
    return (df.where(column(score).isNotNull()).groupBy(index.otherwise(F.lit(bins - 1)).alias("bin"))
            .agg(F.avg(column(score)).alias("mean_score"), F.avg(column(label).cast("double")).alias("positive_share"),
                 F.count("*").alias("n")))


def margin_to_score(df: DataFrame, margin: str, name: str = "score", epsilon: float = 0.0) -> DataFrame:
    """Min-max of a decision margin over the given rows; a constant margin gives 0."""
    low, high = df.agg(F.min(column(margin)), F.max(column(margin))).first()
    width = None if low is None else high - low + epsilon
    if not width or width <= 1e-12:
        return df.withColumn(name, F.when(column(margin).isNotNull(), F.lit(0.0)))
    return df.withColumn(name, (column(margin) - F.lit(low)) / F.lit(width))
