import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import business, champion, evaluate, models, split
from tests.conftest import values


def labelled(spark, n, share=0.3, repartition=5):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 10 < int(share * 10)).cast("int").alias("y")) \
        .repartition(repartition)


@pytest.mark.parametrize("n", [10, 200, 1003])
def test_split_sizes_and_shares(spark, n):
    df = labelled(spark, n)
    train, val, test = split.split(df, "k", "y")
    n_test = math.ceil(0.2 * n)
    n_val = math.ceil(0.125 * (n - n_test))
    assert (train.count(), val.count(), test.count()) == (n - n_test - n_val, n_val, n_test)
    assert sorted(values(train, "k") + values(val, "k") + values(test, "k")) == list(range(n))
    positives = df.where("y = 1").count()
    assert abs(test.where("y = 1").count() - positives * 0.2) <= 1


def test_split_is_repeatable_and_seeded(spark):
    df = labelled(spark, 100)
    first = sorted(values(split.split(df, "k", "y")[2], "k"))
    again = sorted(values(split.split(df.repartition(9), "k", "y")[2], "k"))
    other = sorted(values(split.split(df, "k", "y", seed=7)[2], "k"))
    assert first == again != other
    plain = split.split(df, "k", "y", stratify=False)
    assert [p.count() for p in plain] == [70, 10, 20]


def test_split_errors(spark):
    with pytest.raises(KeyError):
        split.split(labelled(spark, 20), "k", "label")
    with pytest.raises(ValueError, match="at least 10"):
        split.split(labelled(spark, 9), "k", "y")
    with pytest.raises(ValueError, match="missing"):
        split.split(labelled(spark, 20).withColumn("y", F.when(F.col("k") > 3, F.col("y"))), "k", "y")
    with pytest.raises(ValueError, match="unique"):
        split.split(labelled(spark, 40).withColumn("k", F.lit(1)), "k", "y")


def test_equal_hashes_are_parted_by_key(spark, monkeypatch):
    monkeypatch.setattr(split, "hash_order", lambda key, seed, method: (F.lit(5)).cast("bigint"))
    df = labelled(spark, 30)
    assert sorted(values(split.sample_rows(df, "k", 7), "k")) == list(range(7))


def test_quotas_by_largest_remainder(spark):
    def quotas(counts, size):
        classes = spark.createDataFrame(list(counts.items()), "name string, n long")
        return {r["name"]: r["q"] for r in split.shared_out(classes, "n", size, "q").collect()}

    assert quotas({"0": 7, "1": 3}, 8) == {"0": 6, "1": 2}
    assert quotas({"a": 5, "b": 5}, 5) == {"a": 3, "b": 2}
    assert sum(quotas({"a": 11, "b": 7, "c": 3}, 10).values()) == 10


def test_split_and_folds_of_many_classes(spark):
    """More classes than fit one expression; one holds a third of the rows, most a few."""
    df = spark.range(9000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("c"), F.col("id") % 1400)).alias("y")).repartition(6)
    rows = split.assign_split(df, "k", "y").collect()
    assert Counter(r["split"] for r in rows) == {"test": 1800, "val": 900, "train": 6300}
    n, test = Counter(r["y"] for r in rows), Counter(r["y"] for r in rows if r["split"] == "test")
    assert len(n) > 1200 and all(abs(test[y] - 0.2 * c) <= 1 for y, c in n.items())
    folds = Counter((r["y"], r["fold"]) for r in split.assign_folds(df, "k", "y", 3).collect())
    assert all(max(folds[y, f] for f in range(3)) - min(folds[y, f] for f in range(3)) <= 1 for y in n)
    assert sum(folds.values()) == 9000


def test_sample(spark):
    df = labelled(spark, 300)
    assert split.sample_rows(df, "k", 41).distinct().count() == 41
    assert split.sample_rows(df, "k", 999).count() == 300
    assert split.sample_rows(df, "k", 0).count() == 0


def test_folds(spark):
    marked = split.assign_folds(labelled(spark, 203), "k", "y", 5)
    for y in (0, 1):
        sizes = Counter(values(marked.where(F.col("y") == y), "fold"))
        assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    with pytest.raises(ValueError):
        split.assign_folds(labelled(spark, 10), "k", "y", 5)


def test_summary(spark):
    rows = {r["split"]: r for r in split.split_summary(
        split.assign_split(labelled(spark, 100), "k", "y"), "y").collect()}
    assert (rows["test"]["n_rows"], rows["test"]["pct_of_total"], rows["test"]["label_rate_pct"]) == (20, 20.0, 30.0)


# ---- evaluation ------------------------------------------------------------------------

def scores(n=400, seed=0, ties=20):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    s = np.round(np.clip(0.3 * y + rng.random(n) * 0.7, 0, 1) * ties) / ties
    return y, s


def table(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double").repartition(4)


def brute_auc(y, s):
    diff = s[y == 1][:, None] - s[y == 0][None, :]
    return float(((diff > 0) + 0.5 * (diff == 0)).mean())


def brute_ap(y, s):
    total, seen = 0.0, 0
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        tp = int(y[hit].sum())
        total += (tp - seen) * tp / int(hit.sum())
        seen = tp
    return total / y.sum()


@pytest.mark.parametrize("slices", [9, None])
@pytest.mark.parametrize("ties", [3, 20, 10_000])
def test_auc_and_average_precision(spark, ties, slices):
    y, s = scores(ties=ties)
    df = table(spark, y, s)
    assert evaluate.roc_auc(df, "y", "s", slices).first()[0] == pytest.approx(brute_auc(y, s))
    assert evaluate.average_precision(df, "y", "s", slices).first()[0] == pytest.approx(brute_ap(y, s))


def test_evaluate_row(spark):
    y, s = scores()
    row = evaluate.evaluate(table(spark, y, s), "y", "s", 0.5).first()
    hit = s >= 0.5
    tp, fp = int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum())
    fn, tn = int((~hit & (y == 1)).sum()), int((~hit & (y == 0)).sum())
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (tn, fp, fn, tp)
    assert row["precision"] == pytest.approx(tp / (tp + fp)) and row["recall"] == pytest.approx(tp / (tp + fn))
    assert row["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn)) and row["accuracy"] == pytest.approx((tp + tn) / 400)
    assert row["roc_auc"] == pytest.approx(brute_auc(y, s)) and row["pr_auc"] == pytest.approx(brute_ap(y, s))


def test_one_class_only(spark):
    df = table(spark, np.zeros(5), np.linspace(0, 1, 5))
    with pytest.raises(ValueError):
        evaluate.roc_auc(df, "y", "s")
    cost = evaluate.cost_analysis(df, "y", "s").first()
    assert (cost["tp"], cost["fn"], cost["fp"], cost["tn"], cost["total_cost"]) == (0, 0, 3, 2, 30.0)
    metrics = evaluate.threshold_metrics(df, "y", "s", 2.0).first()
    assert tuple(metrics) == (1.0, 0.0, 0.0, 0.0)


def test_curves_end_where_they_should(spark):
    y, s = scores()
    roc = evaluate.roc_points(table(spark, y, s), "y", "s", 6).orderBy("fpr", "tpr").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"], roc[0]["threshold"]) == (0.0, 0.0, math.inf)
    assert (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0) and len(roc) == len(set(s)) + 1
    pr = evaluate.pr_points(table(spark, y, s), "y", "s").collect()
    assert any((r["precision"], r["recall"], r["threshold"]) == (1.0, 0.0, None) for r in pr)
    assert all(r["base_rate"] == pytest.approx(y.mean()) for r in pr)


def test_sweep_matches_single_thresholds(spark):
    y, s = scores(ties=20)
    df = table(spark, y, s)
    grid = evaluate.default_thresholds()
    assert len(grid) == 17
    for r in evaluate.sweep(df, "y", "s").collect():
        hit = s >= r["threshold"]
        assert (r["tp"], r["fp"], r["fn"]) == (int(y[hit].sum()), int((1 - y[hit]).sum()), int(y[~hit].sum()))
    for metric in ("f1", "recall", "precision", "cost", "anything"):
        best = evaluate.best_threshold(df, "y", "s", metric).first()
        by = {"cost": "total_cost", "anything": "f1"}.get(metric, metric)
        rows = sorted(evaluate.sweep(df, "y", "s").collect(), key=lambda r: r["threshold"])
        pick = min if metric == "cost" else max
        want = next(r for r in rows if r[by] == pick(x[by] for x in rows))
        assert best["threshold"] == want["threshold"] and best["f1"] == want["f1"]


def test_report_and_matrix(spark):
    y, s = scores()
    rows = {r["row"]: r for r in evaluate.classification_report(table(spark, y, s), "y", "s").collect()}
    assert rows["0"]["support"] + rows["1"]["support"] == 400 == rows["macro avg"]["support"]
    assert rows["macro avg"]["f1"] == pytest.approx((rows["0"]["f1"] + rows["1"]["f1"]) / 2)
    assert rows["weighted avg"]["recall"] == pytest.approx(rows["accuracy"]["recall"])
    shares = evaluate.confusion_matrix(table(spark, y, s), "y", "s").groupBy("actual").agg(F.sum("share")).collect()
    assert [r[1] for r in shares] == pytest.approx([1.0, 1.0])


def test_calibration_bins_are_right_closed(spark):
    df = table(spark, [1, 0, 1, 0], [0.1, 0.0, 0.11, 1.0])
    got = {r["bin"]: (r["n"], r["positive_share"]) for r in evaluate.calibration(df, "y", "s").collect()}
    assert got == {0: (2, 0.5), 1: (1, 1.0), 9: (1, 0.0)}


def test_margins(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (2.0,)], "m double")
    assert values(evaluate.margin_to_score(df, "m"), "score") == [0.0, 0.5, 1.0]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "m double")
    assert values(evaluate.margin_to_score(flat, "m"), "score") == [0.0, 0.0]


# ---- champions, weights, business ---------------------------------------------------------

def test_champion(spark):
    rows = [(0, "a", 0.7), (1, "b", 0.9), (2, "c", 0.9), (3, "d", float("nan")), (4, "e", None)]
    df = spark.createDataFrame(rows, "position int, model_name string, roc_auc double")
    assert champion.elect_champion(df).first()["model_name"] == "b"
    assert values(champion.compare_models(df.where("position < 3")), "model_name") == ["b", "c", "a"]
    assert champion.compare_models(df.where("position in (0, 4)")).collect()[-1]["model_name"] == "e"
    with pytest.raises(RuntimeError):
        champion.elect_champion(df.where("position > 2"))


def test_class_weights(spark):
    df = labelled(spark, 100)
    got = {r["label"]: r["weight"] for r in models.class_weights(df, "y").collect()}
    assert got == {0: pytest.approx(100 / 140), 1: pytest.approx(100 / 60)}
    assert sorted({round(w, 6) for w in values(models.with_class_weight(df, "y"), "_weight")}) == [0.714286, 1.666667]


def test_business(spark):
    df = labelled(spark, 1000, 1.0)
    row = business.revenue_at_risk(df, "y").first()
    assert (row["revenue_at_risk"], row["intervention_cost"]) == (2_080_000.0, 50_000.0)
    assert row["net_benefit"] == pytest.approx(678_000) and row["roi_pct"] == pytest.approx(1356.0)
    empty = business.revenue_at_risk(df.where("false"), "y").first()
    assert empty["n_customers"] == 0 and empty["roi_pct"] is None
    tiers = spark.createDataFrame([("HIGH",), ("HIGH",), ("LOW",), ("Medium",)], "risk_tier string")
    got = business.tier_summary(tiers, seconds=2.0).first()
    assert (got["n_high"], got["pct_high"], got["pct_low"], got["rows_per_second"]) == (2, 50.0, 25.0, 2.0)
    assert business.tier_summary(tiers.where("false")).first()["pct_high"] == 0.0
    assert {r["tier"]: r["n"] for r in business.tier_counts(tiers).collect()} == {"HIGH": 2, "LOW": 1, "Medium": 1}
