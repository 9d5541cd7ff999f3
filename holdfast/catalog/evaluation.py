"""Queries for splits, preparation chains, evaluation, tiers, EDA and business aggregates."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.catalog import query
from holdfast.catalog.common import (
    CATEGORICAL, FEATURES, NUMERIC, YES_NO, fixed, on_base, on_curve, on_raw, on_scores, sql_fixed,
)
from holdfast.catalog.preparation import _CONTRACTS, _INTERNET, sql_edges, sql_features, sql_quantile_bin
from holdfast.functions.expressions import high_risk_profile, risk_tier, round_to, stream_tier
from holdfast.operators import business, champion, correlation, eda, evaluate, split
from holdfast.operators.binning import BinConfig, FeatureBinner
from holdfast.operators.encode import OneHotEncoder
from holdfast.operators.impute import MissingValueHandler
from holdfast.operators.models import class_weights
from holdfast.operators.outliers import OutlierHandler
from holdfast.operators.scale import StandardScaler
from holdfast.plans import report
from holdfast.plans.prepare import Preprocessor, PrepareSettings, prepare
from holdfast.session import scratch_path
from holdfast.sources.tables import customer360, customer_base, read_table, score_table

SCALED = [*NUMERIC, "service_adoption_score", "avg_monthly_charge_per_service", "charge_to_tenure_ratio"]
LABEL, KEY = "churn", "customer_id"
# One service stays text: the usage flag is derived from its text.
MAPPED = [c for c in YES_NO if c != FEATURES.lines]


def preprocessor(**options) -> Preprocessor:
    """The steps of the default preparation on the derived customer table."""
    o = PrepareSettings(key=KEY, label=LABEL, numbers=["total_charges"], binary=[*MAPPED, LABEL],
                        features=FEATURES, **options)
    return Preprocessor(
        o, MissingValueHandler("median", NUMERIC), OutlierHandler(columns=NUMERIC),
        OneHotEncoder(["contract", "internet_service"]), StandardScaler(SCALED),
        FeatureBinner([BinConfig("tenure", 5, "quantile", settings.TENURE_BIN_LABELS),
                       BinConfig("monthly_charges", 4, "quantile", settings.CHARGE_BIN_LABELS)]))


# ---- splits and samples ---------------------------------------------------------

_HASH = "CAST(('0x' || substr(md5('42:' || CAST({key} AS VARCHAR)), 1, 13)) AS BIGINT)"


def _split_sql(source: str, label: str) -> str:
    """Largest-remainder quotas per class, then rank by hash within the class."""
    return f"""hashed AS (SELECT *, {label} AS y, {_HASH.format(key="customer_id")} AS h FROM {source}),
totals AS (SELECT count(*) AS n, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n_test FROM hashed),
sizes AS (SELECT *, CAST(ceil((n - n_test) * 0.125) AS BIGINT) AS n_val FROM totals),
classes AS (SELECT y, count(*) AS c FROM hashed GROUP BY y),
e1 AS (SELECT y, c, n, n_test, n_val, c * (n - n_test) / CAST(n AS DOUBLE) AS x FROM classes, sizes),
r1 AS (SELECT *, row_number() OVER (ORDER BY x - floor(x) DESC, CAST(y AS VARCHAR)) AS k,
  (n - n_test) - sum(floor(x)) OVER () AS spare FROM e1),
k1 AS (SELECT *, floor(x) + CASE WHEN k <= spare THEN 1 ELSE 0 END AS kept FROM r1),
e2 AS (SELECT y, c, kept, n, n_test, n_val, kept * (n - n_test - n_val) / CAST(n - n_test AS DOUBLE) AS x2 FROM k1),
r2 AS (SELECT *, row_number() OVER (ORDER BY x2 - floor(x2) DESC, CAST(y AS VARCHAR)) AS k2,
  (n - n_test - n_val) - sum(floor(x2)) OVER () AS spare2 FROM e2),
quotas AS (SELECT y, c - kept AS q_test, kept - (floor(x2) + CASE WHEN k2 <= spare2 THEN 1 ELSE 0 END) AS q_val FROM r2),
marked AS (SELECT t.*, CASE WHEN rk <= q_test THEN 'test' WHEN rk <= q_test + q_val THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h, customer_id) AS rk FROM hashed) t JOIN quotas USING (y))"""


@query("t1_stratified_split", on_base("SELECT customer_id, split FROM marked", _split_sql("base", "churn")))
def t1(spark, sf):
    return split.assign_split(customer_base(spark, sf), KEY, LABEL, method="md5").select("customer_id", "split")


@query("t1_split_sizes", """WITH totals AS (SELECT count(*) AS n, CAST(ceil(count(*) * 0.2) AS BIGINT) AS t FROM orders),
  sizes AS (SELECT n, t, CAST(ceil((n - t) * 0.125) AS BIGINT) AS v FROM totals)
  SELECT 'test' AS split, t AS n_rows FROM sizes UNION ALL SELECT 'val', v FROM sizes
  UNION ALL SELECT 'train', n - t - v FROM sizes""")
def t1_sizes(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    marked = split.assign_split(orders, "o_orderkey", "o_orderpriority")
    return marked.groupBy("split").agg(F.count("*").alias("n_rows"))


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("t1_split_by_part", "WITH items AS (SELECT DISTINCT l_partkey, concat_ws('-', " + ", ".join(_LINE)
       + ") AS customer_id FROM lineitem),\n" + _split_sql("items", "l_partkey") + "\nSELECT customer_id AS line, split FROM marked")
def t1_by_part(spark, sf):
    lines = read_table(spark, sf, "lineitem").select("l_partkey", F.concat_ws("-", *[F.col(c).cast("string") for c in _LINE]).alias("line")).distinct()
    return split.assign_split(lines, "line", "l_partkey", method="md5").select("line", "split")


@query("t4_folds_by_customer", f"""WITH big AS (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 3),
  mine AS (SELECT o.* FROM orders o JOIN big USING (o_custkey))
  SELECT o_orderkey, CAST(CASE WHEN rk <= r * (q + 1) THEN floor((rk - 1) / (q + 1))
  ELSE r + floor((rk - 1 - r * (q + 1)) / q) END AS INTEGER) AS fold FROM (
  SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY {_HASH.format(key="o_orderkey")}, o_orderkey)
    AS rk, count(*) OVER (PARTITION BY o_custkey) // 3 AS q, count(*) OVER (PARTITION BY o_custkey) % 3 AS r FROM mine)""")
def t4_by_customer(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    big = orders.groupBy("o_custkey").count().where("count >= 3").select("o_custkey")
    return split.assign_folds(orders.join(big, "o_custkey"), "o_orderkey", "o_custkey", 3, method="md5").select("o_orderkey", "fold")


@query("t2_plain_split", on_base("SELECT customer_id, split FROM marked", _split_sql("base", "1")))
def t2(spark, sf):
    return split.assign_split(customer_base(spark, sf), KEY, LABEL, stratify=False, method="md5").select(
        "customer_id", "split")


@query("t3_sample", f"""SELECT event_id FROM events ORDER BY {_HASH.format(key="event_id")}, event_id LIMIT 2000""")
def t3(spark, sf):
    return split.sample_rows(read_table(spark, sf, "events").select("event_id"), "event_id", 2000, method="md5")


@query("t4_folds", on_base(f"""SELECT customer_id, CAST(CASE WHEN rk <= r * (q + 1) THEN floor((rk - 1) / (q + 1))
  ELSE r + floor((rk - 1 - r * (q + 1)) / q) END AS INTEGER) AS fold FROM (
  SELECT customer_id, row_number() OVER (PARTITION BY churn ORDER BY {_HASH.format(key="customer_id")}, customer_id)
    AS rk, count(*) OVER (PARTITION BY churn) // 5 AS q, count(*) OVER (PARTITION BY churn) % 5 AS r FROM base)"""))
def t4(spark, sf):
    return split.assign_folds(customer_base(spark, sf), KEY, LABEL, 5, method="md5").select("customer_id", "fold")


@query("q10_split_summary", on_base(f"""SELECT split, count(*) AS n_rows,
  {sql_fixed("count(*) * 100.0 / (SELECT count(*) FROM marked)")} AS pct_of_total,
  {sql_fixed("avg(churn) * 100")} AS label_rate_pct FROM marked GROUP BY split""", _split_sql("base", "churn")))
def q10(spark, sf):
    marked = split.assign_split(customer_base(spark, sf), KEY, LABEL, method="md5")
    out = split.split_summary(marked, LABEL)
    return out.withColumns({c: fixed(F.col(c)) for c in ("pct_of_total", "label_rate_pct")})


# ---- composed preparation -----------------------------------------------------------

def _serving_ctes(fit_on: str) -> list[str]:
    """Median fill, IQR cap, features, one-hot, standard scaling, quantile bins; the first
    two fitted on ``base``, scaling and bins on ``fit_on``."""
    med = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in NUMERIC)
    fill = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in NUMERIC)
    quart = ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS z_{c}" for c in NUMERIC)
    capped = ", ".join(f"greatest(a_{c} - 1.5 * (z_{c} - a_{c}), least(z_{c} + 1.5 * (z_{c} - a_{c}), {c})) AS {c}"
                       for c in NUMERIC)
    yes_no = ", ".join(f"CASE {c} WHEN 'Yes' THEN 1 ELSE 0 END AS {c}_01" for c in MAPPED)
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in SCALED)
    scaled = ", ".join(f"({c} - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END AS {c}" for c in SCALED)
    return [
        f"med AS (SELECT {med} FROM base)",
        f"filled AS (SELECT b.* REPLACE ({fill}) FROM base b, med)",
        f"quart AS (SELECT {quart} FROM filled)",
        f"capped AS (SELECT f.* REPLACE ({capped}) FROM filled f, quart)",
        f"featured AS ({sql_features('capped')})",
        f"flagged AS (SELECT *, {yes_no} FROM featured)",
        f"fitted AS ({fit_on})",
        f"stats AS (SELECT {stats} FROM fitted)",
        f"scaled AS (SELECT f.* REPLACE ({scaled}) FROM flagged f, stats)",
        f"scaled_fit AS (SELECT f.* REPLACE ({scaled}) FROM fitted f, stats)",
        f"edges AS (SELECT {sql_edges('tenure', 5)}, {sql_edges('monthly_charges', 4)} FROM scaled_fit)",
    ]


_SERVED_FLAGS = ["payment_reliability", "has_internet", "is_long_term_contract", "num_streaming_services",
                 "num_security_services", "intl_usage_flag"]
_SERVED_SQL = (
    "SELECT customer_id, " + ", ".join(f"{sql_fixed(c, 5)} AS {c}" for c in SCALED) + ", "
    + ", ".join(f"{c}_01 AS {c}" for c in MAPPED) + ", " + ", ".join(_SERVED_FLAGS) + ", tenure_category, "
    + ", ".join(f"CASE WHEN contract = '{v}' THEN 1 ELSE 0 END AS \"contract_{v}\"" for v in _CONTRACTS[1:]) + ", "
    + ", ".join(f"CASE WHEN internet_service = '{v}' THEN 1 ELSE 0 END AS \"internet_service_{v}\""
                for v in _INTERNET[1:]) + " FROM scaled, edges")


def _served(df, *extra):
    names = ["customer_id", *SCALED, *MAPPED, *_SERVED_FLAGS, "tenure_category",
             *[f"contract_{v}" for v in _CONTRACTS[1:]], *[f"internet_service_{v}" for v in _INTERNET[1:]], *extra]
    return df.select(*[fixed(F.col(n), 5).alias(n) if n in SCALED else F.col(f"`{n}`") for n in names])


@query("x1_split_tables", on_base("SELECT split, count(*) AS n_rows, CAST(sum(churn) AS BIGINT) AS positives FROM marked "
                                  "GROUP BY split", _split_sql("base", "churn")))
def x1(spark, sf):
    done = prepare(customer360(spark, sf), preprocessor(fit_scope="all", hash_method="md5"))
    parts = [df.agg(F.lit(name).alias("split"), F.count("*").alias("n_rows"), F.sum(LABEL).alias("positives"))
             for name, df in done.parts().items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("x1_training_rows", on_base(
    _SERVED_SQL + " WHERE customer_id IN (SELECT customer_id FROM marked WHERE split = 'train')",
    _split_sql("base", "churn"),
    *_serving_ctes("SELECT * FROM flagged WHERE customer_id IN (SELECT customer_id FROM marked WHERE split = 'train')")))
def x1_rows(spark, sf):
    return _served(prepare(customer360(spark, sf), preprocessor(fit_scope="all", hash_method="md5")).train)


@query("x2_serving_rows", on_base(
    _SERVED_SQL.replace(" FROM scaled, edges", ", " + sql_quantile_bin("tenure", settings.TENURE_BIN_LABELS,
                                                                       "tenure_bin") + ", "
                        + sql_quantile_bin("monthly_charges", settings.CHARGE_BIN_LABELS, "monthly_charges_bin")
                        + " FROM scaled, edges"), *_serving_ctes("SELECT * FROM flagged")))
def x2(spark, sf):
    raw = customer360(spark, sf)
    fitted = preprocessor()
    fitted.fit(fitted.clean(raw))
    return _served(fitted.transform(raw), "tenure_bin", "monthly_charges_bin")


@query("x3_prepared_rows", on_base(_SERVED_SQL, *_serving_ctes("SELECT * FROM flagged")))
def x3(spark, sf):
    fitted = preprocessor()
    cleaned = fitted.clean(customer360(spark, sf))
    return _served(fitted.fit(cleaned).transform_prepared(cleaned))


# ---- evaluation -------------------------------------------------------------------

_CELLS = """cells AS (SELECT count(*) FILTER (label = 0 AND score < 0.5) AS tn,
  count(*) FILTER (label = 0 AND score >= 0.5) AS fp, count(*) FILTER (label = 1 AND score < 0.5) AS fn,
  count(*) FILTER (label = 1 AND score >= 0.5) AS tp FROM scores)"""


def _ratio(a: str, b: str) -> str:
    return sql_fixed(f"coalesce(({a}) / nullif(CAST({b} AS DOUBLE), 0), 0)")


def _rounded(df, *names):
    return df.withColumns({n: fixed(F.col(n)) for n in names})


@query("v1_confusion", on_scores("SELECT tn, fp, fn, tp FROM cells", _CELLS))
def v1(spark, sf):
    return evaluate.confusion(score_table(spark, sf), "label", "score")


@query("v2_threshold_metrics", on_scores(
    f"SELECT {_ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {_ratio('tp', '(tp + fp)')} AS precision, "
    f"{_ratio('tp', '(tp + fn)')} AS recall, {_ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1 FROM cells", _CELLS))
def v2(spark, sf):
    out = evaluate.threshold_metrics(score_table(spark, sf), "label", "score")
    return _rounded(out, "accuracy", "precision", "recall", "f1")


_AUC = "sum(neg * (tp - pos / 2.0)) / any_value(p) / any_value(n)"
_AP = "sum(pos * (tp / CAST(tp + fp AS DOUBLE))) / any_value(p)"


@query("v3_roc_auc", on_curve(f"SELECT {sql_fixed(_AUC)} AS roc_auc FROM curve"))
def v3(spark, sf):
    return _rounded(evaluate.roc_auc(score_table(spark, sf), "label", "score"), "roc_auc")


@query("v3_roc_auc_line_items", f"""WITH by_score AS (SELECT l_extendedprice AS score,
  count(*) FILTER (l_returnflag = 'R') AS pos, count(*) FILTER (l_returnflag <> 'R') AS neg FROM lineitem GROUP BY 1),
  curve AS (SELECT pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM by_score) SELECT {sql_fixed(_AUC)} AS roc_auc FROM curve""")
def v3_lines(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("score"))
    return _rounded(evaluate.roc_auc(lines, "label", "score"), "roc_auc")


@query("v4_average_precision", on_curve(f"SELECT {sql_fixed(_AP)} AS average_precision FROM curve"))
def v4(spark, sf):
    return _rounded(evaluate.average_precision(score_table(spark, sf), "label", "score"), "average_precision")


def _report_sql() -> str:
    p0, r0, f0 = "tn / nullif(CAST(tn + fn AS DOUBLE), 0)", "tn / nullif(CAST(tn + fp AS DOUBLE), 0)", \
        "2 * tn / nullif(CAST(2 * tn + fn + fp AS DOUBLE), 0)"
    p1, r1, f1 = "tp / nullif(CAST(tp + fp AS DOUBLE), 0)", "tp / nullif(CAST(tp + fn AS DOUBLE), 0)", \
        "2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0)"
    acc = "(tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE)"
    rows = {"0": (p0, r0, f0, "tn + fp"), "1": (p1, r1, f1, "tp + fn"), "accuracy": (acc, acc, acc, "tn + fp + tp + fn")}
    pairs = list(zip((p0, r0, f0), (p1, r1, f1)))
    rows["macro avg"] = tuple(f"(coalesce({a}, 0) + coalesce({b}, 0)) / 2" for a, b in pairs) + ("tn + fp + tp + fn",)
    rows["weighted avg"] = tuple(f"(coalesce({a}, 0) * (tn + fp) + coalesce({b}, 0) * (tp + fn)) / (tn + fp + tp + fn)"
                                 for a, b in pairs) + ("tn + fp + tp + fn",)
    return " UNION ALL ".join(
        f"SELECT '{k}' AS \"row\", {sql_fixed(f'coalesce({a}, 0)')} AS precision, "
        f"{sql_fixed(f'coalesce({b}, 0)')} AS recall, {sql_fixed(f'coalesce({c}, 0)')} AS f1, {d} AS support FROM cells"
        for k, (a, b, c, d) in rows.items())


@query("v5_classification_report", on_scores(_report_sql(), _CELLS))
def v5(spark, sf):
    out = evaluate.classification_report(score_table(spark, sf), "label", "score")
    return _rounded(out, "precision", "recall", "f1")


def _sweep_cte(thresholds: list[float]) -> str:
    grid = ", ".join(f"(CAST({t!r} AS DOUBLE))" for t in thresholds)
    return f"""grid(threshold) AS (VALUES {grid}),
sweep AS (SELECT threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp,
  count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 1 AND score < threshold) AS fn
  FROM grid, scores GROUP BY threshold)"""


_SWEEP_SQL = (f"SELECT {sql_fixed('threshold')} AS threshold, tp, fp, fn, {_ratio('tp', '(tp + fp)')} AS precision, "
              f"{_ratio('tp', '(tp + fn)')} AS recall, {_ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1, "
              "fp * 10.0 + fn * 500.0 AS total_cost FROM sweep")


@query("v6_threshold_sweep", on_scores(_SWEEP_SQL, _sweep_cte(evaluate.default_thresholds())))
def v6(spark, sf):
    out = evaluate.sweep(score_table(spark, sf), "label", "score")
    return _rounded(out, "threshold", "precision", "recall", "f1")


def _best_sql(value: str) -> str:
    return (f"SELECT {sql_fixed('threshold')} AS threshold, {sql_fixed(value)} AS metric_value, "
            f"{_ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1, {_ratio('tp', '(tp + fp)')} AS precision, "
            f"{_ratio('tp', '(tp + fn)')} AS recall FROM sweep ORDER BY {value} DESC, sweep.threshold LIMIT 1")


_F1 = "coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0)"
_P = "coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0)"
_R = "coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0)"


@query("v6_best_threshold", on_scores(_best_sql(_F1), _sweep_cte(evaluate.default_thresholds())))
def v6_best(spark, sf):
    out = evaluate.best_threshold(score_table(spark, sf), "label", "score", "f1")
    return _rounded(out, "threshold", "metric_value", "f1", "precision", "recall")


@query("v7_best_by_metric", on_scores(" UNION ALL ".join(
    f"(SELECT '{m}' AS metric, * FROM ({_best_sql(v)}))" for m, v in
    {"recall": _R, "precision": _P, "cost": "-(fp * 10.0 + fn * 500.0)", "other": _F1}.items()),
    _sweep_cte(evaluate.default_thresholds())))
def v7(spark, sf):
    out = evaluate.best_thresholds(score_table(spark, sf), "label", "score", ["recall", "precision", "cost", "other"])
    return _rounded(out, "threshold", "metric_value", "f1", "precision", "recall")


@query("v8_cost", on_scores("""SELECT tp, fp, fn, tn, 10.0 AS fp_cost_per_instance, 500.0 AS fn_cost_per_instance,
  fp * 10.0 AS fp_cost_total, fn * 500.0 AS fn_cost_total, fp * 10.0 + fn * 500.0 AS total_cost FROM cells""", _CELLS))
def v8(spark, sf):
    return evaluate.cost_analysis(score_table(spark, sf), "label", "score")


@query("v9_roc_points", on_curve(
    f"SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL SELECT {sql_fixed('score')}, "
    f"{sql_fixed('fp / CAST(n AS DOUBLE)')}, {sql_fixed('tp / CAST(p AS DOUBLE)')} FROM curve"))
def v9(spark, sf):
    return _rounded(evaluate.roc_points(score_table(spark, sf), "label", "score"), "threshold", "fpr", "tpr")


@query("v10_pr_points", on_curve(
    f"SELECT {sql_fixed('score')} AS threshold, {sql_fixed('tp / CAST(tp + fp AS DOUBLE)')} AS precision, "
    f"{sql_fixed('tp / CAST(p AS DOUBLE)')} AS recall, {sql_fixed('p / CAST(p + n AS DOUBLE)')} AS base_rate FROM curve "
    f"UNION ALL SELECT NULL, 1.0, 0.0, any_value({sql_fixed('p / CAST(p + n AS DOUBLE)')}) FROM curve"))
def v10(spark, sf):
    out = evaluate.pr_points(score_table(spark, sf), "label", "score")
    return _rounded(out, "threshold", "precision", "recall", "base_rate")


@query("v11_confusion_shares", on_scores(" UNION ALL ".join(
    f"SELECT {a} AS actual, {p} AS predicted, {n} AS n, {_ratio(n, f'({n} + {o})')} AS share FROM cells"
    for a, p, n, o in [(0, 0, "tn", "fp"), (0, 1, "fp", "tn"), (1, 0, "fn", "tp"), (1, 1, "tp", "fn")]), _CELLS))
def v11(spark, sf):
    return _rounded(evaluate.confusion_matrix(score_table(spark, sf), "label", "score"), "share")


@query("v14_threshold_chart", on_scores(
    f"SELECT {sql_fixed('threshold')} AS threshold, {_ratio('tp', '(tp + fp)')} AS precision, "
    f"{_ratio('tp', '(tp + fn)')} AS recall, {_ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1 FROM sweep",
    _sweep_cte(evaluate.chart_thresholds())))
def v14(spark, sf):
    out = evaluate.sweep(score_table(spark, sf), "label", "score", evaluate.chart_thresholds())
    return _rounded(out, "threshold", "precision", "recall", "f1").select("threshold", "precision", "recall", "f1")


def _calibration_sql() -> str:
    edges = [float(e) for e in np.linspace(0.0, 1.0, 11)[1:-1]]
    case = " ".join(f"WHEN score <= CAST({e!r} AS DOUBLE) THEN {i}" for i, e in enumerate(edges))
    return (f"SELECT CASE {case} ELSE 9 END AS bin, {sql_fixed('avg(score)')} AS mean_score, "
            f"{sql_fixed('avg(label)')} AS positive_share, count(*) AS n FROM scores GROUP BY 1")


@query("v15_calibration", on_scores(_calibration_sql()))
def v15(spark, sf):
    return _rounded(evaluate.calibration(score_table(spark, sf), "label", "score"), "mean_score", "positive_share")


@query("v16_margin_scores", on_scores(f"""SELECT customer_id, {sql_fixed("(m - lo) / (hi - lo)")} AS scaled,
  {sql_fixed("(m - lo) / (hi - lo + 1e-9)")} AS scaled_eps FROM (SELECT customer_id, score * 7 - 3 AS m FROM scores),
  (SELECT min(score * 7 - 3) AS lo, max(score * 7 - 3) AS hi FROM scores)"""))
def v16(spark, sf):
    margins = score_table(spark, sf).withColumn("m", F.col("score") * 7 - 3)
    out = evaluate.margin_to_score(evaluate.margin_to_score(margins, "m", "scaled"), "m", "scaled_eps", 1e-9)
    return _rounded(out, "scaled", "scaled_eps").select("customer_id", "scaled", "scaled_eps")


# ---- models without training ------------------------------------------------------------

@query("m7_class_weights", on_base(f"""SELECT churn AS label, count(*) AS n,
  {sql_fixed("(SELECT count(*) FROM base) / CAST(2 * count(*) AS DOUBLE)")} AS weight FROM base GROUP BY churn"""))
def m7(spark, sf):
    return _rounded(class_weights(customer_base(spark, sf), LABEL), "weight")


_CANDIDATES = {"long_tenure": "tenure / 100.0", "short_tenure": "(100 - tenure) / 100.0",
               "same_as_long_tenure": "tenure / 200.0", "price": "monthly_charges"}


def _candidate_table(spark, sf):
    """Validation metrics of simple one-column scores, one row per candidate."""
    base = customer_base(spark, sf).where(F.col("tenure").isNotNull())
    scored = base.select(LABEL, *[F.expr(e).cast("double").alias(n) for n, e in _CANDIDATES.items()])
    metrics = evaluate.evaluate_scores(scored, LABEL, {n: n for n in _CANDIDATES})
    place = F.array_position(F.array(*[F.lit(n) for n in _CANDIDATES]), F.col("name")) - 1
    rows = metrics.select(place.cast("int").alias("position"), F.col("name").alias("model_name"), "roc_auc", "pr_auc",
                          "f1")
    broken = spark.range(1).select(F.lit(9).alias("position"), F.lit("broken").alias("model_name"),
                                   F.lit(float("nan")).alias("roc_auc"), F.lit(None).cast("double").alias("pr_auc"),
                                   F.lit(0.0).alias("f1"))
    return _rounded(rows, "roc_auc", "pr_auc", "f1").unionByName(broken)


def _candidate_sql() -> str:
    parts = []
    for position, (name, expr) in enumerate(_CANDIDATES.items()):
        parts.append(f"""SELECT {position} AS position, '{name}' AS model_name, {sql_fixed(_AUC)} AS roc_auc,
  {sql_fixed(_AP)} AS pr_auc FROM (SELECT pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p,
  sum(neg) OVER () AS n FROM (SELECT CAST({expr} AS DOUBLE) AS score, sum(churn) AS pos, sum(1 - churn) AS neg
  FROM base WHERE tenure IS NOT NULL GROUP BY 1) WINDOW w AS (ORDER BY score DESC))""")
    return " UNION ALL ".join(parts)


@query("m12_champion", on_base("SELECT model_name, roc_auc FROM candidates ORDER BY roc_auc DESC, position LIMIT 1",
                               f"candidates AS ({_candidate_sql()})"))
def m12(spark, sf):
    return champion.elect_champion(_candidate_table(spark, sf)).select("model_name", "roc_auc")


@query("m13_model_comparison", on_base("""SELECT model_name, pr_auc, row_number() OVER (ORDER BY
  coalesce(pr_auc, -1) DESC, position) AS place FROM (SELECT position, model_name, pr_auc FROM candidates
  UNION ALL SELECT 9, 'broken', NULL)""", f"candidates AS ({_candidate_sql()})"))
def m13(spark, sf):
    ranked = champion.compare_models(_candidate_table(spark, sf), "pr_auc")
    # Five rows, one per candidate.
    order = Window.orderBy(F.desc("rank_value"), "position")
    return ranked.select("model_name", "pr_auc", F.row_number().over(order).alias("place"))


# ---- tiers ----------------------------------------------------------------------------------

_TIER = "CASE WHEN {s} >= 0.7 THEN '{h}' WHEN {s} >= 0.4 THEN '{m}' ELSE '{l}' END"
_TIER_N2 = _TIER.format(s="score", h="High", m="Medium", l="Low")
_TIER_N5 = _TIER.format(s=sql_fixed("score - 4e-7"), h="HIGH", m="MEDIUM", l="LOW")
_TIER_N2B = _TIER.format(s="(score - 4e-7)", h="High", m="Medium", l="Low")


@query("n2_risk_tiers", on_scores(f"SELECT customer_id, {_TIER_N2} AS risk_tier FROM scores"))
def n2(spark, sf):
    return score_table(spark, sf).select("customer_id", risk_tier(F.col("score")).alias("risk_tier"))


@query("n3_tier_counts", on_scores("""SELECT count(*) AS total, count(*) FILTER (score >= 0.5) AS predicted_positive,
  count(*) FILTER (score >= 0.7) AS n_high, count(*) FILTER (score >= 0.4 AND score < 0.7) AS n_medium,
  count(*) FILTER (score < 0.4) AS n_low FROM scores"""))
def n3(spark, sf):
    scored = score_table(spark, sf).select(risk_tier(F.col("score")).alias("risk_tier"),
                                           (F.col("score") >= 0.5).cast("int").alias("prediction"))
    return business.prediction_counts(scored)


@query("n5_stream_tiers", on_scores(
    f"SELECT customer_id, {_TIER_N2B} AS batch_tier, {_TIER_N5} AS stream_tier FROM scores"))
def n5(spark, sf):
    s = F.col("score") - 4e-7
    return score_table(spark, sf).select("customer_id", risk_tier(s).alias("batch_tier"),
                                         stream_tier(round_to(s, 6)).alias("stream_tier"))


@query("n6_run_summary", on_scores(f"""SELECT count(*) AS total, count(*) FILTER (score >= 0.7) AS n_high,
  count(*) FILTER (score >= 0.4 AND score < 0.7) AS n_medium, count(*) FILTER (score < 0.4) AS n_low,
  {sql_fixed("count(*) FILTER (score >= 0.7) * 100.0 / greatest(count(*), 1)")} AS pct_high,
  {sql_fixed("count(*) FILTER (score >= 0.4 AND score < 0.7) * 100.0 / greatest(count(*), 1)")} AS pct_medium,
  {sql_fixed("count(*) FILTER (score < 0.4) * 100.0 / greatest(count(*), 1)")} AS pct_low FROM scores"""))
def n6(spark, sf):
    scored = score_table(spark, sf).select(stream_tier(F.col("score")).alias("risk_tier"))
    return _rounded(business.tier_summary(scored), "pct_high", "pct_medium", "pct_low")


# ---- exploration ----------------------------------------------------------------------------

@query("a1_class_distribution", on_raw(f"""SELECT CASE churn WHEN 'Yes' THEN 'Churn' ELSE 'No Churn' END AS label_text,
  count(*) AS n, {sql_fixed("count(*) * 100.0 / sum(count(*)) OVER ()")} AS pct,
  {sql_fixed("max(count(*)) OVER () / CAST(min(count(*)) OVER () AS DOUBLE)")} AS imbalance_ratio
  FROM customer360 GROUP BY churn"""))
def a1(spark, sf):
    return _rounded(eda.class_distribution(customer360(spark, sf), LABEL), "pct", "imbalance_ratio")


@query("a2_value_counts", on_raw(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM customer360 WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in CATEGORICAL)))
def a2(spark, sf):
    return eda.value_counts(customer360(spark, sf), CATEGORICAL)


@query("a2_value_counts_line_items", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY {c}"
    for c in ("l_returnflag", "l_linestatus", "l_linenumber")))
def a2_lines(spark, sf):
    return eda.value_counts(read_table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("a3_rate_by_category", on_base(f"""SELECT contract AS category, count(*) AS n, {sql_fixed("avg(churn) * 100")}
  AS rate_pct, {sql_fixed("(SELECT avg(churn) * 100 FROM base)")} AS overall_pct FROM base GROUP BY contract"""))
def a3(spark, sf):
    return _rounded(eda.rate_by(customer_base(spark, sf), "contract", LABEL), "rate_pct", "overall_pct")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("a4_rate_pivot", on_base("SELECT contract, " + ", ".join(
    sql_fixed(f"avg(churn) FILTER (payment_method = '{p}') * 100") + f' AS "{p}"' for p in _PRIORITIES)
    + " FROM base GROUP BY contract"))
def a4(spark, sf):
    out = eda.rate_pivot(customer_base(spark, sf), "contract", "payment_method", LABEL)
    return out.select("contract", *[fixed(F.col(f"`{p}`")).alias(p) for p in _PRIORITIES])


@query("a4_rates_by_two", f"""SELECT l_partkey AS "row", l_linestatus AS "column", count(*) AS n,
  {sql_fixed("avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100")} AS rate_pct FROM lineitem GROUP BY 1, 2""")
def a4_by_two(spark, sf):
    lines = read_table(spark, sf, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    return _rounded(eda.rates_by_two(lines, "l_partkey", "l_linestatus", "returned"), "rate_pct")


def _histogram_sql(table: str, c: str) -> str:
    edge = "CASE WHEN i = 40 THEN hi ELSE lo + i * ((hi - lo) / 40) END"
    return f"""SELECT CAST(i AS INTEGER) AS bin, {sql_fixed("low", 3)} AS low, {sql_fixed("high", 3)} AS high,
  (SELECT count(*) FROM {table} t WHERE {c} >= low AND ({c} < high OR (i = 39 AND {c} <= high))) AS n,
  {sql_fixed("mean", 3)} AS mean, {sql_fixed("median", 3)} AS median FROM (
  SELECT i, {edge} AS low, {edge.replace("i = 40", "i + 1 = 40").replace("lo + i *", "lo + (i + 1) *")} AS high, mean,
    median FROM range(40) r(i), (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi, avg({c}) AS mean,
    quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM {table}))"""


def _histogram(df, name):
    return eda.histogram(df, name).withColumns(
        {c: fixed(F.col(c), 3) for c in ("low", "high", "mean", "median")})


@query("a5_histogram", on_base(_histogram_sql("base", "total_charges")))
def a5(spark, sf):
    return _histogram(customer_base(spark, sf), "total_charges")


@query("a5_histogram_line_items", _histogram_sql("lineitem", "l_extendedprice"))
def a5_lines(spark, sf):
    return _histogram(read_table(spark, sf, "lineitem"), "l_extendedprice")


def _box_sql(table: str, c: str, by: str, digits: int = 3) -> str:
    return f"""SELECT g.category, count(x) AS n, {sql_fixed("any_value(q1)", digits)} AS q1,
  {sql_fixed("any_value(q2)", digits)} AS median, {sql_fixed("any_value(q3)", digits)} AS q3,
  {sql_fixed("least(min(x) FILTER (x >= q1 - 1.5 * (q3 - q1)), any_value(q1))", digits)} AS whisker_low,
  {sql_fixed("greatest(max(x) FILTER (x <= q3 + 1.5 * (q3 - q1)), any_value(q3))", digits)} AS whisker_high,
  count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_fliers
  FROM (SELECT {by} AS category, CAST({c} AS DOUBLE) AS x FROM {table}) t JOIN (SELECT {by} AS category,
  quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q2,
  quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {table} GROUP BY {by}) g ON g.category = t.category
  GROUP BY g.category"""


def _box(df, name, by, digits=3):
    return eda.box_stats(df, name, by).withColumns(
        {c: fixed(F.col(c), digits) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@query("a6_box_stats", on_base(_box_sql("base", "total_charges", "churn")))
def a6(spark, sf):
    return _box(customer_base(spark, sf), "total_charges", LABEL)


@query("a6_box_stats_line_items", _box_sql("lineitem", "l_extendedprice", "l_returnflag"))
def a6_lines(spark, sf):
    return _box(read_table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")


@query("a6_box_stats_by_customer", _box_sql("orders", "o_totalprice", "o_custkey", 5))
def a6_by_customer(spark, sf):
    return _box(read_table(spark, sf, "orders"), "o_totalprice", "o_custkey", 5)


def _density_sql(c: str, points: int, margin: float) -> str:
    return f"""density AS (SELECT category, CAST(i AS INTEGER) AS i, x, sum(exp(-0.5 * power((x - v) / (sd * power(n, -0.2)), 2)))
  / any_value(n * sd * power(n, -0.2) * sqrt(2 * pi())) AS density FROM (
  SELECT category, n, sd, i, lo - {margin} * (hi - lo) + i * ((1 + 2 * {margin}) * (hi - lo) / {points - 1}) AS x FROM
   (SELECT churn AS category, count(*) AS n, stddev_samp({c}) AS sd, min({c}) AS lo, max({c}) AS hi FROM base
    WHERE {c} IS NOT NULL GROUP BY churn), range({points}) r(i)) g
  JOIN (SELECT churn AS category, CAST({c} AS DOUBLE) AS v FROM base WHERE {c} IS NOT NULL) d USING (category)
  GROUP BY category, i, x)"""


@query("a7_kernel_density", on_base(
    f"SELECT category, i, {sql_fixed('x', 5)} AS x, {sql_fixed('density', 9)} AS density FROM density",
    _density_sql("tenure", 1000, 0.5)))
def a7(spark, sf):
    out = eda.kernel_density(customer_base(spark, sf), "tenure", LABEL)
    return out.withColumns({"x": fixed(F.col("x"), 5), "density": fixed(F.col("density"), 9)})


@query("a8_violin", on_base(
    f"""SELECT category, i, {sql_fixed("x", 3)} AS x, {sql_fixed("density * 1e6", 6)} AS density, {sql_fixed("lo", 3)} AS low,
  {sql_fixed("md", 3)} AS median, {sql_fixed("hi", 3)} AS high FROM density JOIN (SELECT churn AS category,
  min(monthly_charges) AS lo, quantile_cont(monthly_charges, 0.5) AS md, max(monthly_charges) AS hi FROM base
  GROUP BY churn) USING (category)""", _density_sql("monthly_charges", 100, 0.0)))
def a8(spark, sf):
    out = eda.violin_stats(customer_base(spark, sf), "monthly_charges", LABEL)
    return out.withColumns({**{c: fixed(F.col(c), 3) for c in ("x", "low", "median", "high")},
                            "density": fixed(F.col("density") * 1e6)})


_CORR = [*NUMERIC, LABEL]
_KEPT = "kept AS (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CORR) + " FROM base WHERE " + \
    " AND ".join(f"{c} IS NOT NULL" for c in _CORR) + ")"
_RANKED = "ranked AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _CORR) + " FROM kept)"


def _corr_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {'1.0' if a == b else sql_fixed(f'corr({a}, {b})')} AS r"
        f"{'' if a == b else f' FROM {source}'}" for a in _CORR for b in _CORR)


@query("a9_pearson", on_base(_corr_sql("kept"), _KEPT))
def a9_pearson(spark, sf):
    return _rounded(correlation.correlation(customer_base(spark, sf), _CORR, "pearson"), "r")


@query("a9_spearman", on_base(_corr_sql("ranked"), _KEPT, _RANKED))
def a9_spearman(spark, sf):
    return _rounded(correlation.correlation(customer_base(spark, sf), _CORR, "spearman"), "r")


def _kendall_sql() -> str:
    pairs = [(a, b) for a in _CORR for b in _CORR]
    out = []
    for a, b in pairs:
        if a == b:
            out.append(f"SELECT '{a}' AS x, '{b}' AS y, 1.0 AS r")
            continue
        first, second = sorted((a, b), key=_CORR.index)
        out.append(f"SELECT '{a}' AS x, '{b}' AS y, {sql_fixed(f's_{first}_{second} / sqrt(t_{first} * t_{second})')} AS r "
                   "FROM sums")
    return " UNION ALL ".join(out)


_KENDALL_SUMS = "sums AS (SELECT " + ", ".join(
    [f"sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b})) AS s_{a}_{b}" for i, a in enumerate(_CORR) for b in _CORR[i + 1:]]
    + [f"CAST(count(*) FILTER (p.{a} <> q.{a}) AS DOUBLE) AS t_{a}" for a in _CORR]) + " FROM kept p, kept q)"


@query("a9_kendall", on_base(_kendall_sql(), _KEPT, _KENDALL_SUMS))
def a9_kendall(spark, sf):
    return _rounded(correlation.correlation(customer_base(spark, sf), _CORR, "kendall"), "r")


_LINE_NUMBERS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _kendall_cells_sql(a: str, b: str) -> str:
    """tau-b from the distinct pairs of values, each against each."""
    if a == b:
        return f"SELECT '{a}' AS x, '{b}' AS y, 1.0 AS r"
    tau = "sum(p.w * q.w * sign(p.a - q.a) * sign(p.b - q.b)) / sqrt(sum(CASE WHEN p.a <> q.a THEN p.w * q.w END)" \
        " * sum(CASE WHEN p.b <> q.b THEN p.w * q.w END))"
    cells = f"SELECT CAST({a} AS DOUBLE) AS a, CAST({b} AS DOUBLE) AS b, CAST(count(*) AS DOUBLE) AS w FROM lineitem GROUP BY 1, 2"
    return f"SELECT '{a}' AS x, '{b}' AS y, {sql_fixed(tau)} AS r FROM ({cells}) p, ({cells}) q"


@query("a9_kendall_line_items", " UNION ALL ".join(_kendall_cells_sql(a, b) for a in _LINE_NUMBERS for b in _LINE_NUMBERS))
def a9_kendall_lines(spark, sf):
    return _rounded(correlation.correlation(read_table(spark, sf, "lineitem"), _LINE_NUMBERS, "kendall"), "r")


@query("a10_label_correlation", on_base(" UNION ALL ".join(
    f"SELECT '{c}' AS x, {sql_fixed(f'corr({c}, churn)')} AS r FROM ranked" for c in NUMERIC), _KEPT, _RANKED))
def a10(spark, sf):
    return _rounded(correlation.label_correlation(customer_base(spark, sf), NUMERIC, LABEL), "r")


_EDGES = [float(e) for e in np.linspace(0.0, 1.0, 11)[1:-1]]
_CHARTS_SQL = f"""SELECT 'roc' AS chart, {sql_fixed("fp / CAST(n AS DOUBLE)")} AS x, {sql_fixed("tp / CAST(p AS DOUBLE)")} AS y FROM curve
UNION ALL SELECT 'pr', {sql_fixed("tp / CAST(p AS DOUBLE)")}, {sql_fixed("tp / CAST(tp + fp AS DOUBLE)")} FROM curve
UNION ALL SELECT 'confusion', 2 * label + CASE WHEN score >= 0.5 THEN 1 ELSE 0 END, count(*) FROM scores GROUP BY 2
UNION ALL SELECT 'calibration', {sql_fixed("avg(score)")}, {sql_fixed("avg(label)")} FROM scores
  GROUP BY {" + ".join(f"CASE WHEN score > {e!r} THEN 1 ELSE 0 END" for e in _EDGES)}
UNION ALL SELECT 'thresholds', {sql_fixed("t")}, {sql_fixed("coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0)")} FROM (
  SELECT t, count(*) FILTER (score >= t AND label = 1) AS tp, count(*) FILTER (score >= t AND label = 0) AS fp,
  count(*) FILTER (score < t AND label = 1) AS fn FROM scores, (SELECT unnest([{", ".join(repr(float(t)) for t in evaluate.chart_thresholds())}]) AS t)
  GROUP BY t)"""


@query("m14_chart_tables", on_curve(_CHARTS_SQL))
def m14_charts(spark, sf):
    """Written to a run folder with its manifest and read back."""
    tables = report.chart_tables(score_table(spark, sf), "label", "score")
    run = report.write_tables(spark, scratch_path(spark, "runs"), tables)
    back, _ = report.read_tables(spark, run)
    shown = {"roc": ("fpr", "tpr"), "pr": ("recall", "precision"), "calibration": ("mean_score", "positive_share"),
             "thresholds": ("threshold", "f1")}
    parts = [back[t].select(F.lit(t).alias("chart"), fixed(F.col(x)).alias("x"), fixed(F.col(y)).alias("y")) for t, (x, y) in shown.items()]
    parts.append(back["confusion"].where("n > 0").select(F.lit("confusion").alias("chart"), fixed(2 * F.col("actual") + F.col("predicted")).alias("x"),
                                                         fixed(F.col("n")).alias("y")))
    return reduce(DataFrame.unionByName, parts)


# ---- business --------------------------------------------------------------------------------

@query("a12_segment_profile", on_base(f"""SELECT segment, count(churn) AS n_customers,
  {sql_fixed(f"{sql_fixed('avg(churn)', 2)} * 100", 1)} AS churn_rate, {sql_fixed("avg(tenure)", 4)} AS avg_tenure,
  {sql_fixed("avg(monthly_charges)", 4)} AS avg_monthly, {sql_fixed("avg(total_charges)", 4)} AS avg_total
  FROM base GROUP BY segment"""))
def a12(spark, sf):
    return business.segment_profile(
        customer_base(spark, sf), "segment", LABEL,
        {"avg_tenure": "tenure", "avg_monthly": "monthly_charges", "avg_total": "total_charges"}, digits=4)


@query("a13_revenue_at_risk", on_base(f"""SELECT n_customers, n_churners, {sql_fixed("n_churners / CAST(n_customers AS DOUBLE)")}
  AS churn_rate, n_churners * 2080.0 AS revenue_at_risk, n_churners * 50.0 AS intervention_cost,
  {sql_fixed("n_churners * 0.35")} AS customers_saved, {sql_fixed("n_churners * 0.35 * 2080", 3)} AS revenue_saved,
  {sql_fixed("n_churners * 0.35 * 2080 - n_churners * 50", 3)} AS net_benefit,
  {sql_fixed("(n_churners * 0.35 * 2080 - n_churners * 50) / (n_churners * 50) * 100", 3)} AS roi_pct
  FROM (SELECT count(*) AS n_customers, sum(churn) AS n_churners FROM base)"""))
def a13(spark, sf):
    out = business.revenue_at_risk(customer_base(spark, sf), LABEL)
    return out.withColumns({"churn_rate": fixed(F.col("churn_rate")), "customers_saved": fixed(F.col("customers_saved")),
                            **{c: fixed(F.col(c), 3) for c in ("revenue_saved", "net_benefit", "roi_pct")}})


@query("a14_profile_uplift", on_base(f"""SELECT count(*) FILTER (hit) AS n_profile,
  {sql_fixed("avg(churn) FILTER (hit) * 100")} AS profile_rate_pct, {sql_fixed("avg(churn) * 100")} AS overall_rate_pct,
  {sql_fixed("avg(churn) FILTER (hit) / avg(churn)")} AS uplift FROM (SELECT churn, contract = 'Month-to-month'
  AND payment_method = '3-MEDIUM' AND tenure <= 12 AS hit FROM base)"""))
def a14(spark, sf):
    profile = high_risk_profile(F.col("contract"), "Month-to-month", F.col("payment_method"), "3-MEDIUM",
                                F.col("tenure"))
    out = business.profile_uplift(customer_base(spark, sf), profile, LABEL)
    return _rounded(out, "profile_rate_pct", "overall_rate_pct", "uplift")
