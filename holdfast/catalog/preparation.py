"""Queries for slices, coercion, quality, imputation, outliers, features, encoding, scaling, binning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.catalog import query
from holdfast.catalog.common import (
    FEATURES, NUMERIC, YES_NO, fixed, on_base, on_raw, sql_fixed, sql_number, sql_yes_no,
)
from holdfast.functions.expressions import (
    high_risk_profile, label_number, label_text, service_active,
)
from holdfast.operators import binning, encode, features, impute, outliers, quality, scale
from holdfast.operators.models import aligned, feature_columns
from holdfast.plans.score import scoring_rows
from holdfast.session import stage
from holdfast.sources import files, slices
from holdfast.sources.files import coerce_numbers, map_yes_no
from holdfast.sources.tables import customer360, customer_base, read_table

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ---- row slices -----------------------------------------------------------

@query("s9_first_rows", on_raw("SELECT customer_id, tenure, churn FROM customer360 ORDER BY customer_id LIMIT 1000"))
def s9(spark, sf):
    return slices.first_rows(customer360(spark, sf), "customer_id", 1000).select("customer_id", "tenure", "churn")


@query("s9_first_events", """SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 5000""")
def s9_events(spark, sf):
    return slices.first_rows(read_table(spark, sf, "events"), "event_id", 5000).select(
        "event_id", "user_id", "event_type")


@query("s10_rows_after", on_raw("SELECT customer_id, tenure, churn FROM customer360 ORDER BY customer_id OFFSET 1000"))
def s10(spark, sf):
    return slices.rows_after(customer360(spark, sf), "customer_id", 1000).select("customer_id", "tenure", "churn")


@query("s11_batches", """SELECT event_id,
  CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 10.0) + 1 AS BIGINT) AS batch_index FROM events""")
def s11(spark, sf):
    return slices.number_batches(read_table(spark, sf, "events").select("event_id"), "event_id", 10).select(
        "event_id", "batch_index")


# ---- coercions, predicates, projections -------------------------------------

_DIRTY_SQL = """CASE customer_id % 6 WHEN 0 THEN total_charges || 'd' WHEN 1 THEN ' ' || total_charges || ' '
  WHEN 2 THEN '1,' || total_charges WHEN 3 THEN '+' || total_charges WHEN 4 THEN total_charges || 'e1'
  ELSE total_charges END"""


def _dirty():
    t, k = F.col("total_charges"), F.col("customer_id") % 6
    return (F.when(k == 0, F.concat(t, F.lit("d"))).when(k == 1, F.concat(F.lit(" "), t, F.lit(" ")))
            .when(k == 2, F.concat(F.lit("1,"), t)).when(k == 3, F.concat(F.lit("+"), t))
            .when(k == 4, F.concat(t, F.lit("e1"))).otherwise(t))


@query("p2_coerce_numeric", on_raw(f"""SELECT customer_id, {sql_number("total_charges")} AS total_charges,
  {sql_number("dirty")} AS dirty_number FROM (SELECT *, {_DIRTY_SQL} AS dirty FROM customer360)"""))
def p2(spark, sf):
    names = ["total_charges", "dirty_number"]
    return coerce_numbers(customer360(spark, sf).withColumn("dirty_number", _dirty()), names).select(
        "customer_id", *names)


@query("p3_yes_no", on_raw("SELECT customer_id, " + ", ".join(
    f"{sql_yes_no(c)} AS {c}" for c in [*YES_NO, "contract", "churn"]) + " FROM customer360"))
def p3(spark, sf):
    names = [*YES_NO, "contract", "churn"]
    return map_yes_no(customer360(spark, sf), names).select("customer_id", *names)


@query("p4_features_and_label", on_base("SELECT tenure, monthly_charges, total_charges, churn AS label FROM base"))
def p4(spark, sf):
    base = customer_base(spark, sf)
    return base.select(*feature_columns(base, "churn", "customer_id"), F.col("churn").alias("label"))


@query("p5_serving_rows", on_base("SELECT * EXCLUDE (churn) FROM base"))
def p5(spark, sf):
    return scoring_rows(customer_base(spark, sf), "churn")


@query("p6_aligned_features", on_base("SELECT total_charges, tenure, monthly_charges FROM base"))
def p6(spark, sf):
    base = customer_base(spark, sf)
    return base.select(*aligned(base, ["total_charges", "tenure", "monthly_charges"]))


@query("p8_high_risk_profile", on_base("""SELECT customer_id, CASE WHEN contract = 'Month-to-month'
  AND payment_method = '3-MEDIUM' AND tenure <= 12 THEN 1 ELSE 0 END AS high_risk FROM base"""))
def p8(spark, sf):
    return customer_base(spark, sf).select("customer_id", high_risk_profile(
        F.col("contract"), "Month-to-month", F.col("payment_method"), "3-MEDIUM", F.col("tenure")).alias("high_risk"))


@query("p9_label_text", on_raw("""SELECT customer_id,
  CASE WHEN churn = 'Yes' THEN 'Churn' WHEN churn = 'No' THEN 'No Churn' END AS label_text,
  CASE WHEN churn = 'Yes' THEN 1 WHEN churn = 'No' THEN 0 END AS label_number FROM customer360"""))
def p9(spark, sf):
    return customer360(spark, sf).select("customer_id", label_text(F.col("churn")).alias("label_text"),
                                         label_number(F.col("churn")).alias("label_number"))


@query("p10_complete_rows", on_base("""SELECT customer_id, tenure, total_charges FROM base
  WHERE tenure IS NOT NULL AND monthly_charges IS NOT NULL AND total_charges IS NOT NULL"""))
def p10(spark, sf):
    return customer_base(spark, sf).dropna(subset=NUMERIC).select("customer_id", "tenure", "total_charges")


# ---- quality ------------------------------------------------------------------

_BASE_COLUMNS = ["customer_id", "segment", "nation", "tenure", "monthly_charges", "total_charges", *YES_NO,
                 "internet_service", "contract", "payment_method", "churn"]


@query("q1_nulls", on_base("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count, "
    f"{sql_fixed(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)', 2)} AS null_pct FROM base"
    for c in _BASE_COLUMNS) + ") WHERE null_count > 0"))
def q1(spark, sf):
    return quality.null_report(customer_base(spark, sf))


@query("q2_duplicate_rows", """SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type
  FROM events)) AS BIGINT) AS duplicate_rows FROM events""")
def q2(spark, sf):
    return quality.duplicate_rows(read_table(spark, sf, "events").select("user_id", "event_type"))


@query("q3_duplicate_keys", """SELECT CAST(count(*) - count(DISTINCT o_custkey) AS BIGINT) AS duplicate_keys
  FROM orders""")
def q3(spark, sf):
    return quality.duplicate_keys(read_table(spark, sf, "orders"), "o_custkey")


@query("q4_label_rate", on_base(f"""SELECT count(*) AS n_rows, 15 AS n_columns,
  {sql_fixed("avg(churn) * 100")} AS label_rate_pct FROM base"""))
def q4(spark, sf):
    out = quality.label_rate(customer_base(spark, sf), "churn")
    return out.withColumn("label_rate_pct", fixed(F.col("label_rate_pct")))


_TYPES = {"customer_id": "bigint", "tenure": "int", "monthly_charges": "double", "churn": "int"}


@query("q5_column_profile", on_raw(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_TYPES.get(c, 'string')}' AS dtype, count(DISTINCT {c}) AS n_unique, "
    f"CAST(min({c}) AS VARCHAR) AS sample FROM customer360"
    for c in _BASE_COLUMNS if c not in ("monthly_charges", "churn"))))
def q5(spark, sf):
    return quality.column_profile(customer360(spark, sf).drop("monthly_charges", "churn"))


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {sql_fixed(f'avg({c})', 4)} AS mean, "
        f"{sql_fixed(f'stddev_samp({c})', 4)} AS std, {sql_fixed(f'min({c})', 4)} AS min, "
        f"{sql_fixed(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 4)} AS q25, "
        f"{sql_fixed(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 4)} AS q50, "
        f"{sql_fixed(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 4)} AS q75, "
        f"{sql_fixed(f'max({c})', 4)} AS max FROM {table}" for c in columns)


@query("q6_describe", on_base(_describe_sql("base", NUMERIC)))
def q6(spark, sf):
    return quality.describe(customer_base(spark, sf), NUMERIC, digits=4)


@query("q6_describe_line_items", _describe_sql("lineitem", LINE_NUMBERS))
def q6_lines(spark, sf):
    return quality.describe(read_table(spark, sf, "lineitem"), LINE_NUMBERS, digits=4)


_MEDIANS = "medians AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in NUMERIC) + " FROM base)"
_FILLED = """filled AS (SELECT b.* REPLACE (coalesce(CAST(tenure AS DOUBLE), m_tenure) AS tenure,
  coalesce(monthly_charges, m_monthly_charges) AS monthly_charges,
  coalesce(total_charges, m_total_charges) AS total_charges) FROM base b, medians)"""


@query("q7_nulls_before_after", on_base("""SELECT 'before' AS state,
  CAST(count(*) FILTER (tenure IS NULL) + count(*) FILTER (monthly_charges IS NULL)
   + count(*) FILTER (total_charges IS NULL) + count(*) FILTER (payment_method IS NULL) AS BIGINT) AS null_cells
  FROM base UNION ALL SELECT 'after', CAST(count(*) FILTER (payment_method IS NULL) AS BIGINT) FROM base"""))
def q7(spark, sf):
    base = customer_base(spark, sf)
    filled = impute.MedianImputer(NUMERIC).fit_transform(base)
    return quality.total_nulls(base).select(F.lit("before").alias("state"), "null_cells").unionByName(
        quality.total_nulls(filled).select(F.lit("after").alias("state"), "null_cells"))


def _iqr_sql(table: str, c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM "
            f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 "
            f"FROM {table})")


def _z_sql(table: str, c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", avg({c}) - 3 * stddev_samp({c}) AS lower, "
            f"avg({c}) + 3 * stddev_samp({c}) AS upper FROM {table}")


def _count_sql(table: str, columns: list[str], bounds) -> str:
    return " UNION ALL ".join(
        f"SELECT b.\"column\", {sql_fixed('any_value(b.lower)', 3)} AS lower, "
        f"{sql_fixed('any_value(b.upper)', 3)} AS upper, "
        f"count(*) FILTER (t.{c} < b.lower OR t.{c} > b.upper) AS outliers FROM {table} t, "
        f"({bounds(table, c)}) b GROUP BY b.\"column\"" for c in columns)


def _counted(df, bounds):
    out = outliers.outlier_counts(df, bounds)
    return out.withColumns({"lower": fixed(F.col("lower"), 3), "upper": fixed(F.col("upper"), 3)})


@query("q8_outlier_counts", on_base(_count_sql("base", NUMERIC, _iqr_sql)))
def q8(spark, sf):
    base = customer_base(spark, sf)
    return _counted(base, outliers.iqr_bounds(base, NUMERIC))


@query("q9_z_outlier_rows", on_base(
    "SELECT customer_id FROM base, (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC) + " FROM base) WHERE " + " OR ".join(
        f"coalesce(abs(({c} - m_{c}) / s_{c}) > 2, false)" for c in NUMERIC)))
def q9(spark, sf):
    return quality.z_outlier_rows(customer_base(spark, sf), NUMERIC, 2.0).select("customer_id")


@query("q9_z_outlier_summary", f"""SELECT count(*) AS n_rows, count(*) FILTER (hit) AS n_outliers,
  {sql_fixed("count(*) FILTER (hit) * 100.0 / count(*)")} AS outlier_pct FROM (SELECT
  abs((l_extendedprice - m) / s) > 2 AS hit FROM lineitem, (SELECT avg(l_extendedprice) AS m,
  stddev_pop(l_extendedprice) AS s FROM lineitem))""")
def q9_lines(spark, sf):
    out = quality.z_outlier_summary(read_table(spark, sf, "lineitem"), ["l_extendedprice"], 2.0)
    return out.withColumn("outlier_pct", fixed(F.col("outlier_pct")))


@query("q11_expectations", on_base("""SELECT 'missing_columns' AS "check", CAST(0 AS DOUBLE) AS value, true AS passed
  UNION ALL SELECT 'label_rate:churn', round_even(avg(churn) * 1e6, 0) / 1e6, avg(churn) BETWEEN 0.10 AND 0.40 FROM base
  UNION ALL SELECT 'not_binary:churn', CAST(count(*) FILTER (churn NOT IN (0, 1)) AS DOUBLE),
    count(*) FILTER (churn NOT IN (0, 1)) = 0 FROM base
  UNION ALL SELECT 'not_binary:tenure', CAST(count(*) FILTER (tenure NOT IN (0, 1)) AS DOUBLE),
    count(*) FILTER (tenure NOT IN (0, 1)) = 0 FROM base
  UNION ALL SELECT 'nulls:customer_id', CAST(count(*) FILTER (customer_id IS NULL) AS DOUBLE),
    count(*) FILTER (customer_id IS NULL) = 0 FROM base
  UNION ALL SELECT 'nulls:total_charges', CAST(count(*) FILTER (total_charges IS NULL) AS DOUBLE),
    count(*) FILTER (total_charges IS NULL) = 0 FROM base"""))
def q11(spark, sf):
    out = quality.expectations(customer_base(spark, sf), _BASE_COLUMNS, ["churn", "tenure"], "churn",
                               ["customer_id", "total_charges"])
    return out.withColumn("value", fixed(F.col("value")))


# ---- imputation ----------------------------------------------------------------

@query("i1_mean_fill", on_base(f"""SELECT customer_id, {sql_fixed("coalesce(total_charges, m)", 4)} AS total_charges
  FROM base, (SELECT avg(total_charges) AS m FROM base)"""))
def i1(spark, sf):
    out = impute.MeanImputer(["total_charges"]).fit_transform(customer_base(spark, sf))
    return out.select("customer_id", fixed(F.col("total_charges"), 4).alias("total_charges"))


@query("i2_median_fill", on_base("SELECT customer_id, " + ", ".join(
    f"{sql_fixed(c, 4)} AS {c}" for c in NUMERIC) + " FROM filled", _MEDIANS, _FILLED))
def i2(spark, sf):
    out = impute.MedianImputer(NUMERIC).fit_transform(customer_base(spark, sf))
    return out.select("customer_id", *[fixed(F.col(c), 4).alias(c) for c in NUMERIC])


@query("i3_mode_fill", on_base("""SELECT customer_id, coalesce(gap, m) AS segment FROM
  (SELECT customer_id, CASE WHEN total_charges IS NOT NULL THEN segment END AS gap FROM base),
  (SELECT segment AS m FROM base WHERE total_charges IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment
   LIMIT 1)"""))
def i3(spark, sf):
    gaps = customer_base(spark, sf).select(
        "customer_id", F.when(F.col("total_charges").isNotNull(), F.col("segment")).alias("segment"))
    return impute.ModeImputer(["segment"]).fit_transform(gaps)


@query("i4_knn_fill", on_base(f"""SELECT b.customer_id, {sql_fixed("coalesce(b.total_charges, k.fill, m.m)", 3)}
  AS total_charges FROM base b LEFT JOIN (SELECT customer_id, avg(y) AS fill FROM (
    SELECT r.customer_id, d.total_charges AS y, row_number() OVER (PARTITION BY r.customer_id ORDER BY
      (power(r.tenure - d.tenure, 2) + power(r.monthly_charges - d.monthly_charges, 2)) * 1.5, d.total_charges) AS k
    FROM base r, base d WHERE r.total_charges IS NULL AND d.total_charges IS NOT NULL AND r.tenure IS NOT NULL) WHERE k <= 5 GROUP BY customer_id
  ) k USING (customer_id), (SELECT avg(total_charges) AS m FROM base) m"""))
def i4(spark, sf):
    base = stage(customer_base(spark, sf).select("customer_id", *NUMERIC), "base")
    out = impute.KnnImputer(NUMERIC).fit_transform(base)
    return out.select("customer_id", fixed(F.col("total_charges"), 3).alias("total_charges"))


_GAPS = ["tenure", "monthly_charges", "total_charges"]


def _gap_fill_sql(c: str) -> str:
    both = [f"CASE WHEN r.{x} IS NOT NULL AND d.{x} IS NOT NULL THEN 1 ELSE 0 END" for x in _GAPS]
    far = " + ".join(f"coalesce((r.{x} - d.{x}) * (r.{x} - d.{x}), 0)" for x in _GAPS)
    return f"""f_{c} AS (SELECT customer_id, avg(y) AS fill FROM (SELECT r.customer_id, d.{c} AS y, row_number() OVER
  (PARTITION BY r.customer_id ORDER BY ({far}) * (3.0 / ({" + ".join(both)})), d.{c}) AS k FROM gappy r, gappy d
  WHERE r.{c} IS NULL AND d.{c} IS NOT NULL AND {" + ".join(both)} > 0) WHERE k <= 5 GROUP BY customer_id)"""


@query("i4_knn_three_gaps", on_base(
    "SELECT g.customer_id, " + ", ".join(sql_fixed(f"coalesce(g.{c}, f_{c}.fill, (SELECT avg({c}) FROM gappy))", 3) + f" AS {c}" for c in _GAPS)
    + " FROM gappy g" + "".join(f" LEFT JOIN f_{c} ON f_{c}.customer_id = g.customer_id" for c in _GAPS),
    """gappy AS (SELECT customer_id, CASE WHEN customer_id % 7 <> 0 THEN CAST(tenure AS DOUBLE) END AS tenure,
  CASE WHEN customer_id % 11 <> 0 THEN monthly_charges END AS monthly_charges, total_charges FROM base)""",
    *[_gap_fill_sql(c) for c in _GAPS]))
def i4_three(spark, sf):
    base = stage(customer_base(spark, sf).select("customer_id", *NUMERIC), "base")
    key = F.col("customer_id")
    gappy = base.withColumns({"tenure": F.when(key % 7 != 0, F.col("tenure").cast("double")),
                              "monthly_charges": F.when(key % 11 != 0, F.col("monthly_charges"))})
    out = impute.KnnImputer(_GAPS).fit_transform(gappy)
    return out.select("customer_id", *[fixed(F.col(c), 3).alias(c) for c in _GAPS])


@query("i5_handler", on_base(f"""SELECT customer_id, {sql_fixed("coalesce(total_charges, m)", 4)} AS total_charges,
  coalesce(gap, s) AS segment FROM (SELECT *, CASE WHEN tenure > 6 THEN segment END AS gap FROM base),
  (SELECT quantile_cont(total_charges, 0.5) AS m FROM base),
  (SELECT segment AS s FROM base WHERE tenure > 6 GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)"""))
def i5(spark, sf):
    gaps = customer_base(spark, sf).withColumn("segment", F.when(F.col("tenure") > 6, F.col("segment")))
    out = impute.MissingValueHandler("median", ["total_charges"], ["segment"]).fit_transform(gaps)
    return out.select("customer_id", fixed(F.col("total_charges"), 4).alias("total_charges"), "segment")


# ---- outliers --------------------------------------------------------------------

@query("o1_iqr_bounds", _count_sql("lineitem", LINE_NUMBERS, _iqr_sql))
def o1(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    return _counted(lines, outliers.iqr_bounds(lines, LINE_NUMBERS))


@query("o2_z_bounds", on_base(_count_sql("base", NUMERIC, _z_sql)))
def o2(spark, sf):
    base = customer_base(spark, sf)
    return _counted(base, outliers.z_bounds(base, NUMERIC))


def _bounds_sql(source: str, factor: float) -> str:
    q = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS a_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS z_{c}"
                  for c in NUMERIC)
    b = ", ".join(f"a_{c} - {factor} * (z_{c} - a_{c}) AS lo_{c}, z_{c} + {factor} * (z_{c} - a_{c}) AS hi_{c}"
                  for c in NUMERIC)
    return f"bounds AS (SELECT {b} FROM (SELECT {q} FROM {source}))"


def _capped(c: str) -> str:
    return f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE CAST({c} AS DOUBLE) END"


@query("o3_cap", on_base("SELECT customer_id, " + ", ".join(f"{sql_fixed(_capped(c), 3)} AS {c}" for c in NUMERIC)
                         + " FROM base, bounds", _bounds_sql("base", 0.5)))
def o3(spark, sf):
    base = customer_base(spark, sf)
    out = outliers.OutlierHandler(columns=NUMERIC, factor=0.5).fit_transform(base)
    return out.select("customer_id", *[fixed(F.col(c), 3).alias(c) for c in NUMERIC])


@query("o4_remove", on_base("SELECT customer_id FROM base, bounds WHERE " + " AND ".join(
    f"{c} BETWEEN lo_{c} AND hi_{c}" for c in NUMERIC), _bounds_sql("base", 0.5)))
def o4(spark, sf):
    base = customer_base(spark, sf)
    return outliers.OutlierHandler(action="remove", columns=NUMERIC, factor=0.5).fit_transform(base).select(
        "customer_id")


# ---- derived features ----------------------------------------------------------------

def _active(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('yes', 'dsl', 'fiber optic') THEN 1 ELSE 0 END"


def sql_features(source: str) -> str:
    services = " + ".join(_active(c) for c in FEATURES.services)
    score = sql_fixed(f"({services}) / 6.0", 4)
    return f"""SELECT *,
  CASE WHEN tenure IS NULL OR tenure < 0 OR tenure > 73 THEN 'nan' WHEN tenure <= 12 THEN 'New'
    WHEN tenure <= 24 THEN 'Developing' WHEN tenure <= 48 THEN 'Established' WHEN tenure <= 60 THEN 'Loyal'
    ELSE 'Champion' END AS tenure_category,
  {score} AS service_adoption_score,
  {sql_fixed(f"monthly_charges / ({score} * 6.0 + 1)", 4)} AS avg_monthly_charge_per_service,
  CASE WHEN tenure > 0 THEN {sql_fixed("total_charges / tenure", 4)} ELSE 0.0 END AS charge_to_tenure_ratio,
  CASE WHEN payment_method IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS payment_reliability,
  CASE WHEN lower(internet_service) = 'no' THEN 0 ELSE 1 END AS has_internet,
  CASE WHEN lower(contract) = 'two year' THEN 1 ELSE 0 END AS is_long_term_contract,
  {_active("svc_urgent")} + {_active("svc_high")} AS num_streaming_services,
  {_active("svc_medium")} + {_active("svc_notspec")} + {_active("svc_low")} AS num_security_services,
  CASE WHEN lower(svc_high) = 'yes' THEN 1 ELSE 0 END AS intl_usage_flag FROM {source}"""


@query("f0_service_flags", on_base("SELECT customer_id, " + ", ".join(
    f"{_active(c)} AS {c}" for c in FEATURES.services) + ", CASE WHEN tenure <> 0 OR tenure IS NULL THEN 1 ELSE 0 END "
    "AS tenure, CASE WHEN total_charges <> 0 OR total_charges IS NULL THEN 1 ELSE 0 END AS total_charges FROM base"))
def f0(spark, sf):
    base = customer_base(spark, sf)
    names = [*FEATURES.services, "tenure", "total_charges"]
    return base.select("customer_id", *[service_active(base, c).alias(c) for c in names])


@query("f11_features", on_base(
    "SELECT customer_id, " + ", ".join(features.FEATURES) + " FROM (" + sql_features("base") + ")"))
def f11(spark, sf):
    return features.derive_features(customer_base(spark, sf), FEATURES).select("customer_id", *features.FEATURES)


# ---- encoding ------------------------------------------------------------------------

_CONTRACTS = ["Month-to-month", "One year", "Two year"]
_INTERNET = ["DSL", "Fiber optic", "No"]


@query("e1_onehot", on_base("SELECT customer_id, " + ", ".join(
    [f"CASE WHEN contract = '{v}' THEN 1 ELSE 0 END AS \"contract_{v}\"" for v in _CONTRACTS[1:]]
    + [f"CASE WHEN internet_service = '{v}' THEN 1 ELSE 0 END AS \"internet_service_{v}\"" for v in _INTERNET[1:]])
    + " FROM base"))
def e1(spark, sf):
    base = customer_base(spark, sf).select("customer_id", "contract", "internet_service")
    return encode.OneHotEncoder(["contract", "internet_service"]).fit_transform(base)


@query("e1_onehot_wide", """WITH codes AS (SELECT w, row_number() OVER (ORDER BY w) - 1 AS code, count(*) OVER () AS n FROM
  (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS w FROM orders))
  SELECT o_orderkey, CAST(n - 1 AS INTEGER) AS width, CASE WHEN code > 0 THEN CAST(code - 1 AS INTEGER) END AS place
  FROM orders JOIN codes ON w = CAST(o_custkey AS VARCHAR)""")
def e1_wide(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = encode.OneHotEncoder(["o_custkey"], output="vector").fit_transform(orders)
    # A sparse vector shows as (width,[places],[values]).
    shown = F.col("o_custkey_onehot").cast("string")
    return out.select("o_orderkey", F.regexp_extract(shown, r"^\((\d+),", 1).cast("int").alias("width"),
                      F.regexp_extract(shown, r"\[(\d*)\],\[(1\.0)?\]\)$", 1).try_cast("int").alias("place"))



@query("e2_label_codes", on_base("""SELECT customer_id, a.code AS segment, n.code AS nation, p.code AS payment_method
  FROM base b
  JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT segment AS v FROM base)) a
    ON a.v = b.segment
  JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT nation AS v FROM base)) n
    ON n.v = b.nation
  JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
    (SELECT DISTINCT coalesce(payment_method, 'None') AS v FROM base)) p ON p.v = coalesce(b.payment_method, 'None')"""))
def e2(spark, sf):
    names = ["segment", "nation", "payment_method"]
    return encode.LabelEncoder(names).fit_transform(customer_base(spark, sf).select("customer_id", *names))


@query("e3_target_means", on_base(f"""SELECT customer_id, {sql_fixed("coalesce(s.m, g.m)")} AS segment,
  {sql_fixed("coalesce(n.m, g.m)")} AS nation, {sql_fixed("coalesce(p.m, g.m)")} AS payment_method FROM base b
  LEFT JOIN (SELECT segment AS v, avg(churn) AS m FROM base GROUP BY segment) s ON s.v = b.segment
  LEFT JOIN (SELECT nation AS v, avg(churn) AS m FROM base GROUP BY nation) n ON n.v = b.nation
  LEFT JOIN (SELECT payment_method AS v, avg(churn) AS m FROM base WHERE payment_method IS NOT NULL
    GROUP BY payment_method) p ON p.v = b.payment_method, (SELECT avg(churn) AS m FROM base) g"""))
def e3(spark, sf):
    names = ["segment", "nation", "payment_method"]
    out = encode.TargetEncoder(names, "churn").fit_transform(customer_base(spark, sf))
    return out.select("customer_id", *[fixed(F.col(c)).alias(c) for c in names])


@query("e4_encoder_by_name", on_base(f"""SELECT 'label' AS method, customer_id, CAST(code AS DOUBLE) AS value FROM base JOIN
  (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT contract AS v FROM base)) ON v = contract
  UNION ALL SELECT 'onehot', customer_id, CASE WHEN contract = 'Two year' THEN 1.0 ELSE 0.0 END FROM base
  UNION ALL SELECT 'target', customer_id, {sql_fixed("m")} FROM base JOIN
  (SELECT contract AS v, avg(churn) AS m FROM base GROUP BY contract) ON v = contract"""))
def e4(spark, sf):
    base = customer_base(spark, sf).select("customer_id", "contract", "churn")
    parts = []
    for method, shown in (("label", "contract"), ("onehot", "contract_Two year"), ("target", "contract")):
        out = encode.create_encoder(method, ["contract"], target="churn").fit_transform(base)
        parts.append(out.select(F.lit(method).alias("method"), "customer_id", fixed(F.col(f"`{shown}`")).alias("value")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- scaling ---------------------------------------------------------------------------

def _scaled(spark, sf, name):
    out = scale.create_scaler(name, NUMERIC).fit_transform(customer_base(spark, sf))
    return out.select("customer_id", *[fixed(F.col(c)).alias(c) for c in NUMERIC])


def _scale_sql(centre: str, width: str) -> str:
    stats = ", ".join(f"{centre.format(c=c)} AS a_{c}, {width.format(c=c)} AS w_{c}" for c in NUMERIC)
    out = ", ".join(
        f"{sql_fixed(f'({c} - a_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END')} AS {c}" for c in NUMERIC)
    return on_base(f"SELECT customer_id, {out} FROM base, (SELECT {stats} FROM base)")


@query("c1_standard", _scale_sql("avg({c})", "stddev_pop({c})"))
def c1(spark, sf):
    return _scaled(spark, sf, "standard")


@query("c2_minmax", _scale_sql("min({c})", "(max({c}) - min({c}))"))
def c2(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("c3_robust", _scale_sql(
    "quantile_cont(CAST({c} AS DOUBLE), 0.5)",
    "(quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25))"))
def c3(spark, sf):
    return _scaled(spark, sf, "robust")


# ---- binning ---------------------------------------------------------------------------

def sql_quantile_bin(c: str, labels: list[str], name: str) -> str:
    """Bin label by edges e_<column>_<i>; the fixtures have distinct edges."""
    n = len(labels)
    whens = " ".join(f"WHEN {c} <= e_{c}_{i + 1} THEN '{labels[i]}'" for i in range(n))
    return f"CASE WHEN {c} IS NULL OR {c} < e_{c}_0 OR {c} > e_{c}_{n} THEN 'nan' {whens} END AS {name}"


def sql_edges(c: str, n: int) -> str:
    return ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {i / n!r}) AS e_{c}_{i}" for i in range(n + 1))


@query("b1_quantile_bins", on_base(
    "SELECT customer_id, " + sql_quantile_bin("tenure", settings.TENURE_BIN_LABELS, "tenure_bin") + ", "
    + sql_quantile_bin("monthly_charges", settings.CHARGE_BIN_LABELS, "monthly_charges_bin")
    + f" FROM base, (SELECT {sql_edges('tenure', 5)}, {sql_edges('monthly_charges', 4)} FROM base)"))
def b1(spark, sf):
    bins = [binning.BinConfig("tenure", 5, "quantile", settings.TENURE_BIN_LABELS),
            binning.BinConfig("monthly_charges", 4, "quantile", settings.CHARGE_BIN_LABELS)]
    return binning.FeatureBinner(bins).fit_transform(customer_base(spark, sf)).select(
        "customer_id", "tenure_bin", "monthly_charges_bin")


@query("b2_uniform_bins", on_base("""SELECT customer_id,
  CASE WHEN total_charges IS NULL THEN 'nan' WHEN total_charges <= lo + (hi - lo) / 4 THEN 'Budget'
    WHEN total_charges <= lo + 2 * ((hi - lo) / 4) THEN 'Standard'
    WHEN total_charges <= lo + 3 * ((hi - lo) / 4) THEN 'Premium' ELSE 'Ultra' END AS total_charges_bin
  FROM base, (SELECT min(total_charges) AS lo, max(total_charges) AS hi FROM base)"""))
def b2(spark, sf):
    bins = [binning.BinConfig("total_charges", 4, "uniform", settings.CHARGE_BIN_LABELS)]
    return binning.FeatureBinner(bins).fit_transform(customer_base(spark, sf)).select(
        "customer_id", "total_charges_bin")


@query("b4_enable_switch", on_base("""SELECT false AS enabled, CAST(NULL AS VARCHAR) AS bin, count(*) AS n FROM base UNION ALL
  SELECT true, CASE WHEN total_charges IS NULL THEN 'nan' WHEN total_charges <= lo + (hi - lo) / 2 THEN 'low' ELSE 'high' END, count(*)
  FROM base, (SELECT min(total_charges) AS lo, max(total_charges) AS hi FROM base) GROUP BY 2"""))
def b4(spark, sf):
    base = customer_base(spark, sf).select("customer_id", "total_charges")
    parts = []
    for enabled in (False, True):
        out = binning.FeatureBinner([binning.BinConfig("total_charges", 2, "uniform", ["low", "high"])], enabled).fit_transform(base)
        shown = F.col("total_charges_bin") if "total_charges_bin" in out.columns else F.lit(None).cast("string")
        parts.append(out.groupBy(F.lit(enabled).alias("enabled"), shown.alias("bin")).agg(F.count("*").alias("n")))
    return parts[0].unionByName(parts[1])


def _interval(i: int) -> str:
    low = f"(e_tenure_{i} - 0.001)" if i == 0 else f"e_tenure_{i}"
    return f"'(' || CAST(round({low}, 3) AS VARCHAR) || ', ' || CAST(round(e_tenure_{i + 1}, 3) AS VARCHAR) || ']'"


@query("b3_interval_texts", on_base(
    "SELECT customer_id, CASE WHEN tenure IS NULL THEN 'nan' "
    + " ".join(f"WHEN tenure <= e_tenure_{i + 1} THEN {_interval(i)}" for i in range(4))
    + f" END AS tenure_bin FROM base, (SELECT {sql_edges('tenure', 4)} FROM base)"))
def b3(spark, sf):
    out = binning.FeatureBinner([binning.BinConfig("tenure", 4)]).fit_transform(customer_base(spark, sf))
    return out.select("customer_id", "tenure_bin")


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate"]


@query("p1_schema_check", """SELECT 'extra' AS status, name, n FROM (SELECT 'o_totalprice' AS name, count(o_totalprice) AS n FROM orders
  UNION ALL SELECT 'o_orderpriority', count(o_orderpriority) FROM orders UNION ALL SELECT 'o_orderstatus', count(o_orderstatus) FROM orders)
  UNION ALL SELECT 'missing', 'o_note', count(*) FROM orders""")
def p1(spark, sf):
    """Values in columns that nobody expects, and rows that lack an expected one."""
    orders = read_table(spark, sf, "orders")
    extra = files.check_columns(orders, _ORDER_COLUMNS)
    rows = [orders.agg(F.count(c).alias("n")).select(F.lit("extra").alias("status"), F.lit(c).alias("name"), "n") for c in extra]
    try:
        files.check_columns(orders, [*_ORDER_COLUMNS, "o_note"])
    except files.SchemaError as error:
        lacking = str(error).split("'")[1]
        rows.append(orders.agg(F.count("*").alias("n")).select(F.lit("missing").alias("status"), F.lit(lacking).alias("name"), "n"))
    return reduce(DataFrame.unionByName, rows)
