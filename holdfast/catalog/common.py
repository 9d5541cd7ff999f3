"""Shared inputs of the registered queries, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column

from holdfast.functions.expressions import round_to
from holdfast.operators.features import FeatureColumns

NUMERIC = ["tenure", "monthly_charges", "total_charges"]
YES_NO = ["svc_urgent", "svc_high", "svc_medium", "svc_notspec", "svc_low"]
CATEGORICAL = ["segment", "internet_service", "contract", "payment_method"]

FEATURES = FeatureColumns(
    tenure="tenure", monthly="monthly_charges", total="total_charges", payment="payment_method",
    contract="contract", internet="internet_service", lines="svc_high",
    services=[*YES_NO, "internet_service"], streaming=["svc_urgent", "svc_high"],
    security=["svc_medium", "svc_notspec", "svc_low"], auto_payments=["1-URGENT", "2-HIGH"])


def fixed(c: Column, digits: int = 6) -> Column:
    """Rounded for comparison across engines."""
    return round_to(c.cast("double"), digits)


def sql_fixed(expr: str, digits: int = 6) -> str:
    return f"round_even(CAST({expr} AS DOUBLE) * 1e{digits}, 0) / 1e{digits}"


CUSTOMER360 = """customer360 AS (
SELECT c.c_custkey AS customer_id, c.c_mktsegment AS segment, n.n_name AS nation,
       CAST((2001 - year(o.ref_dt)) * 12 + (8 - month(o.ref_dt)) AS INTEGER) AS tenure,
       o.last_price AS monthly_charges,
       CASE WHEN o.urgent_price IS NULL THEN ' ' ELSE CAST(o.urgent_price AS VARCHAR) END AS total_charges,
       CASE WHEN o.p1 = 1 THEN 'Yes' ELSE 'No' END AS svc_urgent,
       CASE WHEN o.p2 = 1 THEN 'Yes' ELSE 'No' END AS svc_high,
       CASE WHEN o.p3 = 1 THEN 'Yes' ELSE 'No' END AS svc_medium,
       CASE WHEN o.p4 = 1 THEN 'Yes' ELSE 'No' END AS svc_notspec,
       CASE WHEN o.p5 = 1 THEN 'Yes' ELSE 'No' END AS svc_low,
       CASE WHEN o.n_orders >= 14 THEN 'Fiber optic' WHEN o.n_orders >= 8 THEN 'DSL' ELSE 'No' END AS internet_service,
       CASE WHEN c.c_acctbal >= 7000 THEN 'Two year' WHEN c.c_acctbal >= 4000 THEN 'One year'
            ELSE 'Month-to-month' END AS contract,
       o.last_priority AS payment_method,
       CASE WHEN o.last_dt IS NULL OR o.last_dt < TIMESTAMP '2001-02-01 00:00:00' THEN 'Yes' ELSE 'No' END AS churn
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, max_by(o_orderdate, o_orderkey) AS ref_dt, max(o_orderdate) AS last_dt,
         max_by(o_totalprice, o_orderkey) AS last_price,
         sum(CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS urgent_price,
         max(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) AS p1,
         max(CASE WHEN o_orderpriority LIKE '2%' THEN 1 ELSE 0 END) AS p2,
         max(CASE WHEN o_orderpriority LIKE '3%' THEN 1 ELSE 0 END) AS p3,
         max(CASE WHEN o_orderpriority LIKE '4%' THEN 1 ELSE 0 END) AS p4,
         max(CASE WHEN o_orderpriority LIKE '5%' THEN 1 ELSE 0 END) AS p5,
         max_by(o_orderpriority, o_orderkey) AS last_priority
  FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey)"""

NUMBER_SQL = r"'^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def sql_number(expr: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({expr}), {NUMBER_SQL}) THEN CAST(trim({expr}) AS DOUBLE) END"


def sql_yes_no(expr: str) -> str:
    return f"CASE {expr} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END"


_BASE = f"""base AS (SELECT customer_id, segment, nation, tenure, monthly_charges,
  {sql_number("total_charges")} AS total_charges, svc_urgent, svc_high, svc_medium, svc_notspec, svc_low,
  internet_service, contract, payment_method, {sql_yes_no("churn")} AS churn FROM customer360)"""

_SCORES = """scores AS (SELECT customer_id, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label,
  round(tenure / 100.0, 2) AS score FROM customer360 WHERE tenure IS NOT NULL)"""

_STEPS = """by_score AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY score),
curve AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM by_score)"""


def on_raw(sql: str) -> str:
    """SQL over ``customer360``."""
    return f"WITH {CUSTOMER360}\n{sql}"


def on_base(sql: str, *ctes: str) -> str:
    """SQL over ``base``: numeric total charges, 0/1 churn."""
    return "WITH " + ",\n".join([CUSTOMER360, _BASE, *ctes]) + f"\n{sql}"


def on_scores(sql: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([CUSTOMER360, _SCORES, *ctes]) + f"\n{sql}"


def on_curve(sql: str, *ctes: str) -> str:
    return on_scores(sql, _STEPS, *ctes)
