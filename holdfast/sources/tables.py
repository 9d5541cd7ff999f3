"""One row per customer, derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.expressions import to_number, yes_no

# Declared, so that opening a table starts no job to look at file footers.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


# The order priorities, by their leading digit.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def customer360(spark: SparkSession, folder: str) -> DataFrame:
    """Raw customer table: two charges (one as text with blanks), services, contract, label.

    The order side is reduced to one row per customer before the join, so a
    customer with very many orders costs one partial aggregate per task.
    """
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    orders = read_table(spark, folder, "orders")

    # Only fixed-width values are aggregated: a text among them would turn the
    # hash aggregate into a sort of all orders.
    digit = F.ascii("o_orderpriority") - F.ascii(F.lit("0"))
    latest = orders.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"),
        F.max_by("o_orderdate", "o_orderkey").alias("ref_dt"),
        F.max_by("o_totalprice", "o_orderkey").alias("last_price"),
        F.max_by(digit, "o_orderkey").alias("last_digit"),
        F.max("o_orderdate").alias("last_dt"),
        F.sum(F.when(digit == 1, F.col("o_totalprice").cast("decimal(18,2)"))).alias("urgent_price"),
        F.bit_or(F.expr("shiftleft(1, ascii(o_orderpriority) - ascii('0'))")).alias("digits"),
    )
    last_priority = F.when(F.lit(False), F.lit(""))
    for i, text in enumerate(PRIORITIES, 1):
        last_priority = last_priority.when(F.col("last_digit") == i, F.lit(text))

    def flag(i: int):
        return F.when(F.col("digits").bitwiseAND(1 << i) > 0, "Yes").otherwise("No")

    ref = F.col("ref_dt")
    balance = F.col("c_acctbal")
    cutoff = F.lit("2001-02-01 00:00:00").cast("timestamp_ntz")
    joined = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
              .join(latest, customer.c_custkey == latest.o_custkey, "left"))
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        ((2001 - F.year(ref)) * 12 + (8 - F.month(ref))).alias("tenure"),
        F.col("last_price").alias("monthly_charges"),
        F.coalesce(F.col("urgent_price").cast("string"), F.lit(" ")).alias("total_charges"),
        flag(1).alias("svc_urgent"), flag(2).alias("svc_high"), flag(3).alias("svc_medium"),
        flag(4).alias("svc_notspec"), flag(5).alias("svc_low"),
        F.when(F.col("n_orders") >= 14, "Fiber optic").when(F.col("n_orders") >= 8, "DSL")
        .otherwise("No").alias("internet_service"),
        F.when(balance >= 7000, "Two year").when(balance >= 4000, "One year")
        .otherwise("Month-to-month").alias("contract"),
        last_priority.alias("payment_method"),
        F.when(F.col("last_dt").isNull() | (F.col("last_dt") < cutoff), "Yes").otherwise("No").alias("churn"),
    )


def customer_base(spark: SparkSession, folder: str) -> DataFrame:
    """``customer360`` with a numeric ``total_charges`` and a 0/1 ``churn``."""
    return customer360(spark, folder).withColumns(
        {"total_charges": to_number(F.col("total_charges")), "churn": yes_no(F.col("churn"))})


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    """(customer_id, label, score) with many tied scores."""
    c = customer360(spark, folder).where(F.col("tenure").isNotNull())
    return c.select("customer_id", F.when(F.col("churn") == "Yes", 1).otherwise(0).alias("label"),
                    F.round(F.col("tenure") / F.lit(100.0), 2).alias("score"))
