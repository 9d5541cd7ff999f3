"""Risk tiers, revenue at risk and customer segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, number, round_to


def tier_counts(df: DataFrame, tier: str = "risk_tier") -> DataFrame:
    return df.groupBy(column(tier).alias("tier")).agg(F.count("*").alias("n"))


def prediction_counts(df: DataFrame, tier: str = "risk_tier", prediction: str = "prediction") -> DataFrame:
    """One row: total, predicted positives and the rows per tier."""
    return df.agg(F.count("*").alias("total"), F.count_if(column(prediction) == 1).alias("predicted_positive"),
                  *[F.count_if(F.lower(column(tier)) == t).alias(f"n_{t}") for t in ("high", "medium", "low")])


def tier_summary(df: DataFrame, tier: str = "risk_tier", seconds: float | None = None) -> DataFrame:
    """One row: rows and the percentage per tier; with ``seconds`` also rows per second."""
    counts = prediction_counts(df.withColumn("_p", F.lit(0)), tier, "_p").drop("predicted_positive")
    rows = F.greatest(F.col("total"), F.lit(1))
    out = counts.withColumns({f"pct_{t}": 100.0 * F.col(f"n_{t}") / rows for t in ("high", "medium", "low")})
    if seconds is not None:
        out = out.withColumn("rows_per_second", F.col("total") / F.lit(max(seconds, 1e-6)))
    return out


def revenue_at_risk(df: DataFrame, label: str, revenue: float = settings.MONTHLY_REVENUE,
                    months: float = settings.LIFETIME_MONTHS, offer: float = settings.OFFER_COST,
                    success: float = settings.OFFER_SUCCESS) -> DataFrame:
    """One row; assumes that every positive customer would leave."""
    row = df.agg(F.count("*").alias("n_customers"), F.count_if(number(df, label) == 1).alias("n_churners"))
    value = F.lit(revenue * months)
    saved = F.col("n_churners") * F.lit(success)
    cost = F.col("n_churners") * F.lit(float(offer))
    net = saved * value - cost
    return row.select("n_customers", "n_churners",
                      F.coalesce(F.try_divide("n_churners", "n_customers"), F.lit(0.0)).alias("churn_rate"),
                      (F.col("n_churners") * value).alias("revenue_at_risk"), cost.alias("intervention_cost"),
                      saved.alias("customers_saved"), (saved * value).alias("revenue_saved"),
                      net.alias("net_benefit"), (F.try_divide(net, cost) * 100).alias("roi_pct"))


def profile_uplift(df: DataFrame, profile: Column, label: str) -> DataFrame:
    """One row: size and label rate of the flagged customers against all."""
    y = number(df, label)
    row = df.agg(F.count_if(profile == 1).alias("n_profile"),
                 (F.avg(F.when(profile == 1, y)) * 100).alias("profile_rate_pct"),
                 (F.avg(y) * 100).alias("overall_rate_pct"))
    return row.withColumn("uplift", F.try_divide("profile_rate_pct", "overall_rate_pct"))


def segment_profile(df: DataFrame, segment: str, label: str, means: dict[str, str], digits: int = 2) -> DataFrame:
    """Per segment the size, the label rate in percent and the rounded means.

    The rate is rounded as a share first and again as a percentage.
    """
    rate = round_to(round_to(F.avg(number(df, label)), 2) * 100, 1)
    return df.groupBy(column(segment).alias("segment")).agg(
        F.count(column(label)).alias("n_customers"), rate.alias("churn_rate"),
        *[round_to(F.avg(number(df, c)), digits).alias(name) for name, c in means.items()])
