"""Derived features; every one is a projection, so they fuse with the scan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, cut, number, present, round_to, service_active, total


@dataclass(frozen=True)
class FeatureColumns:
    """Source columns, category texts and output names of the derived features."""

    tenure: str = "tenure"
    monthly: str = "MonthlyCharges"
    total: str = "TotalCharges"
    payment: str = "PaymentMethod"
    contract: str = "Contract"
    internet: str = "InternetService"
    lines: str = "MultipleLines"
    services: list[str] = field(default_factory=lambda: list(settings.SERVICE_COLUMNS))
    streaming: list[str] = field(default_factory=lambda: list(settings.STREAMING_COLUMNS))
    security: list[str] = field(default_factory=lambda: list(settings.SECURITY_COLUMNS))
    auto_payments: list[str] = field(default_factory=lambda: list(settings.AUTO_PAYMENT_METHODS))
    edges: list[float] = field(default_factory=lambda: list(settings.TENURE_EDGES))
    labels: list[str] = field(default_factory=lambda: list(settings.TENURE_LABELS))
    names: dict[str, str] = field(default_factory=dict)

    def name(self, feature: str) -> str:
        return self.names.get(feature, feature)


def tenure_category(df: DataFrame, c: FeatureColumns) -> Column:
    return cut(number(df, c.tenure), c.edges, c.labels)


def active_count(df: DataFrame, columns: list[str]) -> Column:
    return total([service_active(df, n) for n in present(df, columns)])


def service_adoption_score(df: DataFrame, c: FeatureColumns) -> Column:
    n = len(present(df, c.services))
    return round_to(active_count(df, c.services) / F.lit(float(n)), 4) if n else F.lit(0.0)


def avg_monthly_charge_per_service(df: DataFrame, c: FeatureColumns) -> Column:
    """Divides by the service count as recovered from the rounded adoption score."""
    services = service_adoption_score(df, c) * F.lit(float(len(present(df, c.services))))
    return round_to(number(df, c.monthly) / (services + 1), 4)


def charge_to_tenure_ratio(df: DataFrame, c: FeatureColumns) -> Column:
    tenure = number(df, c.tenure)
    return F.when(tenure > 0, round_to(number(df, c.total) / tenure, 4)).otherwise(F.lit(0.0))


def payment_reliability(df: DataFrame, c: FeatureColumns) -> Column:
    return F.coalesce(column(c.payment).isin(c.auto_payments), F.lit(False)).cast("int")


def has_internet(df: DataFrame, c: FeatureColumns) -> Column:
    return F.coalesce(F.lower(column(c.internet)) != "no", F.lit(True)).cast("int")


def is_long_term_contract(df: DataFrame, c: FeatureColumns) -> Column:
    return F.coalesce(F.lower(column(c.contract)) == "two year", F.lit(False)).cast("int")


def num_streaming_services(df: DataFrame, c: FeatureColumns) -> Column:
    return active_count(df, c.streaming)


def num_security_services(df: DataFrame, c: FeatureColumns) -> Column:
    return active_count(df, c.security)


def intl_usage_flag(df: DataFrame, c: FeatureColumns) -> Column:
    if c.lines not in df.columns:
        return F.lit(0)
    return F.coalesce(F.lower(column(c.lines)) == "yes", F.lit(False)).cast("int")


# In output order.
FEATURES = {
    "tenure_category": tenure_category,
    "service_adoption_score": service_adoption_score,
    "avg_monthly_charge_per_service": avg_monthly_charge_per_service,
    "charge_to_tenure_ratio": charge_to_tenure_ratio,
    "payment_reliability": payment_reliability,
    "has_internet": has_internet,
    "is_long_term_contract": is_long_term_contract,
    "num_streaming_services": num_streaming_services,
    "num_security_services": num_security_services,
    "intl_usage_flag": intl_usage_flag,
}


def derive_features(df: DataFrame, columns: FeatureColumns | None = None,
                    only: list[str] | None = None) -> DataFrame:
    c = columns or FeatureColumns()
    return df.withColumns({c.name(f): build(df, c) for f, build in FEATURES.items() if only is None or f in only})
