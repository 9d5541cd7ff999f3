"""Column expressions shared by the operators; all stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import settings

# Fixed value: what counts as a number in text, blanks around it allowed.
NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"

MISSING_TEXT = "nan"


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    c = column(name)
    return (c.isNull() | F.isnan(c)) if is_floating(df, name) else c.isNull()


def number(df: DataFrame, name: str) -> Column:
    """The column as double with NaN turned into null."""
    c = column(name).cast("double")
    return F.when(~F.isnan(c), c) if is_floating(df, name) else c


def round_to(c: Column, digits: int) -> Column:
    """Round half to even on the scaled value, as NumPy does."""
    scale = F.lit(float(10**digits))
    return F.rint(c * scale) / scale


def to_number(c: Column) -> Column:
    """Text to double; text that is not a plain number becomes null."""
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def yes_no(c: Column) -> Column:
    return F.when(c == "Yes", F.lit(1)).when(c == "No", F.lit(0))


def label_text(c: Column) -> Column:
    """Yes or 1 to 'Churn', No or 0 to 'No Churn', anything else to null."""
    text = c.cast("string")
    return F.when(text.isin("Yes", "1"), F.lit("Churn")).when(text.isin("No", "0"), F.lit("No Churn"))


def label_number(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isin("Yes", "1"), F.lit(1)).when(text.isin("No", "0"), F.lit(0))


def clip(c: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def service_active(df: DataFrame, name: str) -> Column:
    """1 for an active service flag, else 0.

    Numbers count unless they are 0, and a missing number counts too; text
    counts when it is one of the active texts.
    """
    c = column(name)
    if is_numeric(df, name) or isinstance(df.schema[name].dataType, T.BooleanType):
        return F.coalesce((c.cast("double") != 0).cast("int"), F.lit(1))
    return F.coalesce(F.lower(F.trim(c)).isin(settings.ACTIVE_SERVICE_TEXTS).cast("int"), F.lit(0))


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) if columns else F.lit(0)


def cut(c: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed segments with the lowest edge included.

    A value outside the edges, or a missing one, gets the text 'nan'.
    """
    if len(labels) != max(len(edges) - 1, 0):
        raise ValueError("need one label per segment")
    if not labels:
        return F.lit(MISSING_TEXT)
    expr = F.when(c.isNull() | (c < edges[0]) | (c > edges[-1]), F.lit(MISSING_TEXT))
    for edge, label in zip(edges[1:], labels):
        expr = expr.when(c <= edge, F.lit(label))
    return expr.otherwise(F.lit(MISSING_TEXT))


def risk_tier(score: Column, high: float = settings.HIGH_RISK, medium: float = settings.MEDIUM_RISK,
              names: tuple[str, str, str] = ("High", "Medium", "Low")) -> Column:
    return (F.when(score >= high, F.lit(names[0]))
            .when(score >= medium, F.lit(names[1]))
            .otherwise(F.lit(names[2])))


def stream_tier(rounded_score: Column, high: float = settings.HIGH_RISK,
                medium: float = settings.MEDIUM_RISK) -> Column:
    """Tier of the score as it is written out, that is after rounding."""
    return risk_tier(rounded_score, high, medium, ("HIGH", "MEDIUM", "LOW"))


def high_risk_profile(contract: Column, contract_value: str, payment: Column, payment_value: str,
                      tenure: Column, max_tenure: float = 12) -> Column:
    hit = (contract == contract_value) & (payment == payment_value) & (tenure <= max_tenure)
    return F.coalesce(hit, F.lit(False)).cast("int")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """The quotient, or 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def hash_order(key: Column, seed: int, method: str = "xxhash64") -> Column:
    """A seeded pseudo-random 52-bit number per key.

    Values stay below 2**52, so they are exact as doubles.  ``md5`` is slower
    but any other engine can reproduce it.
    """
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 12)
    if method == "md5":
        digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method {method!r}; choose xxhash64 or md5")
