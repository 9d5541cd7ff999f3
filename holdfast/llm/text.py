"""Expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the six ASCII white-space characters that end a word.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: One or more of them, for the JVM's and for Python's expressions.
SPACES = r"[\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; none where it is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as keep it apart from the frame's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
