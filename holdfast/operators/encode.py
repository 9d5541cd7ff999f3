"""Categorical encoders, fitted on the training rows."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder as MlOneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.functions.expressions import column, is_floating, missing, present
from holdfast.functions.ordering import running_totals
from holdfast.operators.base import FittedOperator, pick
from holdfast.session import stage


class UnseenCategory(ValueError):
    pass


def _text(df: DataFrame, name: str):
    """The value as text, a missing one as the text of a missing value."""
    c = column(name)
    if is_floating(df, name):
        return F.when(missing(df, name), F.lit("nan")).otherwise(c.cast("string"))
    return F.coalesce(c.cast("string"), F.lit("None"))


def _counted_values(df: DataFrame, names: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.when(~missing(df, n), column(n).cast("string")).alias("value"))
                      for n in names])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("name", "value").count()


def _coded(words: DataFrame) -> DataFrame:
    """``name, word, code``: the position of each word among those of its name."""
    numbered = running_totals(stage(words.withColumn("one", F.lit(1)), "words"), [F.asc("word")], {"upto": "one"}, "name")
    return stage(numbered.select("name", "word", (F.col("upto") - 1).alias("code")), "codes")


class _LookupEncoder(FittedOperator):
    """Encoders whose state is a (name, word, ...) table of any size.

    The table is written once at fit time and the lookup is a join: the planner
    broadcasts a small table, and a hot category on the data side is split by
    the skew join.
    """

    def look_up(self, df: DataFrame, name: str, word: Column, value: str) -> DataFrame:
        words = self.tables["words"].where(F.col("name") == name).select(
            F.col("word").alias("_word"), F.col(value).alias("_value"))
        return df.withColumn("_text", word).join(words, F.col("_text") == F.col("_word"), "left")


def _typed(text: str, kind: str):
    if kind == "boolean":
        return text == "true"
    if kind in ("byte", "short", "integer", "long"):
        return int(text)
    return float(text) if kind in ("float", "double") else text


class OneHotEncoder(_LookupEncoder):
    """0/1 per category in sorted order; unseen and missing values give all 0.

    ``output="columns"`` makes a ``column_category`` column of each category, so
    the driver has to know them all.  ``output="vector"`` makes one sparse vector
    ``column_onehot`` per column, from a table of categories that only executors
    read; it may be of any width.  There the categories are in the order of their
    texts.
    """

    kind = "encode_onehot"

    def __init__(self, columns: list[str], drop_first: bool = True, output: str = "columns"):
        if output not in ("columns", "vector"):
            raise ValueError(f"unknown output {output!r}; choose columns or vector")
        super().__init__(columns=list(columns), drop_first=drop_first, output=output)

    def learn(self, df: DataFrame) -> dict:
        names = present(df, self.options["columns"])
        if not names:
            return {}
        values = _counted_values(df, names).select("name", F.col("value").alias("word"))
        if self.options["output"] == "vector":
            self.tables = {"words": _coded(values)}
            return {r["name"]: r["n"] for r in self.tables["words"].groupBy("name").agg(F.count("*").alias("n")).collect()}
        found: dict[str, list] = {n: [] for n in names}
        for name, word in values.collect():
            found[name].append(_typed(word, df.schema[name].dataType.typeName()))
        return {n: sorted(v) for n, v in found.items()}

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        if self.options["output"] == "vector":
            return self._vectors(df, state)
        added, dropped = {}, []
        for name, categories in state.items():
            if name not in df.columns:
                continue
            dropped.append(name)
            for category in categories[1:] if self.options["drop_first"] else categories:
                own = column(name).cast("string") if isinstance(category, str) else column(name)
                added[f"{name}_{category}"] = F.coalesce(own == F.lit(category), F.lit(False)).cast("int")
        df = df.withColumns(added) if added else df
        return df.drop(*dropped)

    def _vectors(self, df: DataFrame, state: dict) -> DataFrame:
        skipped = int(self.options["drop_first"])
        for name, n in state.items():
            if name not in df.columns:
                continue
            width = n - skipped
            if width < 1:
                df = df.drop(name)
                continue
            word = F.when(~missing(df, name), column(name).cast("string"))
            df = self.look_up(df, name, word, "code")
            # A value outside 0..width-1 stands for no category; the encoder gives it no entry.
            place = F.coalesce(F.when(F.col("_value") >= skipped, F.col("_value") - skipped), F.lit(width)).cast("double")
            df = df.withColumn("_place", place.alias("_place", metadata={"ml_attr": {"type": "nominal", "num_vals": width}}))
            encoder = MlOneHotEncoder(inputCol="_place", outputCol=f"{name}_onehot", handleInvalid="keep", dropLast=True)
            df = encoder.fit(df).transform(df).drop("_place", "_text", "_word", "_value", name)
        return df


class LabelEncoder(_LookupEncoder):
    """Position of the value's text in sorted order."""

    kind = "encode_label"

    def __init__(self, columns: list[str], unseen: str = "error"):
        if unseen not in ("error", "keep"):
            raise ValueError(f"unknown treatment {unseen!r}; choose error or keep")
        super().__init__(columns=list(columns), unseen=unseen)

    def learn(self, df: DataFrame) -> dict:
        names = present(df, self.options["columns"])
        if not names:
            return {"columns": []}
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), _text(df, n).alias("word")) for n in names])
        self.tables = {"words": _coded(df.select(F.inline(pairs)).distinct())}
        return {"columns": names}

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        order = df.columns
        for n in present(df, state["columns"]):
            df = self.look_up(df, n, _text(df, n), "code")
            code = F.col("_value")
            if self.options["unseen"] == "error":
                unseen = F.raise_error(F.concat(F.lit(f"unseen category in {n}: "), F.col("_text")))
                code = F.when(code.isNull(), unseen.cast("bigint")).otherwise(code)
            df = df.withColumn(n, code).drop("_text", "_word", "_value")
        return df.select(*[column(n) for n in order])


class TargetEncoder(_LookupEncoder):
    """Mean of the target per category; unseen and missing get the overall mean."""

    kind = "encode_target"

    def __init__(self, columns: list[str], target: str | None = None):
        super().__init__(columns=list(columns), target=target)

    def learn(self, df: DataFrame) -> dict:
        target = self.options["target"]
        if target is None or target not in df.columns:
            raise ValueError("target encoding needs a target column")
        names = present(df, self.options["columns"])
        y = column(target).cast("double")
        overall = df.agg(F.avg(y)).first()[0]
        if names:
            pairs = F.array(*[F.struct(F.lit(n).alias("name"), self._word(df, n).alias("word")) for n in names])
            means = (df.select(y.alias("_y"), F.inline(pairs)).where(F.col("word").isNotNull())
                     .groupBy("name", "word").agg(F.avg("_y").alias("mean")))
            self.tables = {"words": stage(means, "means")}
        return {"columns": names, "overall": overall}

    @staticmethod
    def _word(df: DataFrame, name: str) -> Column:
        return F.when(~missing(df, name), column(name).cast("string"))

    def apply(self, df: DataFrame, state: dict) -> DataFrame:
        order = df.columns
        for n in present(df, state["columns"]):
            df = self.look_up(df, n, self._word(df, n), "mean")
            df = df.withColumn(n, F.coalesce(F.col("_value"), F.lit(state["overall"]))).drop("_text", "_word", "_value")
        return df.select(*[column(n) for n in order])


METHODS = {"onehot": OneHotEncoder, "label": LabelEncoder, "target": TargetEncoder}


def create_encoder(name: str, columns: list[str] | None = None, drop_first: bool = True,
                   target: str | None = None, unseen: str = "error") -> FittedOperator:
    cls = pick(METHODS, name, "encoding method")
    columns = settings.CATEGORICAL_COLUMNS if columns is None else columns
    if cls is OneHotEncoder:
        return OneHotEncoder(columns, drop_first)
    return LabelEncoder(columns, unseen) if cls is LabelEncoder else TargetEncoder(columns, target)
