"""From raw documents to token ids: each stage works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.bpe import ROUND_TRIP, encode_texts, round_trip
from holdfast.llm.jaccard_join import one_per_group
from holdfast.llm.line_dedup import drop_boilerplate, text_lines
from holdfast.llm.mixing import mix
from holdfast.llm.quality_rules import keep_good
from holdfast.llm.queries import vocabulary
from holdfast.session import stage

#: A source is the site of its documents; a line on more than this share of them goes.
LINE_SHARE = 0.05


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays, with its new length.  Copies are left to the next stage."""
    clean = drop_boilerplate(docs, F.col("source"), text_lines(), share=LINE_SHARE, leave_copies=True)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes it."""
    # The row travels as one column, so none of its names meets one of the mix.
    packed = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"))
    taken = mix(packed).select("whole_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"))
    return taken.select("whole_row.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, and a digest of the text that they decode to."""
    coded = encode_texts(docs, vocabulary("word_bpe_49k.json"), into="out", finish=round_trip, returns=ROUND_TRIP, keep=False)
    return coded.select("doc_id", "lang", "source", "out.n_tokens", "out.ids", "out.decoded_sha256")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join),
          ("mixing", mixing), ("bpe", bpe)]

#: The joins, the draw and the encoding have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
