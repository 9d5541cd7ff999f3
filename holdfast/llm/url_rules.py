"""URL verdicts from pattern rules that are indexed by their rarest literal token.

Two kinds of rules share one index.  A *site* rule is a host and the beginning of
a path; it fits the host and all its subdomains.  A *pattern* is looked for in the
whole URL with A-Z as a-z: ``*`` stands for any characters, ``^`` for one that is
none of letters, digits and ``_.%-`` or for the end, ``|`` at an end for that end of the URL.

A token is a run of ASCII letters and digits.  Where a rule has one with other
characters on both sides, every URL that the rule fits has it as a token of its
own.  Of these tokens the index takes the one that fewest URLs have.  Each URL
fetches the rules under its tokens, and only those run their regular expression;
a rule without such a token is fetched by every URL.

Everything is a DataFrame function: one shuffle of the URLs, which also counts
equal rows together, and a join with the index, which the planner sends to all
executors only while it is small; else the salt deals out a token of many URLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to the first ``://``; then host, and path up to a question or number sign.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TOKEN = "[0-9a-z]+"
#: A token whose neighbours in the rule are other literal characters.
BOUNDED = r"(?<=[^0-9a-z*])[0-9a-z]+(?=[^0-9a-z*])"
#: Parts of a token's URLs, each with its own copy of the rules.
SALT = 8


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path of a site, or a pattern; ``verdict`` is ``allow`` or ``block``."""

    text: str
    verdict: str
    site: bool = False


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of_url(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1))


def path_of_url(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def _quoted(c: Column) -> Column:
    return F.regexp_replace(c, r"([\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])", r"\\$1")


def _regex(text: Column, site: Column) -> Column:
    """Of a site over host and path, of a pattern over the whole URL in lower case."""
    host = ascii_lower(F.regexp_extract(text, "^[^/]*", 0))
    of_site = F.concat(F.lit(r"^([^/]*\.)?"), _quoted(host), _quoted(F.regexp_extract(text, r"(?s)^[^/]*(.*)", 1)))
    of_pattern = _quoted(ascii_lower(text))
    for old, new in ((r"^\\\|", "^"), (r"\\\|$", r"\\z"), (r"\\\*", r"[\\s\\S]*"), (r"\\\^", r"([^0-9a-z_.%-]|\\z)")):
        of_pattern = F.regexp_replace(of_pattern, old, new)
    return F.when(site, of_site).otherwise(of_pattern)


def compiled(rules: DataFrame) -> DataFrame:
    """``text, verdict, site`` with the regular expression, all bounded tokens, and the weight by which one rule beats another."""
    text, site = F.col("text"), F.col("site")
    shown = F.when(site, F.concat(F.lit("."), text, F.lit("*"))).otherwise(F.concat(F.lit("*"), text, F.lit("*")))
    return rules.select(
        "text", "verdict", "site", _regex(text, site).alias("regex"),
        F.array_distinct(F.regexp_extract_all(ascii_lower(shown), F.lit(BOUNDED), F.lit(0))).alias("tokens"),
        # Sites before patterns; the longest site; of patterns an exception before a block, then the longest; at last a block.
        F.struct(site.alias("site"), (~site & (F.col("verdict") == "allow")).alias("exception"),
                 F.length("text").alias("length"), F.length(F.regexp_extract(text, "^[^/]*", 0)).alias("host"),
                 (F.col("verdict") == "block").alias("block"), "text", "verdict").alias("weight"))


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(F.coalesce(url, F.lit(""))), F.lit(TOKEN), F.lit(0)))


def indexed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule under the one of its tokens that fewest rows of ``urls`` (column ``url``) have; under "" without tokens."""
    every = compiled(rules).select("regex", "site", "weight", F.explode_outer("tokens").alias("token"))
    wanted = every.select("token").where("token IS NOT NULL").distinct()
    seen = urls.select(F.explode(_tokens(F.col("url"))).alias("token")).join(wanted, "token").groupBy("token").agg(
        F.count("*").alias("n"))
    counted = every.join(seen, "token", "left").select(
        "regex", "site", "weight", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")).alias("t"))
    return counted.groupBy("regex", "site", "weight").agg(F.min("t").alias("t")).select(
        "regex", "site", "weight", F.col("t.token").alias("token"))


def judge_urls(df: DataFrame, keep: Sequence[str], rules: Sequence[Rule] | DataFrame, url: str = "url", into: str = "judged",
               otherwise: str = "allow") -> DataFrame:
    """The columns ``keep`` of each row, and ``into`` as struct of host, path, rule, pattern and verdict.

    ``rule`` is the text of the longest site that fits (of equally long ones the
    one with the longer host, then a block).  Where none fits, the longest
    pattern that allows decides, else the longest that blocks; it is in
    ``pattern``.  Else the verdict is ``otherwise``.  ``rules`` may be a table
    with the columns of ``Rule``.

    A null URL and one without ``://`` have an empty host and path and no site;
    patterns still look at the latter.  Very long URLs are read whole.  Each
    input row gives one row, repeated rows and rows without any id as well; an
    empty table gives none, no rules the verdict ``otherwise``.  Columns outside
    ``keep`` are not read; one of ``keep`` that is named ``into`` is replaced.
    """
    spark = df.sparkSession
    keep = [c for c in keep if c.lower() != into.lower()]
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.text, r.verdict, r.site) for r in rules], "text string, verdict string, site boolean")
    rules = rules.select("text", "verdict", "site").where("text IS NOT NULL").distinct()
    # Equal rows of one part of the input are one row with a count, so a hot row costs one row a part.
    given = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row") if keep else F.lit(0).alias("row"),
                      F.col(f"`{url}`").cast("string").alias("url"), F.spark_partition_id().alias("part"))
    rows = given.groupBy("row", "url", "part").agg(F.count("*").alias("n"))
    index = indexed(rules, given).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    asked = rows.select("row", "url", "part", "n", F.explode(F.concat(_tokens(F.col("url")), F.array(F.lit("")))).alias("token")).withColumn(
        "salt", F.pmod(F.xxhash64("row", "url", "part"), F.lit(SALT)).cast("int"))
    host, path = host_of_url(F.col("url")), path_of_url(F.col("url"))
    target = F.when(F.col("site"), F.concat(host, path)).otherwise(ascii_lower(F.coalesce("url", F.lit(""))))
    fits = F.when(F.rlike(target, F.col("regex")), F.col("weight"))
    best = asked.join(index, ["token", "salt"], "left").groupBy("row", "url", "part", "n").agg(F.max(fits).alias("best"))
    site = F.col("best.site")
    judged = F.struct(host.alias("host"), path.alias("path"), F.when(site, F.col("best.text")).alias("rule"),
                      F.when(~site, F.col("best.text")).alias("pattern"),
                      F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict")).alias(into)
    every = best.select("row", judged, F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("copy"))
    return every.select(*([f"row.`{c}`" for c in keep]), into)
