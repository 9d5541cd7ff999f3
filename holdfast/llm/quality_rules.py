"""Quality rules: a table of thresholds, compiled into one projection.

Everything runs inside Spark's own expressions: no user functions, no shuffle,
one pass over the texts.  A row costs memory in proportion to its own text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.text import text_of, words

#: The characters that count as symbols, and the two rules every text has to meet.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_WORDS, REPEAT_PERCENT = 20, 8, 30

#: Frequent words of running English, French, German and Spanish; they count in lower case or with a capital.
STOP_WORDS = (
    "a", "and", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "of", "on", "or", "that", "the", "this",
    "to", "was", "with", "au", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les",
    "ou", "par", "pas", "pour", "que", "qui", "se", "sur", "un", "une", "auf", "das", "dem", "den", "der", "die",
    "ein", "eine", "ist", "mit", "nicht", "sie", "und", "von", "zu", "con", "del", "el", "las", "los", "no", "por",
    "su", "y")


@dataclass(frozen=True)
class Rule:
    """Rejects texts whose ``measure`` is below ``low`` or above ``high``.

    The rule holds only for texts of at least ``min_words`` words.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = MIN_WORDS

    def broken(self) -> Column:
        value = F.col(self.measure)
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (value < F.lit(self.low))
        if self.high is not None:
            outside = outside | (value > F.lit(self.high))
        return F.coalesce((F.col("n_words") >= self.min_words) & outside, F.lit(False))


#: The default table.  Running text of any of the four languages stays well inside.
RULES = (
    Rule("word_length", "mean_word_chars", 1.5, 20.0),
    Rule("symbols", "symbol_ratio", high=1.0),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5),
    Rule("alphabetic", "alpha_ratio", low=0.3),
    Rule("stop_words", "stop_word_ratio", low=0.02, min_words=50),
)


def _repeated(windows: Column, size: int) -> Column:
    """Words that lie in a window which occurs at least twice, from the windows' hashes sorted with their places."""
    hit = F.filter(windows, lambda w, k: F.coalesce(
        (F.get(windows, k - 1)["h"] == w["h"]) | (F.get(windows, k + 1)["h"] == w["h"]),
        F.get(windows, k - 1)["h"] == w["h"], F.get(windows, k + 1)["h"] == w["h"], F.lit(False)))
    starts = F.array_sort(F.transform(hit, lambda w: w["i"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(starts, start, lambda s, i: F.struct(
        (i + size).alias("end"), (s["n"] + i + size - F.greatest(s["end"], i)).alias("n")), lambda s: s["n"])


def _doubled(name: str, step: int) -> Column:
    """Hashes of windows twice as long, from those of ``step`` words."""
    return F.zip_with(name, F.slice(name, F.lit(step + 1), F.size(name)), lambda a, b: F.xxhash64(a, b))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``df`` with the measures the rules compare, plus its columns under ``_row``."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    out = df.select(row, text_of(text).alias("_text")).withColumn("_words", words(F.col("_text")))
    # The hash of a window is built from the hashes of its halves, so each word is read once whatever the window.
    out = out.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    out = out.withColumn("_h2", _doubled("_h1", 1)).withColumn("_h4", _doubled("_h2", 2))
    # A window can only repeat where its half does.
    half = F.size(F.array_distinct("_h4")) < F.size("_h4")
    whole = F.greatest(F.size("_words") - (REPEAT_WORDS - 1), F.lit(0))
    out = out.withColumn("_h", F.when(half, F.slice(_doubled("_h4", 4), F.lit(1), whole)))
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    out = out.withColumn("_windows", F.when(again, F.array_sort(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    stop = F.filter("_words", lambda w: w.isin([*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]))
    chars = F.length(F.array_join("_words", "")).cast("long")
    out = out.select(
        "_row", F.size("_words").cast("long").alias("n_words"), chars.alias("word_chars"),
        F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_repeated(F.col("_windows"), REPEAT_WORDS), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"), F.size(stop).cast("long").alias("n_stop_words"),
        F.regexp_count("_text", F.lit(r"[^\p{L}\x20\x09-\x0D]")).cast("long").alias("n_other"))
    out = out.withColumn("n_letters", F.col("word_chars") - F.col("n_other")).drop("n_other")
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b))
    return out.select("*", ratio("word_chars", "n_words").alias("mean_word_chars"),
                      ratio("n_symbols", "n_words").alias("symbol_ratio"),
                      ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
                      ratio("n_letters", "word_chars").alias("alpha_ratio"),
                      ratio("n_stop_words", "n_words").alias("stop_word_ratio"))


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures of each row, ``base_failed``, the names of the broken rules and ``kept``.

    A row comes back for each row, with its columns under ``_row``.  A null or
    empty text has no words and fails the base rules.  Repeated rows are judged
    alike, an empty table gives none, and no column name can clash.
    """
    few = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    judged = measure(df, text).select("*", (few | repeats).alias("base_failed"), broken.alias("broken_rules"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that pass, with their own columns."""
    # A filter on the verdict would be pushed below the measures and carry a copy of them all; one on a generated row stays.
    row = F.explode_outer(F.when(F.col("kept"), F.array("_row"))).alias("_row")
    return judge(df, text, rules).select(row).where("_row IS NOT NULL").select("_row.*")
