"""Line dedup by site-relative frequency.

A line is boilerplate on its host when the pages of the host that contain it
are more than a given share of all its pages.  Lines are counted as hashes after
a map-side combine, so a common line is one partial count a task.  A host has
at most (lines per page / share) boilerplate lines, whatever its size; they
travel as one array a host, and the texts are not shuffled unless that table is
too large for the planner to broadcast.

Copies of a page are not boilerplate.  Where they are to be left to a later
stage, equal pages count as one, and a line that is found on pages with little
other text stays on one of them, so near copies never lose their text everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.text import free_name, text_of
from holdfast.session import stage

#: A line goes when it is on more than this share of its host's pages, and on so many pages at least.
SHARE, MIN_PAGES = 0.2, 5
#: A page with more than this share of its text in frequent lines is a near copy rather than a page with boilerplate.
COPY = 0.5

#: How parts of a page that are not text begin and end.
PARTS = (("script\\b", "</script>"), ("style\\b", "</style>"), ("!--", "-->"))
#: Those parts; what ends a line of text in HTML, one at a time: Java's expressions recurse once per repetition of a group.
HIDDEN = "(?is)" + "|".join(f"<{begin}.*?{end}" for begin, end in PARTS)
TAGS = "<(?!\ue000(?!\ue000))[^>]*>|\n"
#: A character that, once behind "<", tells that nothing ends there; where a page has it, it is doubled meanwhile.
MARK = "\ue000"


def text_lines(text: str = "text") -> Column:
    """The lines of a plain text."""
    return F.split(text_of(text), "\n")


def _named(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _marked_beyond(text: Column, begin: str, end: str) -> Column:
    """Marks each ``<`` with ``begin`` after it that the last ``end`` comes before, so no search for its end is in vain."""

    def mark(t: Column) -> Column:
        def tail(head: Column) -> Column:
            return F.concat(head, F.regexp_replace(F.substr(t, F.length(head) + 1), f"(?i)<(?={begin})", f"<{MARK}"))

        return _named(F.regexp_extract(t, f"(?is)^(.*{end})?", 1), tail)

    return _named(text, mark)


def _doubled(text: Column) -> Column:
    return F.replace(text, F.lit(f"<{MARK}"), F.lit(f"<{MARK}{MARK}"))


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit(f"<{MARK}"), F.lit("<"))


def html_lines(html: str = "html") -> Column:
    """The pieces of text between tags, trimmed, empty ones left out; in time that grows with the page alone.

    A script, style or comment without an end hides nothing, and a tag without one is text.
    """
    text = _doubled(text_of(html))
    for begin, end in PARTS:
        text = _marked_beyond(text, begin, end)
    text = _doubled(_plain(F.regexp_replace(text, HIDDEN, "")))
    # What is left of a tag after the last end of one is marked only where it is not doubled already.
    pieces = F.split(_marked_beyond(text, f"(?!{MARK})", ">"), TAGS)
    return F.array_remove(F.transform(pieces, lambda x: F.trim(_plain(x))), "")


def host_of(url: str = "url") -> Column:
    """Lower-case host of a URL, without user and port."""
    return F.lower(F.regexp_extract(text_of(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _text(lines: Column) -> Column:
    """Characters of the lines."""
    return F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(x))


def _kept_once(pages: DataFrame, found: DataFrame, total: DataFrame, marked: Column, share: float, min_pages: int) -> DataFrame:
    """Adds to frequent lines the page that keeps them, null where enough pages with other text have the line."""
    table = found.groupBy("host").agg(F.collect_list("line").alias("often"))
    rows = pages.withColumn("marked", marked).join(table, "host").withColumn(
        "hits", F.filter("marked", lambda x: F.array_contains(F.col("often"), _key(x))))
    copy = _text(F.col("hits")) > COPY * _text(F.col("marked"))
    hits = rows.withColumn("copy", copy).select("host", "page", "copy", F.explode(F.transform("hits", _key)).alias("line"))
    # One row a line and page first: a thousand copies of a page are one page.
    each = hits.distinct().groupBy("host", "line").agg(
        F.count_if(~F.col("copy")).alias("others"), F.min(F.when(F.col("copy"), F.col("page"))).alias("first"))
    spread = (F.col("others") >= min_pages) & (F.col("others") > share * F.col("pages"))
    return each.join(total, "host").select("host", "line", F.when(~spread, F.col("first")).alias("keeper"))


def drop_boilerplate(df: DataFrame, host: Column, lines: Column, into: str = "text", share: float = SHARE,
                     min_pages: int = MIN_PAGES, leave_copies: bool = False) -> DataFrame:
    """Puts the lines that stay, joined by line feeds, under ``into``; also ``n_lines`` and ``n_dropped_lines``.

    Each row is a page; repeated rows count as often as they occur.  A line
    counts once a page.  Rows with a null host form one host; a null text has
    one empty line; lines of white space always stay.  Every row comes back,
    with an empty text if all its lines go.  Columns of the frame that are named
    as the new ones are replaced, others pass through.

    With ``leave_copies`` all rows of a host with the same lines are one page.  A
    frequent line goes everywhere if enough pages have it beside more other text;
    else it is the text of near copies, and the first of them (by hash) keeps it.
    """
    names = {n: free_name(df, n) for n in ("host_key", "line_array", "bad_lines", "kept_lines", "page_key")}
    host_key, line_array, bad, once, page_key = names.values()
    pages = df.withColumns({host_key: F.coalesce(host, F.lit("")), line_array: lines})
    marked = F.array_distinct(F.filter(line_array, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    if leave_copies:
        pages = pages.withColumn(page_key, _key(F.col(line_array)))
    else:
        pages = pages.withColumn(page_key, F.lit(None).cast("struct<a:bigint,b:bigint>"))
    host_page = [F.col(host_key).alias("host"), F.col(page_key).alias("page")]
    on_pages = pages.select(*host_page, F.explode(F.transform(marked, _key)).alias("line"))
    if leave_copies:
        on_pages = on_pages.distinct()
    counts = on_pages.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    if leave_copies:
        contents = pages.select(*host_page).distinct()
    else:
        contents = df.select(F.coalesce(host, F.lit("")).alias("host"))
    totals = contents.groupBy("host").agg(F.count("*").alias("pages"))
    found = counts.join(totals, "host").where(F.col("n") > share * F.col("pages")).select("host", "line")
    if leave_copies:
        found = _kept_once(pages.select(*host_page, line_array), stage(found, "frequent"), totals, marked, share, min_pages)
    else:
        found = found.withColumn("keeper", F.lit(None).cast("struct<a:bigint,b:bigint>"))
    kept_line = F.when(F.col("keeper").isNotNull(), F.struct("line", "keeper"))
    table = stage(found.groupBy("host").agg(F.collect_list("line").alias("lines"), F.collect_list(kept_line).alias("once")),
                  "boilerplate")
    table = table.select(F.col("host").alias(host_key), F.col("lines").alias(bad), F.col("once").alias(once))
    joined = pages.join(table, host_key, "left")
    goes = lambda x: F.array_contains(F.col(bad), _key(x))
    if leave_copies:
        goes = lambda x: F.array_contains(F.col(bad), _key(x)) & ~F.array_contains(
            F.col(once), F.struct(_key(x).alias("line"), F.col(page_key).alias("keeper")))
    kept = F.when(F.col(bad).isNull(), F.col(line_array)).otherwise(F.filter(line_array, lambda x: ~goes(x)))
    out = joined.withColumn(bad, kept)
    return out.withColumns({
        into: F.array_join(bad, "\n"), "n_lines": F.size(line_array).cast("long"),
        "n_dropped_lines": (F.size(line_array) - F.size(bad)).cast("long")}).drop(*names.values())
