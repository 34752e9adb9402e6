"""Line dedup by site-relative frequency (operator 3).

Pages are grouped by the host of their URL. For each host, the pages that hold
a line are divided by the host's pages; a line on more than ``ratio`` of them,
and on ``least`` pages or more, is boilerplate of that host and is dropped from
every page there. Only built-in functions.

Lines on a page are counted as rows (host, line hash) with a partial sum, so a
host with a third of all pages, or a line on all of them, is a row for each map
task. What is dropped on a host is a short list (each line of it is on at least
``least`` pages and a fixed share of them) and a row; pages meet it by a join on
the host, in which Spark broadcasts what is small and otherwise splits a large
host over as many tasks as its size asks for.

Nulls: a page without URL or host belongs to the host "". A null text has no
lines. Lines are compared without blanks at either end; blank lines are kept
and not counted. Repeated rows are pages each. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.llm.common import let, materialize

RATIO, LEAST = 0.1, 3
#: Tags that end a line, tags whose content isn't text, and the
#: entities that are put back as characters.
BLOCKS = r"(?i)<(?:/?(?:p|div|h[1-6]|li|ul|ol|article|nav|footer|header|section|table|tr|td|title|html|body|head)|br)\b[^>]*>"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<!doctype[^>]*>"
#: What opens hidden content (behind ``<``), and what closes it.
CLOSED = ((r"!--", "-->"), (r"script\b", "</script>"), (r"style\b", "</style>"))
#: From so many opening tags of that kind on, a page's unclosed ones are marked.
MANY = 32
#: Private characters that mark an opening tag as never closed.
MARK, KEPT = "\ue000", "\ue001"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def host(url: Column) -> Column:
    """The host of a URL in lower case, without port and user; "" if none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _marked(text: Column, opens: str, closes: str) -> Column:
    """``text`` with a mark in each opening tag that nothing closes."""
    def cut(t):
        def parts(head):
            rest = F.substring(t, F.length(head) + 1, F.length(t))
            return F.concat(head, F.regexp_replace(rest, f"(?i)<(?={opens})", f"<{MARK}"))

        return let(F.regexp_extract(t, f"(?is)^.*{closes}", 0), parts)

    return let(text, cut)


def _visible(html: Column) -> Column:
    """``html`` without HIDDEN, in time that grows with its length only: a tag
    that nothing closes is searched to the page's end each time, so where many
    tags open, those behind the last closing tag of their kind are marked
    first. The result is the same."""
    marked = F.replace(html, F.lit(MARK), F.lit(MARK + KEPT))
    for opens, closes in CLOSED:
        marked = _marked(marked, opens, closes)
    shown = F.regexp_replace(F.regexp_replace(marked, HIDDEN, ""), f"{MARK}(?!{KEPT})", "")
    many = F.regexp_count(html, F.lit(f"(?i)<(?:{'|'.join(opens for opens, _ in CLOSED)})")) > MANY
    return F.when(many, F.replace(shown, F.lit(MARK + KEPT), F.lit(MARK))).otherwise(F.regexp_replace(html, HIDDEN, ""))


def html_lines(html: Column) -> Column:
    """The text lines of a page: one for each block of the markup."""
    def shown(t):
        # Behind the last ">" no tag ends, so none is looked for.
        rest = F.substring_index(t, ">", -1)
        head = F.substring(t, F.lit(1), F.length(t) - F.length(rest))
        blocks = F.regexp_replace(F.regexp_replace(let(head, _visible), r"[\r\n]+", " "), BLOCKS, "\n")
        return F.concat(F.regexp_replace(blocks, "<[^>]*>", ""), F.regexp_replace(rest, r"[\r\n]+", " "))

    text = let(F.coalesce(html, F.lit("")), shown)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """Rows (host, line, pages, total): what is dropped on each host, from rows
    (host, lines)."""
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    each = pages.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    counted = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least)
    return counted.join(totals, "host").where(F.col("pages") > ratio * F.col("total"))


def drop(pages: DataFrame, ratio: float = RATIO, least: int = LEAST, url: str = "url", html: str = "html", page_id: str = "page_id") -> DataFrame:
    """Rows (page_id, host, n_lines, n_dropped, kept), one for each page;
    ``kept`` are the lines left, joined by newlines."""
    rows = materialize(pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), html_lines(F.col(html)).alias("lines")), "lines")
    gone = materialize(boilerplate(rows, ratio, least).groupBy("host").agg(F.collect_set("line").alias("gone")), "boilerplate")
    met = rows.join(gone, "host", "left")
    none = F.array().cast("array<string>")
    kept = F.filter("lines", lambda x: ~F.array_contains(F.coalesce("gone", none), x))
    out = met.withColumn("left", kept)
    return out.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("left")).cast("long").alias("n_dropped"), F.array_join("left", "\n").alias("kept"))
