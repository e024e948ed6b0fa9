"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate of a host if more than `RATIO` of the host's pages contain it, and `MIN_PAGES` do, two, as a line of a single page doesn't repeat. Pages are
counted by host and MD5 of the trimmed line, with partial sums before the shuffle. A host has at most as
many boilerplate lines as a page of it has lines on average, divided by RATIO, so the list is short; if it is under `BROADCAST_BYTES`,
it goes to all executors and the texts are never shuffled, else lines and texts are joined by page.

Nulls and edge cases: a null text stays null and an empty one empty; blank lines are neither counted nor dropped; a page counts
once for a line that it repeats; a null host is a host of its own; a page of nothing but boilerplate becomes empty, unless the caller asks with `keep_whole` that
pages that would lose all their lines keep them (the pipeline does, as there they are copies, which a later stage sees to); repeated rows count as pages of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, numbered, restored, table

RATIO, MIN_PAGES = 0.1, 2
#: Largest list of boilerplate lines, at 150 bytes each, that goes to all executors.
BROADCAST_BYTES, LINE_BYTES = 16_000_000, 150

#: What ends or opens a block of text in HTML, and what is no text.
_NO_TEXT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
_BLOCK = r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|article|section|nav|header|footer|main|aside|title|head|body|html)\b[^>]*>"
_TAG = r"<[^>]*>"


def _key(line: Column) -> Column:
    return F.md5(F.trim(line).cast("binary"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host_key, line_key) of the lines to drop, from (host_key, lines)."""
    totals = pages.groupBy("host_key").agg(F.count(F.lit(1)).alias("pages"))
    keys = F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), _key))
    counts = pages.select("host_key", F.explode(keys).alias("line_key")).groupBy("host_key", "line_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    return counts.join(totals, "host_key").where(F.col("n") > F.col("pages") * ratio).select("host_key", "line_key")


def drop_boilerplate(pages: DataFrame, host: Column, lines: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES, broadcast_bytes: int = BROADCAST_BYTES, keep_whole: bool = False) -> DataFrame:
    """`pages` with `__lines` (all lines) and `__kept` (without the boilerplate of the host)."""
    pages = pages.withColumn("host_key", F.concat(F.when(host.isNull(), "-").otherwise("+"), F.coalesce(host, F.lit("")))).withColumn("lines", lines)
    found = materialize(boilerplate(pages.select("host_key", "lines"), ratio, min_pages), "boilerplate")
    drop = found.groupBy("host_key").agg(F.collect_set("line_key").alias("drop"))
    if found.count() * LINE_BYTES <= broadcast_bytes:
        out = pages.join(F.broadcast(drop), "host_key", "left")
    else:
        # by line, then by page: no task has more than a page's dropped lines, or one line's pages in splittable joins
        pages = materialize(pages.withColumn("row", F.concat_ws("-", F.expr("uuid()"), F.lit("0"))), "pages")
        keys = F.explode(F.array_distinct(F.transform("lines", _key))).alias("line_key")
        hit = pages.select("row", "host_key", keys).join(found, ["host_key", "line_key"], "left_semi")
        out = pages.join(materialize(hit.groupBy("row").agg(F.collect_set("line_key").alias("drop")), "dropped"), "row", "left").drop("row")
    none = F.array().cast("array<string>")
    kept = F.filter("lines", lambda x: (F.trim(x) == "") | ~F.array_contains(F.coalesce(F.col("drop"), none), _key(x)))
    out = out.withColumn("kept", F.when(F.col("drop").isNull(), F.col("lines")).otherwise(kept))
    whole = F.lit(not keep_whole) | F.col("lines").isNull() | F.exists("kept", lambda x: F.trim(x) != "")
    return out.withColumn("__lines", F.col("lines")).withColumn("__kept", F.when(whole, F.col("kept")).otherwise(F.col("lines"))).drop("lines", "kept", "drop", "host_key")


def drop_lines(documents: DataFrame, keep_whole: bool = False) -> DataFrame:
    """The documents, same columns, without the boilerplate lines of their source."""
    docs = numbered(documents, "source", "text")
    out = drop_boilerplate(docs, F.col("source"), F.split("text", "\n", -1), keep_whole=keep_whole)
    out = out.withColumn("text", F.when(F.col("text").isNotNull(), F.array_join("__kept", "\n")))
    return restored(out, docs, documents)


def html_lines(html: Column) -> Column:
    """The lines of text of a page: blocks end lines, other tags go, blank lines too."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _NO_TEXT, "\n"), _BLOCK, "\n"), _TAG, "")
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def host_of(url: Column) -> Column:
    """The host of a URL, lower case: what comes after the scheme and `//` (or, without them, from the start) up to the first of `/?#`, without a user before the last `@`
    and without a port. An address in brackets keeps them; a null URL has no host, and one without authority the host ``""``.
    """
    return F.lower(F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#@]*?)(?::[0-9]*)?(?=[/?#]|$)", 1))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its host, lines, dropped lines and the text that is kept."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html", host_of(F.col("url")).alias("host"))
    out = drop_boilerplate(pages, F.col("host"), html_lines(F.col("html")))
    n = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("bigint")
    return out.select("page_id", "host", n("__lines").alias("n_lines"), (n("__lines") - n("__kept")).alias("n_dropped"), F.array_join("__kept", "\n").alias("kept_text"))


OP7_SQL = r"""
WITH a AS (SELECT *, list_extract(string_split(string_split_regex(regexp_replace(url, '^([A-Za-z][A-Za-z0-9+.-]*:)?//', ''), '[/?#]')[1], '@'), -1) AS place FROM pages),
p AS (SELECT page_id, lower(CASE WHEN contains(place, ':') AND ltrim(list_extract(string_split(place, ':'), -1), '0123456789') = '' THEN left(place, length(place) - length(list_extract(string_split(place, ':'), -1)) - 1) ELSE place END) AS host,
  list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', chr(10), 'g'),
    '(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|article|section|nav|header|footer|main|aside|title|head|body|html)\b[^>]*>', chr(10), 'g'),
    '<[^>]*>', '', 'g'), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS ls FROM a),
n AS (SELECT host, count(*) AS pages FROM p GROUP BY 1),
b AS (SELECT q.host, line FROM (SELECT host, unnest(list_distinct(ls)) AS line FROM p) q JOIN n ON q.host IS NOT DISTINCT FROM n.host GROUP BY q.host, line, pages HAVING count(*) >= 2 AND count(*) > pages * 0.1::DOUBLE),
bl AS (SELECT host, list(line) AS gone FROM b GROUP BY 1),
k AS (SELECT page_id, p.host, ls, CASE WHEN gone IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(gone, x)) END AS kept FROM p LEFT JOIN bl ON p.host IS NOT DISTINCT FROM bl.host)
SELECT page_id, host, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(ls) - len(kept), 0) AS BIGINT) AS n_dropped,
  CASE WHEN ls IS NOT NULL THEN coalesce(array_to_string(kept, chr(10)), '') END AS kept_text FROM k
"""
