"""Line deduplication by site-relative frequency.

A line's frequency is the number of pages of its host that contain it, over the host's pages. Lines
above a ratio are boilerplate and go from every page of that host. A host of P pages with L lines each
has at most L / ratio such lines, so its list is short whatever P is. The pages meet those lists by
(host, salt): a host that holds a third of all pages is spread over many tasks.

Nulls and edges: a null or hostless url has the host ''; a null html has no lines. Every row is a page
of its own, repeated ids included. A line must be on at least ``LEAST_PAGES`` pages, so small hosts
keep theirs. 128-bit digests stand for lines. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO = 0.3
LEAST_PAGES = 3
SALTS = 32
#: Content that is not text, inline tags, and all other tags.
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
INLINE = r"(?i)</?(a|abbr|b|code|em|i|small|span|strong|sub|sup|u)\b[^>]*>"
TAG = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def lines_of(html: str) -> Column:
    """Text between block tags, with single spaces; empty lines are left out."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(html), HIDDEN, ""), INLINE, ""), TAG, "\n")
    made = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r\x0b\x0c]+", " ")))
    return F.coalesce(F.filter(made, lambda x: x != ""), F.array().cast("array<string>"))


def drop_boilerplate(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                     ratio: float = RATIO, least_pages: int = LEAST_PAGES, salts: int = SALTS) -> DataFrame:
    """Per page: key, host, ``n_lines``, ``n_dropped``, and ``kept`` (the lines that stay, joined by newlines)."""
    rows = pages.select(F.col(key).alias("key"), host_of(url).alias("host"), lines_of(html).alias("lines"))
    digest = lambda x: F.unhex(F.md5(x.cast("binary")))
    seen = rows.select("host", F.explode(F.array_distinct("lines")).alias("line")).select("host", digest(F.col("line")).alias("d"))
    often = seen.groupBy("host", "d").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    totals = pages.select(host_of(url).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    bad = often.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("total")).groupBy("host").agg(F.collect_set("d").alias("bad"))
    bad = bad.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key", F.array_join("lines", "\n")), F.lit(salts)).cast("int"))
    joined = salted.join(bad, ["host", "salt"], "left")
    kept = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("bad"), digest(x))))
    return joined.withColumn("stay", kept).select(
        F.col("key").alias(key), "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"), F.array_join("stay", "\n").alias("kept"))
