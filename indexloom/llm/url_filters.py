"""URL lists as of the time of each capture, with DataFrame functions only.

A list is a log of dated entries: from its day on, a pattern is on the list or off it. Entries of one list, pattern and
day combine first (on wins), so a pattern has at most as many rows as there are days; each runs until its pattern's
next one, which makes validity intervals. A pattern is a domain, which covers its subdomains, or a host with leading
path segments (whose case counts; the last "/" may be left out). A capture has few keys, the patterns that could cover it; keys meet intervals by pattern and month, so
that a busy pattern's history isn't compared with all captures of its host, and an interval counts if it holds the
capture's day. The most specific active pattern decides; of equal ones, blocking does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.sources.store import written

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """The lower-cased host; empty if there is none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def keys(url: Column) -> Column:
    """All patterns that cover a URL: its host's suffixes by label, and the host with leading path segments."""
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    segments = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda x: x != "")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    domains = F.transform(upto(F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(upto(F.size(segments)), lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(segments, 1, i), "/"), F.lit("/")))
    return F.when(F.size(labels) > 0, F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def normal(pattern: Column) -> Column:
    """A pattern as ``keys`` writes it: the host in lower case, path segments as they are with one "/" after each."""
    path = F.regexp_replace(F.concat(F.substr(pattern, F.instr(pattern, F.lit("/"))), F.lit("/")), "/+", "/")
    return F.concat(F.lower(F.substring_index(pattern, "/", 1)), F.when(F.contains(pattern, F.lit("/")), path).otherwise(""))


def intervals(entries: DataFrame) -> DataFrame:
    """(blocks, pattern, since, until): days on which an entry is active, ``until`` excluded and null if open.

    ``entries`` has ``blocks`` (of a blocking list, else of an allowing one), ``pattern``, ``active`` and ``since``.
    Entries without pattern or day are void; a null ``active`` is off, a null ``blocks`` blocks.
    """
    dated = entries.filter("pattern is not null and since is not null")
    daily = dated.groupBy(F.coalesce("blocks", F.lit(True)).alias("blocks"), normal(F.col("pattern")).alias("pattern"), F.to_date("since").alias("since")).agg(F.max(F.coalesce("active", F.lit(False))).alias("active"))
    following = Window.partitionBy("blocks", "pattern").orderBy("since")
    return daily.withColumn("until", F.lead("since").over(following)).filter("active").drop("active")


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``row`` (all columns of ``captures``), ``blocked``, ``pattern`` (that decided) and ``n_active`` (that matched).

    A null or unreadable URL or a null time matches nothing and isn't blocked. Repeated captures are judged each.
    Empty lists block nothing; empty captures give no rows. Extra columns stay inside ``row``.
    """
    rows = captures.select(F.struct(*(F.col(f"`{c}`") for c in captures.columns)).alias("row"), F.col(f"`{url}`").alias("url"), F.to_date(F.col(f"`{fetched}`")).alias("day"))
    distinct = rows.select("url", "day").filter("url is not null and day is not null").distinct()
    asked = distinct.select("url", "day", F.explode(keys(F.col("url"))).alias("pattern"), _month(F.col("day")).alias("month"))
    span = distinct.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    if span.low is None:
        verdicts = distinct.select("url", "day", F.lit(False).alias("blocked"), F.lit(None).cast("string").alias("pattern"), F.lit(0).cast("long").alias("n_active"))
    else:
        low, high = F.lit(span.low), F.lit(span.high)
        valid = intervals(entries).filter((F.col("since") <= high) & (F.col("until").isNull() | (F.col("until") > low)))
        first, last = F.greatest("since", low), F.coalesce(F.least(F.date_sub("until", 1), high), high)
        monthly = written(valid.withColumn("month", F.explode(F.sequence(_month(first), _month(last)))), "intervals")
        within = (F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))
        met = asked.join(monthly, ["pattern", "month"]).filter(within)
        best = F.max(F.struct(F.length("pattern").alias("size"), "blocks", "pattern")).alias("best")
        verdicts = met.groupBy("url", "day").agg(best, F.count("*").alias("n_active")).select("url", "day", F.col("best.blocks").alias("blocked"), F.col("best.pattern").alias("pattern"), "n_active")
    joined = rows.join(verdicts, ["url", "day"], "left")
    return joined.select("row", F.coalesce("blocked", F.lit(False)).alias("blocked"), "pattern", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"))
