"""URL filters: a temporal join of captures with dated list entries.

DataFrame functions only. A list is a log of dated entries (list, pattern, action, since). Each entry becomes a validity interval
that ends where the next entry of the same list and pattern begins; only intervals opened by ``add`` count. A capture looks up
its host, every parent domain, and each of them with the first path segment, and is held against the intervals that hold its fetch
time. Captures are evaluated once per distinct (host, segment, day), so a host with a third of all captures is as many rows as
it has days and segments.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.shared import columns


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user and port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.when(host != "", host)


def segment_of(url: Column) -> Column:
    """First path segment, empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)", 1), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """``(list, pattern, valid_from, valid_to)`` of the log ``entries(list, pattern, action, since)``; an open end is null.

    Patterns are compared in lower case. Of several entries of one list and pattern on one date the greatest action counts (``remove`` over ``add``); entries with a
    null anywhere are passed over.
    """
    lower = entries.dropna().withColumn("pattern", F.lower("pattern"))  # before the window: case doesn't keep entries apart
    dated = lower.groupBy("list", "pattern", "since").agg(F.max("action").alias("action"))
    following = F.lead("since").over(Window.partitionBy("list", "pattern").orderBy("since"))
    return (dated.withColumn("valid_to", following).filter(F.col("action") == "add")
            .select("list", "pattern", F.col("since").alias("valid_from"), "valid_to"))


def _keys() -> Column:
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(hosts, lambda h: F.concat(h, F.lit("/"), F.lower("segment")))
    return F.when(F.col("segment") != "", F.concat(hosts, paths)).otherwise(hosts)


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """One row per capture: ``page_id, host, fetched, blocked, n_entries, lists, pattern``.

    ``lists`` are the names of the lists with an active entry, in order; ``pattern`` is the longest active one (the first by name of equals).
    A capture without a host or a fetch time matches nothing. Repeated rows each get their result; further columns are ignored.
    """
    rows = columns(captures, page_id=id_col, url=url_col, fetched=time_col)
    rows = rows.select("page_id", "fetched", host_of(F.col("url")).alias("host"), segment_of(F.col("url")).alias("segment"))
    asked = rows.filter("host IS NOT NULL AND fetched IS NOT NULL").select("host", "segment", "fetched").distinct()
    active = asked.withColumn("pattern", F.explode(F.array_distinct(_keys()))).join(intervals(entries), "pattern").filter(
        (F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))))
    verdicts = active.groupBy("host", "segment", "fetched").agg(
        F.count(F.lit(1)).alias("n_entries"), F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"),
        F.min(F.struct((-F.length("pattern")).alias("by"), "pattern")).getField("pattern").alias("pattern"))
    out = rows.join(verdicts, ["host", "segment", "fetched"], "left")
    return out.select("page_id", "host", "fetched", F.col("n_entries").isNotNull().alias("blocked"),
                      F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), F.coalesce("lists", F.lit("")).alias("lists"), "pattern")
