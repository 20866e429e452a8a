"""Temporal list join: every capture is judged by the list entries that were active when it was fetched.

Dated changes of the lists (``list, kind, entry, action, changed_on``) become validity intervals, half open. Entries are of
three kinds: ``domain`` (a host and its subdomains), ``prefix`` (host and leading path segments) and ``url`` (host and
path without the last slash). A capture looks up its own few keys: its host and parent domains, its path
prefixes, its url. The intervals of one entry come together in one row, so the join is on equality and
each capture meets each entry once; a hot host is split by adaptive execution.

An add and a remove of one entry on one day leave it inactive from then on. Changes with a null are ignored. A capture
without a url that has a host, or without a date, matches nothing and is allowed. Repeated captures are judged as often as they occur.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*://"


def host(url: Column) -> Column:
    """The host in lower case, without user and port; empty where there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), _SCHEME + "([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))


def segments(url: Column) -> Column:
    """The parts of the path that are not empty."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _SCHEME + "[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda part: part != "")


def address(url: Column) -> Column:
    """Host and path without empty parts, query and fragment; empty where there is no host."""
    return F.when(host(url) == "", F.lit("")).otherwise(F.array_join(F.concat(F.array(host(url)), segments(url)), "/"))


def _keys(url: Column) -> Column:
    labels, parts = F.split(host(url), "\\."), segments(url)
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, n, F.size(labels)), ".").alias("entry")),
    )
    prefixes = F.when(F.size(parts) > 0, F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.struct(F.lit("prefix").alias("kind"), F.array_join(F.concat(F.array(host(url)), F.slice(parts, 1, n)), "/").alias("entry")),
    )).otherwise(F.array().cast("array<struct<kind:string,entry:string>>"))
    whole = F.array(F.struct(F.lit("url").alias("kind"), address(url).alias("entry")))
    return F.when(host(url) == "", F.array().cast("array<struct<kind:string,entry:string>>")).otherwise(F.concat(domains, prefixes, whole))


def validity_intervals(changes: DataFrame) -> DataFrame:
    """``list, kind, entry, valid_from, valid_to``: from an add until the next change, or open (null)."""
    days = changes.dropna(subset=["list", "kind", "entry", "action", "changed_on"]).groupBy("list", "kind", "entry", "changed_on").agg(F.max("action").alias("action"))
    later = Window.partitionBy("list", "kind", "entry").orderBy("changed_on")
    return (
        days.withColumn("valid_to", F.lead("changed_on").over(later))
        .where("action = 'add'")
        .select("list", "kind", "entry", F.col("changed_on").alias("valid_from"), "valid_to")
    )


def judged(captures: DataFrame, intervals: DataFrame, id_col: str, url_col: str, date_col: str) -> DataFrame:
    """``id_col, url, fetched_on, n_entries, lists, allowed`` of every capture.

    ``n_entries`` counts the active entries that match, ``lists`` names their lists (sorted, joined by commas); a capture
    is allowed if it is on the ``allow`` list or on no ``block`` list.
    """
    rows = captures.select(
        captures[f"`{id_col}`"].alias("id"), captures[f"`{url_col}`"].alias("url"), captures[f"`{date_col}`"].cast("date").alias("fetched_on")
    )
    # equal captures are judged once
    distinct = rows.groupBy("id", "url", "fetched_on").agg(F.count("*").alias("times"))
    entries = intervals.groupBy("kind", "entry").agg(F.collect_list(F.struct("list", "valid_from", "valid_to")).alias("periods"))
    looked_up = distinct.withColumn("key", F.explode_outer(_keys(F.col("url")))).select("*", "key.kind", "key.entry").drop("key")
    active = F.filter(
        "periods",
        lambda one: (one["valid_from"] <= F.col("fetched_on")) & (one["valid_to"].isNull() | (F.col("fetched_on") < one["valid_to"])),
    )
    matched = looked_up.join(entries, ["kind", "entry"], "left").withColumn("active", F.coalesce(active, F.array().cast("array<struct<list:string,valid_from:date,valid_to:date>>")))
    judged = matched.groupBy("id", "url", "fetched_on", "times").agg(
        F.sum(F.size("active")).alias("n_entries"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col("active.list"))))).alias("lists"),
    )
    return judged.select(
        F.col("id").alias(id_col), "url", "fetched_on", "n_entries", F.array_join("lists", ",").alias("lists"),
        (F.array_contains("lists", "allow") | ~F.array_contains("lists", "block")).alias("allowed"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"),
    ).drop("time")
