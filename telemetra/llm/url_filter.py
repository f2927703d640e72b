"""URL filters: a temporal list join (native).

A list is a log of dated entries that add a rule or take it back.  Entries
become validity intervals, and an as-of join holds every capture against the
rules in force when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, active, at) -> (list, kind, value, valid_from, valid_to).

    An entry holds from its own date until the next one of the same rule;
    ``valid_to`` is NULL while the last entry stands.  Of entries of one rule
    with one date the removal wins.  Rows with a NULL field are no entries;
    repeated entries count once.
    """
    fields = ["list", "kind", "value", "at"]
    log = entries.dropna(subset=[*fields, "active"]).groupBy(*fields).agg(F.min("active").alias("active"))
    rule = Window.partitionBy("list", "kind", "value").orderBy("at")
    return log.withColumn("valid_to", F.lead("at").over(rule)).filter("active").select("list", "kind", "value", F.col("at").alias("valid_from"), "valid_to")


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a final dot; '' if the url has none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""), r"\.$", ""))


def keys_of(url: Column, host: Column) -> Column:
    """The rules that can meet a url: (kind, value) of the exact url, its host,
    every domain its host ends in, and host plus each leading path folder."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    parts = F.split(path, "/")  # '' first: the path begins with a slash
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(parts) - 1)), lambda k: F.concat(host, F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/")))
    key = lambda kind: lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    no_host = F.array(key("url")(url))
    return F.when(host == "", no_host).otherwise(F.array_distinct(F.concat(no_host, F.array(key("host")(host)), F.transform(domains, key("domain")), F.transform(folders, key("path")))))


def url_filter(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every row of ``captures`` (url, fetched_at, any other columns) with
    ``host``, ``blocked``, ``n_rules`` (rules that meet it when fetched) and
    ``lists`` (their lists: distinct, sorted, comma-joined, '' if none).
    Existing columns of these names are replaced.

    A rule is in force from its date on, up to but not including the date of
    the entry that ends it.  A capture with a NULL url or NULL time meets no
    rule.  Repeated captures are kept and judged one by one.

    Captures are numbered by their place, exploded into a few narrow key rows
    each and joined on the key, where adaptive execution splits a host that a
    third of all captures share; verdicts are pre-aggregated before they come
    back to their capture.  The rules of one key are few intervals and the
    lists a small part of the data, but none is broadcast unless measured small.
    """
    names = ("host", "blocked", "n_rules", "lists", "_capture")
    rows = captures.drop(*names).withColumns({"_capture": F.monotonically_increasing_id(), "host": F.coalesce(host_of(F.col("url")), F.lit(""))})
    asked = rows.filter(F.col("url").isNotNull() & F.col("fetched_at").isNotNull()).select("_capture", F.col("fetched_at").alias("_t"), F.explode(keys_of(F.col("url"), F.col("host"))).alias("_k"))
    asked = asked.select("_capture", "_t", F.col("_k.kind").alias("kind"), F.col("_k.value").alias("value"))
    active = (F.col("_t") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_t") < F.col("valid_to")))
    met = asked.join(intervals(entries), ["kind", "value"]).filter(active).groupBy("_capture").agg(F.count(F.lit(1)).alias("n_rules"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    out = rows.join(met, "_capture", "left").drop("_capture")
    return out.withColumns({"blocked": F.col("n_rules").isNotNull(), "n_rules": F.coalesce("n_rules", F.lit(0)).cast("long"), "lists": F.coalesce("lists", F.lit(""))})
