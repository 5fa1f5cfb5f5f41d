"""URL filters that change over time: list entries become validity intervals, captures are judged as of their fetch day.

Built-in DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares into which the hosts below one domain are dealt, so that no task has to look them all up.
SHARES = 16

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"


def url_host(url: Column) -> Column:
    """The host of an absolute URL in lower case, without user, port and a final dot; NULL where there is none."""
    host = F.lower(F.regexp_extract(url, _AUTHORITY + r"([^/:?#]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def url_key(url: Column) -> Column:
    """Host, path and query of an absolute URL, without scheme, fragment and final slashes; NULL where there is no host."""
    rest = F.regexp_replace(url, _AUTHORITY + r"[^/?#]*", "")
    return F.concat(url_host(url), F.regexp_replace(F.regexp_replace(rest, "#.*$", ""), "/+$", ""))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list_name, kind, pattern, valid_from, valid_to`` from dated entries ``list_name, kind, pattern, action, effective``.

    An ``add`` holds from its day (included) to the day of the next ``remove`` (excluded), NULL if there is none. An add
    while active, and a remove while not, change nothing; of both on one day the add wins; repeated entries count once. An
    entry without a pattern, a day or a known action says nothing and matches nothing. Entries are first brought down to
    one per pattern and day, so a pattern's history has at most as many rows as there are days.
    """
    adds = F.max(F.col("action") == "add").alias("active")
    known = F.col("pattern").isNotNull() & F.col("effective").isNotNull() & F.col("action").isin("add", "remove")
    days = entries.where(known).groupBy("list_name", "kind", "pattern", "effective").agg(adds)
    history = Window.partitionBy("list_name", "kind", "pattern").orderBy("effective")
    turns = days.withColumn("before", F.lag("active").over(history)).where(~F.col("active").eqNullSafe(F.col("before")))
    turns = turns.withColumn("valid_to", F.lead("effective").over(history)).where("active")
    return turns.select("list_name", "kind", "pattern", F.col("effective").alias("valid_from"), "valid_to")


def judge_captures(captures: DataFrame, entries: DataFrame, capture_id: str = "page_id", url: str = "url", day: str = "fetch_date") -> DataFrame:
    """Every capture with the entries active on its fetch day: ``page_id, url, fetch_date, matches, blocked``.

    Kinds of patterns: ``url`` (see ``url_key``), ``host`` (the very host) and ``domain`` (the host or any parent of it).
    ``matches`` is a sorted, comma-joined list of ``list_name:kind:pattern``. Every capture gives one row; one without a
    URL, a host or a day matches nothing.

    Captures are first brought down to distinct hosts and addresses per day, and what these ask for to distinct (kind,
    pattern, day): a domain that a third of all hosts are below is asked for once a day. This meets the intervals by pattern
    and month; an interval is spread over the months of the captures it touches, so both sides of a key are bounded by the
    days of a month. What was found, a row per pattern and day, goes back to the hosts below a domain in ``SHARES`` copies.
    """
    rows = captures.select(captures[capture_id].alias("page_id"), captures[url].alias("url"), captures[day].cast("date").alias("fetch_date"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "url_key": url_key(F.col("url"))})
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = rows.where(F.col("host").isNotNull() & F.col("fetch_date").isNotNull()).select("host", "fetch_date").distinct()
    urls = rows.where(F.col("url_key").isNotNull() & F.col("fetch_date").isNotNull()).select("url_key", "fetch_date").distinct()
    asked = F.concat(
        F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern"))),
        F.transform(parents, lambda p: F.struct(F.lit("domain").alias("kind"), p.alias("pattern"))),
    )
    host_keys = hosts.select("host", "fetch_date", F.explode(asked).alias("k")).select("host", "fetch_date", "k.kind", "k.pattern")
    url_keys = urls.select(F.lit("url").alias("kind"), F.col("url_key").alias("pattern"), "fetch_date")

    span = rows.agg(F.min("fetch_date"), F.max("fetch_date")).first()
    first, last = (F.lit(d).cast("date") for d in span)
    begins = F.greatest(F.col("valid_from"), first)
    ends = F.least(F.coalesce(F.date_sub("valid_to", 1), last), last)
    spread = validity_intervals(entries).where(begins <= ends)
    months = F.sequence(F.trunc(begins, "MM"), F.trunc(ends, "MM"), F.expr("interval 1 month"))
    spread = spread.withColumn("month", F.explode(months))

    pairs = host_keys.select("kind", "pattern", "fetch_date").distinct().unionByName(url_keys)
    met = pairs.withColumn("month", F.trunc("fetch_date", "MM")).join(spread, ["kind", "pattern", "month"])
    active = (F.col("valid_from") <= F.col("fetch_date")) & (F.col("valid_to").isNull() | (F.col("fetch_date") < F.col("valid_to")))
    named = F.collect_set(F.concat_ws(":", "list_name", "kind", "pattern")).alias("names")
    found = met.where(active).groupBy("kind", "pattern", "fetch_date").agg(named)

    itself = F.lit(SHARES)  # a host asks for its own name as one of a kind, for its parents with all hosts of its share
    shares = F.when(F.col("kind") == "domain", F.sequence(F.lit(0), itself)).otherwise(F.array(itself))
    share = F.when(F.col("pattern") == F.col("host"), itself).otherwise(F.pmod(F.xxhash64("host"), F.lit(SHARES)).cast("int"))
    of_hosts = found.where(F.col("kind") != "url").withColumn("share", F.explode(shares))
    by_host = host_keys.withColumn("share", share).join(of_hosts, ["kind", "pattern", "fetch_date", "share"])
    by_host = by_host.groupBy("host", "fetch_date").agg(F.flatten(F.collect_list("names")).alias("by_host"))
    by_url = found.where(F.col("kind") == "url").select(F.col("pattern").alias("url_key"), "fetch_date", F.col("names").alias("by_url_key"))

    out = rows.join(by_host, ["host", "fetch_date"], "left").join(by_url, ["url_key", "fetch_date"], "left")
    none = F.array().cast("array<string>")
    matches = F.array_sort(F.concat(F.coalesce("by_host", none), F.coalesce("by_url_key", none)))
    return out.select("page_id", "url", "fetch_date", F.array_join(matches, ",").alias("matches"), (F.size(matches) > 0).alias("blocked"))
