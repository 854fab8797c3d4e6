"""URL filters by a temporal list join.

A list is a log of dated events: a pattern (a host or a parent domain) is
added with a verdict, or removed. Each add is valid from its day until the
next event of the same list and pattern; intervals are half-open. Every
capture is evaluated against the entries that were active on the day it was
fetched: an as-of join on the capture's host and parent domains with the
interval as a further condition. The most specific active pattern decides;
among equal ones ``allow`` goes before ``block``, then the list that sorts
first.

Only DataFrame functions. Captures are first reduced to distinct (host, day),
so a host with a large part of all captures is a few hundred rows in the
search; the verdicts come back by an equi-join on (host, day). The intervals
are broadcast only when they are few.

Defined results: a null or unparsable url has no host and the verdict
``none``, as has a capture without a day, and a url whose host is longer than
any name can be (``LONGEST_HOST``); an address in numbers has no parent
domains; repeated rows are each judged; events with null in list, pattern, day
or event, and adds without a verdict, are ignored; of equal days a removal
comes after an add; an empty table on either side is no special case; further
columns of captures stay as they are, but those named like a new column are
replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, shared, small, unused

#: The host of an absolute url: after user info, before a port.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
#: Characters of the longest name a host can have (fixed value of the name system).
LONGEST_HOST = 253
#: An address in numbers, of either kind.
ADDRESS = r"^(?:[0-9.]+|\[.*)$"


def host_of(url: Column) -> Column:
    host = F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), F.lit("."))
    return F.when(F.length(host) <= LONGEST_HOST, host).otherwise("")


def domains_of(host: Column) -> Column:
    """The host and its parent domains of at least two labels; an address in
    numbers has none. A host of ``host_of`` has few enough labels for all."""
    return F.when(host.rlike(ADDRESS), F.array(host)).otherwise(_suffixes(host))


def _suffixes(host: Column) -> Column:
    return let(
        F.split(host, r"\."),
        lambda p: F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(p) - 1, F.lit(1))),
            lambda i: F.array_join(F.slice(p, i, F.size(p)), "."),
        ),
    )


def intervals(events: DataFrame) -> DataFrame:
    """(list, pattern, verdict, valid_from, valid_to) from (list, pattern,
    event, verdict, day); ``valid_to`` is null while the entry still holds."""
    dated = events.select("list", F.lower("pattern").alias("pattern"), "event", "verdict", "day").dropna(
        subset=["list", "pattern", "event", "day"]
    ).filter((F.col("event") != "add") | F.col("verdict").isNotNull())
    order = Window.partitionBy("list", "pattern").orderBy("day", "event", F.coalesce("verdict", F.lit("")))
    return (
        dated.withColumn("valid_to", F.lead("day").over(order))
        .filter((F.col("event") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("day"))))
        .select("list", "pattern", "verdict", F.col("day").alias("valid_from"), "valid_to")
    )


def evaluate(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``captures`` (url, day and what else there is) with host, verdict, rule,
    rule_list and rule_from."""
    active = shared(intervals(events), "intervals")
    hosted = captures.withColumn("host", host_of(F.col("url")))
    asked = hosted.filter((F.col("host") != "") & F.col("day").isNotNull()).select("host", "day").distinct()
    each = asked.select("host", "day", F.explode(domains_of(F.col("host"))).alias("pattern"))
    held = each.join(small(active), "pattern").filter(
        (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    )
    # the longest pattern, then allow before block, then the first list
    best = held.groupBy("host", "day").agg(
        F.min(
            F.struct(
                (-F.length("pattern")).alias("short"), "verdict", "list", "pattern", "valid_from"
            )
        ).alias("best")
    )
    of, on, chosen = (unused(f"_{c}", hosted) for c in ("of", "on", "best"))
    found = best.select(F.col("host").alias(of), F.col("day").alias(on), F.col("best").alias(chosen))
    at = F.col(chosen)
    new = {
        "verdict": F.coalesce(at["verdict"], F.lit("none")), "rule": at["pattern"], "rule_list": at["list"], "rule_from": at["valid_from"],
    }
    return hosted.join(found, (F.col("host") == F.col(of)) & (F.col("day") == F.col(on)), "left").select(
        *[f"`{c}`" for c in hosted.columns if c.lower() not in new], *[c.alias(n) for n, c in new.items()]
    )
