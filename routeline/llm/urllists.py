"""URL filters over dated lists: an as-of join of captures with the entries active at fetch time.

List entries are dated: from a day on, an entry of a list (block or allow) is added or removed. The
changes of one entry, in order of day, become validity intervals [from, to), the last one open.

A capture is looked up under every domain suffix of its host. Lookup is an equi-join on (domain,
period), a period being a span of ``PERIOD_DAYS`` days: an interval is entered once for each period
it touches, up to the last period of any capture, and a capture belongs to one. The condition on
the day decides inside. The verdict depends on host and day alone, so each (host, day) is looked up
once: a host that holds a third of all captures asks at most once a day. The answers return to the
captures by an equi-join on (host, day), whose captures adaptive execution splits where one day
of one host holds many.

The most specific active entry decides; on the same domain allow wins over block.

Defined cases: NULL or hostless URL, or NULL fetch day: never listed, verdict ``unlisted``. Entries
with a NULL domain or day are ignored. Several changes of one entry on one day: the last by action
name counts (``remove`` after ``add``). A removal without an addition has no effect; repeated
additions keep the interval open. Empty list: everything is unlisted. Every capture has a row of its
own, also with a repeated or NULL key. Other columns of the captures are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD_DAYS = 64


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user, port and final dot; NULL without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def suffixes(host: Column) -> Column:
    """Every domain suffix with at least two labels (or the host itself): array of (domain, labels)."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    lengths = F.sequence(F.least(F.lit(2), n), n)
    return F.transform(lengths, lambda k: F.struct(
        F.array_join(F.slice(labels, n - k + 1, k), ".").alias("domain"), k.alias("labels")))


def validity(entries: DataFrame) -> DataFrame:
    """(list, domain, valid_from, valid_to) from dated changes (list, domain, day, action)."""
    days = (entries.filter("domain is not null and day is not null")
            .groupBy("list", "domain", "day").agg(F.max("action").alias("action")))
    order = Window.partitionBy("list", "domain").orderBy("day")
    changed = (days.withColumn("before", F.lag("action", 1, "remove").over(order))
               .filter("action <> before").drop("before"))
    return (changed.withColumn("valid_to", F.lead("day").over(order)).filter("action = 'add'")
            .select("list", "domain", F.col("day").alias("valid_from"), "valid_to"))


def evaluate(captures: DataFrame, entries: DataFrame, key: str, url: str = "url", day: str = "day") -> DataFrame:
    """One row per capture: key, host, day, n_active, matched, verdict."""
    period = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / PERIOD_DAYS).cast("int")
    intervals = validity(entries)
    horizon = F.lit(captures.agg(F.max(F.col(day))).first()[0]).cast("date")
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), horizon), horizon)
    entered = (intervals.filter(F.col("valid_from") <= horizon)
               .withColumn("period", F.explode(F.sequence(period(F.col("valid_from")), period(end)))))
    asked = captures.select(
        F.col(key).alias("key"), host_of(F.col(url)).alias("host"), F.col(day).alias("day"))
    # the answer depends on host and day alone, so each such pair is looked up once, whatever its captures
    looked = asked.filter("host is not null and day is not null").select("host", "day").distinct().select(
        "host", "day", period(F.col("day")).alias("period"), F.explode(suffixes(F.col("host"))).alias("s")).select(
        "host", "day", "period", "s.*")
    hits = looked.join(entered, ["domain", "period"]).filter(
        (F.col("day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    best = F.max(F.struct("labels", (F.col("list") == "allow").alias("allow"), "domain"))
    answer = hits.groupBy("host", "day").agg(
        F.size(F.collect_set(F.struct("list", "domain"))).alias("n_active"), best.alias("best"))
    # captures without a host or day find no answer; by their spread they don't meet in one task
    lost = F.col("host").isNull() | F.col("day").isNull()
    asked = asked.withColumn("spread", F.when(lost, F.pmod(F.xxhash64("key", "host", "day"), F.lit(4096))).otherwise(F.lit(0)))
    answer = answer.withColumn("spread", F.lit(0).cast("bigint"))
    return asked.join(answer, ["host", "day", "spread"], "left").select(
        "key", "host", "day", F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("best.domain").alias("matched"),
        F.when(F.col("best").isNull(), "unlisted").when(F.col("best.allow"), "allowed").otherwise("blocked").alias("verdict"))
