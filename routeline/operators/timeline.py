"""Exact ordered-series operators over ranges, whatever the keys' sizes.

A plain ``Window.partitionBy(key)`` sends a whole series to one task, so a vehicle with a third of
all rows, or all rows without a time, would stall the job. Here the rows are cut into ranges of
(key, time, tie-breaker), every key alike:

* The cuts are rows of the table: those with the smallest hashes form a random sample of
  ``slices * SAMPLES`` places, read as a scalar subquery over the key and order columns only. Every
  ``SAMPLES``-th is the last place of a range, so a range holds about 1 / slices of all rows, and a
  key is cut as often as its size asks for. Cuts are listed under the hash of their key: a row finds its
  range by binary search among those under its own, where there are any.
* Rows move once, by (key, range), and are sorted once. The last row of a range is a known place, so
  that row is also sent to the next range, where ``lag`` finds it; for ``lead`` the rows up to the
  first sampled place of a range go to the range before. These guests leave after the window.
* Running numbers and as-of values start in each range. What they start from is carried by a scan
  over one row per range of the keys that are cut, at most two a range.

No pass counts keys, and nothing depends on how large a key is. Rows that agree in key, time and
tie-breaker can't be told apart and stay together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_KEY = "␀"  # groups the rows whose key is NULL, as a window would
SAMPLES = 16         # sampled places a range
BUCKETS = 4096       # hashes of keys under which cuts are listed


@dataclass(frozen=True)
class Timeline:
    """How to group and order a series. ``order[0]`` is a timestamp, the rest break ties.

    ``slices`` is the number of ranges, the session's shuffle partitions by default.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...] = ("event_timestamp", "event_id")
    slices: int | None = None


Field = Callable[[str], Column]
Rule = Callable[[Field, Field], Column]


def _field(struct: str) -> Field:
    return lambda name: F.col(struct)[name]


class _Ranges:
    """The rows of a series with their range, guests of the neighbouring ranges included."""

    def __init__(self, df: DataFrame, line: Timeline, before: bool = False, after: bool = False):
        self.keys = [f"_k{i}" for i in range(len(line.keys))]
        self.where = [*self.keys, "_range"]
        slices = line.slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        keyed = df.withColumns({
            alias: F.coalesce(F.col(key).cast("string"), F.lit(NULL_KEY))
            for alias, key in zip(self.keys, line.keys)
        })
        place = F.struct(*self.keys, *line.order)
        picked = keyed.select(place.alias("place")).orderBy(F.xxhash64("place"), "place").limit(
            slices * SAMPLES)
        cuts, home, here = self._cuts(picked), F.col("_home"), F.col("_place")
        found_at = F.get(cuts, F.pmod(F.hash(*self.keys), F.lit(BUCKETS)))
        self.may_be_cut = found_at.isNotNull()
        ends = lambda i: F.get(F.col("_at")["ends"], i)

        def narrowed(at: Column, step: Column) -> Column:
            return F.when(ends(at + step - 1)["place"] < here, at + step).otherwise(at)

        def found(at: Column) -> Column:
            mine = lambda end: F.struct(*[end["place"][k] for k in self.keys]).eqNullSafe(F.struct(*self.keys))
            next_, prior = ends(at), ends(at - 1)
            return F.struct((F.col("_at")["base"] + at).alias("home"), (next_["place"] == here).alias("last"),
                            mine(prior).alias("follows"), F.coalesce(here <= prior["after"], F.lit(True)).alias("early"),
                            (mine(next_) | mine(prior)).alias("cut"))

        spot = F.col("_spot")
        host = lambda place, guest: F.array(F.struct(place.alias("_range"), F.lit(guest).alias("_guest")))
        hosts = [host(home, False)]
        if before:
            hosts.append(F.when(spot["last"], host(home + 1, True)))
        if after:
            hosts.append(F.when(spot["follows"] & spot["early"], host(home - 1, True)))
        none = F.array().cast("array<struct<_range:int,_guest:boolean>>")
        placed = (
            # NULL for nearly all keys that are not cut, so most rows carry no cuts and are not searched for
            keyed.withColumns({"_place": place, "_at": found_at})
            .withColumn("_spot", F.when(F.col("_at").isNotNull(), F.reduce(F.col("_at")["steps"], F.lit(0), narrowed, found)))
            .withColumns({"_home": F.coalesce(spot["home"], F.pmod(F.hash(*self.keys), F.lit(slices))),
                          "_cut": F.coalesce(spot["cut"], F.lit(False))})
        )
        if len(hosts) > 1:
            placed = placed.select("*", F.inline(F.concat(*[F.coalesce(h, none) for h in hosts])))
        else:
            placed = placed.withColumns({"_range": home, "_guest": F.lit(False)})
        self.rows = placed.drop("_at", "_spot", "_place", "_home")
        self.window = Window.partitionBy(*self.where).orderBy(*line.order)
        self.running = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.earlier = Window.partitionBy(*self.keys).orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1)
        self.position = F.struct(*line.order)

    def _cuts(self, picked: DataFrame) -> Column:
        """By the key's hash: the number of the first cut, the cuts, each with the sampled place after it, and the
        steps of a binary search among them."""
        sample = picked.agg(F.sort_array(F.collect_set("place")).alias("s"))
        marked = F.transform("s", lambda p, i: F.struct(
            i.alias("i"), p.alias("place"), F.get(F.col("s"), i + 1).alias("after")))
        ends = sample.select(F.inline(F.filter(marked, lambda e: e["i"] % SAMPLES == SAMPLES - 1)))
        bucket = F.pmod(F.hash(*[F.col("place")[k] for k in self.keys]), F.lit(BUCKETS))
        listed = ends.groupBy(bucket.alias("bucket")).agg(
            F.floor(F.min("i") / SAMPLES).cast("int").alias("base"),
            F.sort_array(F.collect_list(F.struct("place", "after"))).alias("ends"))
        steps = F.transform(F.sequence(F.length(F.bin(F.size("ends"))) - 1, F.lit(0)),
                            lambda b: F.pow(F.lit(2), b).cast("int"))
        table = listed.agg(F.map_from_entries(F.collect_list(F.struct(
            "bucket", F.struct("base", "ends", steps.alias("steps"))))).alias("m"))
        return table.select(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)),
                                        lambda b: F.try_element_at("m", b))).scalar()

    def carried(self, rows: DataFrame, within: Column, across: Column, name: str) -> DataFrame:
        """``across`` over the ranges before, of ``within`` per range; only of keys that are cut.

        The first condition needs the keys alone, so it reaches the scans and few rows are built again. The last is
        asked of the ranges: asked of the rows, it would be moved below the search and search again.
        """
        return (rows.filter(self.may_be_cut).filter("not _guest").groupBy(*self.where)
                .agg(within.alias("_of"), F.max("_cut").alias("_cut")).filter("_cut")
                .withColumn(name, across.over(self.earlier)).select(*self.where, name))

    def join(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        return rows.join(carried, self.where, "left")


def with_neighbours(df: DataFrame, line: Timeline, previous: dict[str, str] | None = None,
                    following: dict[str, str] | None = None,
                    sequence: str | None = None) -> DataFrame:
    """Add columns of the previous / following row of the same series and a 1-based position.

    ``previous`` and ``following`` map a new column name to the column it is taken from.
    """
    previous, following = previous or {}, following or {}
    s = _Ranges(df, line, before=bool(previous), after=bool(following))
    rows, added = s.rows, {}
    if previous:
        pack = F.struct(*sorted(set(previous.values())))
        rows = rows.withColumn("_prev", F.lag(pack).over(s.window))
        added.update({name: F.col("_prev")[source] for name, source in previous.items()})
    if following:
        pack = F.struct(*sorted(set(following.values())))
        rows = rows.withColumn("_next", F.lead(pack).over(s.window))
        added.update({name: F.col("_next")[source] for name, source in following.items()})
    if sequence:
        own = F.sum(F.when(F.col("_guest"), 0).otherwise(1)).over(s.running)
        rows = rows.withColumn("_pos", own)
        before = s.carried(s.rows, F.count(F.lit(1)), F.sum("_of"), "_before")
        rows = s.join(rows, before)
        added[sequence] = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_pos")
    out = rows.filter("not _guest").withColumns(added)
    return out.select(*[c for c in df.columns if c not in added], *added)


def with_islands(df: DataFrame, line: Timeline, starts: Rule, uses: tuple[str, ...],
                 island: str, previous: dict[str, str] | None = None,
                 flag: str | None = None) -> DataFrame:
    """Number the islands of each series (1, 2, ...); the first row always opens one.

    ``starts(prev, cur)`` says whether a row opens a new island, given accessors for the columns
    listed in ``uses`` on the previous and the current row. ``previous`` exposes previous-row
    columns (taken from ``uses``) and ``flag`` the start marker.
    """
    s = _Ranges(df, line, before=True)
    opened = F.when(F.col("_prev").isNull(), True).otherwise(starts(_field("_prev"), F.col))
    marked = s.rows.withColumn("_prev", F.lag(F.struct(*uses)).over(s.window)).withColumn(
        "_opens", F.coalesce(opened & ~F.col("_guest"), F.lit(False)))
    before = s.carried(marked, F.count_if("_opens"), F.sum("_of"), "_before")
    rows = s.join(marked.withColumn("_run", F.sum(F.col("_opens").cast("int")).over(s.running)), before)
    added = {name: F.col("_prev")[source] for name, source in (previous or {}).items()}
    added[island] = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_run")
    if flag:
        added[flag] = F.col("_opens")
    out = rows.filter("not _guest").withColumns(added)
    return out.select(*[c for c in df.columns if c not in added], *added)


def with_ranges(df: DataFrame, line: Timeline, range_: str, cut: str) -> DataFrame:
    """Move the rows of each (keys, ``range_``) to one task; ``cut`` tells the keys that have several ranges."""
    placed = _Ranges(df, line).rows.withColumns({range_: F.col("_range"), cut: F.col("_cut")})
    return placed.select(*[c for c in df.columns if c not in (range_, cut)], range_, cut).repartition(*line.keys, range_)


def with_last_seen(df: DataFrame, line: Timeline, value: Column, alias: str) -> DataFrame:
    """Add the latest non-NULL ``value`` at or before each row: the as-of lookup of a merged
    series of observations and requests, linear in its length."""
    s = _Ranges(df.withColumn("_seen", value), line)
    rows = s.rows.withColumn("_here", F.last("_seen", ignorenulls=True).over(s.running))
    last = F.max_by("_seen", F.when(F.col("_seen").isNotNull(), s.position))
    before = s.carried(s.rows, last, F.last("_of", ignorenulls=True), "_carry")
    out = s.join(rows, before).withColumn(alias, F.coalesce("_here", "_carry"))
    return out.select(*[c for c in df.columns if c != alias], alias)


def with_running_total(df: DataFrame, line: Timeline, value: Column, alias: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the series up to and including each row."""
    s = _Ranges(df.withColumn("_value", value), line)
    rows = s.rows.withColumn("_here", F.sum("_value").over(s.running))
    before = s.carried(s.rows, F.sum("_value"), F.sum("_of"), "_before")
    total = F.coalesce(F.col("_before"), F.lit(0)) + F.coalesce(F.col("_here"), F.lit(0))
    out = s.join(rows, before).withColumn(alias, total)
    return out.select(*[c for c in df.columns if c != alias], alias)


def with_rank(df: DataFrame, keys: tuple[str, ...], best: list[tuple[str, bool]], alias: str,
              slices: int | None = None) -> DataFrame:
    """Add the 1-based place of each row among those of its keys. ``best`` lists columns and whether larger
    is better; NULLs come last where it is, else first. Groups of any size are ranked range by range."""
    order = {}
    for i, (column, larger) in enumerate(best):
        if larger:
            order[f"_n{i}"] = F.col(column).isNull()
        order[f"_o{i}"] = -F.col(column) if larger else F.col(column)
    placed = with_neighbours(df.withColumns(order), Timeline(keys, tuple(order), slices), sequence=alias)
    return placed.withColumn(alias, F.col(alias).cast("int")).drop(*order)
