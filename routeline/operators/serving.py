"""Summary queries an operations team reads: figures, distributions, rankings, previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routeline.operators.timeline import Timeline, with_running_total
from routeline.functions.values import (
    count_when, require_non_negative_int, require_positive_int, rounded, safe_div,
)


def one_row(*frames: DataFrame) -> DataFrame:
    """Single-row frames side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def warehouse_kpis(trips: DataFrame, shipments: DataFrame, agent_days: DataFrame) -> DataFrame:
    def share(flag: str) -> Column:
        return F.coalesce(F.avg(flag) * 100.0, F.lit(0.0))

    return one_row(
        trips.agg(F.count(F.lit(1)).alias("trip_rows"),
                  F.coalesce(F.sum("total_distance_km"), F.lit(0.0)).alias("trip_distance_km")),
        shipments.agg(F.count(F.lit(1)).alias("shipment_rows"),
                      share("sla_met_flag").alias("sla_met_rate")),
        agent_days.agg(F.count(F.lit(1)).alias("agent_daily_rows"),
                       share("is_productive_flag").alias("productive_agent_rate")),
    )


def overview_counts(positions: DataFrame, scans: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Totals and distinct entities. Events are reduced to pairs of entities first, so that only those are
    counted distinctly, not every event once per entity column."""
    pairs = positions.groupBy("vehicle_id", "driver_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("speed_kmh").alias("speed"), F.count("speed_kmh").alias("speeds"))
    visits = scans.groupBy("shipment_id", "hub_id").agg(F.count(F.lit(1)).alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return one_row(
        pairs.agg(total("n").alias("gps_points"),
                  F.countDistinct("vehicle_id").alias("vehicles"),
                  F.countDistinct("driver_id").alias("drivers"),
                  safe_div(F.sum("speed"), F.sum("speeds")).alias("avg_speed_kmh")),
        visits.agg(total("n").alias("shipment_events"),
                   F.countDistinct("shipment_id").alias("shipments"),
                   F.countDistinct("hub_id").alias("hubs")),
        deliveries.agg(F.count(F.lit(1)).alias("delivery_events"),
                       F.countDistinct("agent_id").alias("agents"),
                       count_when(F.col("event_type") == "DELIVERED").alias("delivered"),
                       F.avg("customer_rating").alias("avg_rating")),
    )


def value_counts(df: DataFrame, column: str, order: str = "desc") -> DataFrame:
    """Rows per value, most frequent first (or last)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    by = F.desc("count") if order == "desc" else F.asc("count")
    return counts.orderBy(by, F.asc(column))


def vehicles_by_type(positions: DataFrame) -> DataFrame:
    return positions.groupBy("vehicle_type").agg(
        F.countDistinct("vehicle_id").alias("vehicles"))


def hub_activity(scans: DataFrame) -> DataFrame:
    return scans.groupBy("hub_name").agg(
        F.count("event_id").alias("event_count"),
        F.countDistinct("shipment_id").alias("unique_shipments")
    ).orderBy(F.desc("event_count"), "hub_name")


def zone_stats(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("zone_id").agg(
        F.count("event_id").alias("deliveries"),
        rounded(F.avg("customer_rating"), 2).alias("avg_rating")
    ).orderBy(F.desc("deliveries"), "zone_id")


def sla_compliance(journeys: DataFrame) -> DataFrame:
    """Share of met promises among decided ones, in percent; NULL when none is decided."""
    met = count_when(F.col("sla_status") == "MET")
    decided = count_when(F.col("sla_status").isin("MET", "BREACHED"))
    return journeys.agg(met.alias("met"), decided.alias("decided")).withColumn(
        "sla_compliance_pct", safe_div(F.col("met") * 100.0, F.col("decided")))


def trip_summary(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("total_trips"),
                     F.avg("total_distance_km").alias("avg_distance_km"),
                     F.avg("trip_duration_minutes").alias("avg_duration_minutes"),
                     F.avg("avg_speed_kmh").alias("avg_speed_kmh"))


def delivery_success_rate(deliveries: DataFrame) -> DataFrame:
    wins = count_when(F.col("event_type") == "DELIVERED")
    return deliveries.agg(F.count(F.lit(1)).alias("total"), wins.alias("delivered")).withColumn(
        "success_rate_pct", safe_div(F.col("delivered") * 100.0, F.col("total")))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins from the smallest to the largest value, empty bins
    included. Two passes over the input: the range, then the counts; only bins are shuffled."""
    require_positive_int(bins, "bins")
    known = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    span = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("r"))
    r = span.scalar()
    width = (r["hi"] - r["lo"]) / float(bins)
    place = F.when(width > 0, F.least(F.floor((F.col("v") - r["lo"]) / width),
                                      F.lit(bins - 1))).otherwise(0).cast("int")
    counts = known.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # at most ``bins`` entries
    filled = counts.agg(F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("m"))
    grid = filled.filter(F.size("m") > 0).select(
        "m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.select(
        "bin", (r["lo"] + F.col("bin") * width).alias("bin_start"),
        (r["lo"] + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).alias("count"))


def quantiles(df: DataFrame, group: str, value: str,
              probabilities: tuple[float, ...] = (0.25, 0.5, 0.75),
              slices: int | None = None) -> DataFrame:
    """Exact interpolated quantiles per group, for groups of any size and values of any distribution.

    Equal values are counted first. Their running count is taken over ranges cut at sampled values
    (``timeline``), so no task orders a whole group, and a value knows which of the wanted ranks it holds.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(
        F.col(group).alias("g"), F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    stats = counts.groupBy(F.col("g").alias("sg")).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("total"))
    placed = with_running_total(counts, Timeline(("g",), ("v",), slices), F.col("n"), "upto")
    figures = stats.select("sg", "total")
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("total") - 1) * p).alias("x"))
                       for i, p in enumerate(probabilities)])
    held = F.filter(wanted, lambda w: (F.ceil(w["x"]) >= F.col("upto") - F.col("n"))
                    & (F.floor(w["x"]) < F.col("upto")))
    hits = placed.join(figures, F.col("g").eqNullSafe(F.col("sg"))).select("g", "v", F.explode(held).alias("w"))
    # at most two values hold the ranks around one quantile
    found = hits.groupBy("g", F.col("w")["i"].alias("i"), F.col("w")["x"].alias("x")).agg(
        F.min("v").alias("low"), F.max("v").alias("high"))
    at = F.col("low") + (F.col("high") - F.col("low")) * (F.col("x") - F.floor("x"))
    wide = found.groupBy(F.col("g").alias("fg")).agg(*[
        F.max(F.when(F.col("i") == i, at)).alias(f"p{round(p * 100)}")
        for i, p in enumerate(probabilities)])
    return stats.join(wide, F.col("sg").eqNullSafe(F.col("fg"))).select(
        F.col("sg").alias(group), F.col("total").alias("count"), F.col("lo").alias("min"),
        *[f"p{round(p * 100)}" for p in probabilities], F.col("hi").alias("max"))


def speed_quartiles(positions: DataFrame) -> DataFrame:
    """Box-plot figures of speed per vehicle type."""
    return quantiles(positions, "vehicle_type", "speed_kmh")


def top_performers(shifts: DataFrame, n: int = 20) -> DataFrame:
    return shifts.filter("is_top_performer").orderBy(
        "zone_id", "zone_rank", "event_date", "agent_id", "vehicle_type").limit(n).select(
        "agent_id", "zone_id", "event_date", "successful_deliveries", "delivery_success_rate",
        "deliveries_per_hour", "zone_rank")


def top_agents(shifts: DataFrame, n: int = 10) -> DataFrame:
    return shifts.orderBy(F.desc("successful_deliveries"), "agent_id", "event_date",
                          "zone_id").limit(n).select(
        "agent_id", "zone_id", "event_date", "successful_deliveries", "delivery_success_rate",
        "avg_customer_rating")


def preview(spark: SparkSession, name: str, allowed: list[str], n: int = 10) -> DataFrame:
    """First rows of a registered relation; unknown names are refused."""
    require_non_negative_int(n, "n")
    if name not in allowed:
        raise ValueError(f"unknown relation: {name}")
    return spark.table(name).limit(n)


def sample_positions(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of at most ``n`` rows (a distributed top-n by hash)."""
    require_positive_int(n, "n")
    return df.orderBy(F.md5(F.concat_ws(":", "event_id", F.lit(str(seed)))), "event_id").limit(n)


def positions_for(df: DataFrame, vehicle_id: str | None = None) -> DataFrame:
    return df if vehicle_id is None else df.filter(F.col("vehicle_id") == vehicle_id)


def inventory(datasets: dict[str, tuple[str, DataFrame | None]]) -> DataFrame:
    """Rows, columns and status of every dataset; ``datasets`` maps name to (layer, frame)."""
    present = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("dataset"), "rows",
            F.lit(len(df.columns)).alias("column_count"))
        for name, (layer, df) in datasets.items() if df is not None
    ]
    absent = [(layer, name) for name, (layer, df) in datasets.items() if df is None]
    out = reduce(DataFrame.unionByName, present)
    if absent:
        rows = F.explode(F.array(*[F.struct(F.lit(layer).alias("layer"),
                                            F.lit(name).alias("dataset"))
                                   for layer, name in absent])).alias("d")
        missing = out.sparkSession.range(1).select(rows).select(
            "d.*", F.lit(0).cast("long").alias("rows"), F.lit(0).alias("column_count"))
        out = out.unionByName(missing)
    return out.withColumn("status", F.when(F.col("rows") > 0, "Ready").otherwise("Missing"))


def manifest(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows and column list per dataset."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows",
            F.array(*[F.lit(c) for c in df.columns]).alias("columns"))
        for name, df in datasets.items()])


def rollup_events(df: DataFrame, window: str = "1 hour", keys: tuple[str, ...] = (),
                  entity: str | None = None, measures: tuple[str, ...] = (),
                  delay: str = "1 hour") -> DataFrame:
    """Tumbling-window totals. On a stream the window closes behind the watermark and distinct
    entities are counted approximately, as exact distinct state would grow without bound."""
    if df.isStreaming:
        df = df.withWatermark("event_timestamp", delay)
    figures = [F.count(F.lit(1)).alias("events")]
    if entity:
        distinct = F.approx_count_distinct if df.isStreaming else F.countDistinct
        figures.append(distinct(entity).alias("entities"))
    for m in measures:
        figures += [F.avg(m).alias(f"avg_{m}"), F.max(m).alias(f"max_{m}")]
    rolled = df.groupBy(F.window("event_timestamp", window).alias("w"), *keys).agg(*figures)
    return rolled.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         *[c for c in rolled.columns if c != "w"])
