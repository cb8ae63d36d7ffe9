"""Alert records across the three domains, and geofence crossings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeline import contracts as C
from routeline.functions import geo, labels
from routeline.functions.clock import elapsed
from routeline.operators.timeline import Timeline, with_neighbours, with_ranges

ALERT_COLUMNS = ("module", "alert_type", "severity", "entity_type", "entity_id",
                 "alert_timestamp")


def speeding_alerts(positions: DataFrame, limit: float = C.LIMITS.speeding_kmh) -> DataFrame:
    """Points above the limit, graded; stateless, so it serves streams as well."""
    return positions.filter(F.col("speed_kmh") > limit).withColumns({
        "event_type": F.lit("SPEEDING"),
        "severity": F.coalesce(labels.speeding_severity(F.col("speed_kmh")), F.lit("LOW")),
    })


def fleet_alert_records(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        F.lit("FLEET").alias("module"), F.col("event_type").alias("alert_type"), "severity",
        F.lit("VEHICLE").alias("entity_type"), F.col("vehicle_id").alias("entity_id"),
        F.col("event_timestamp").alias("alert_timestamp"))


def delivery_failure_records(deliveries: DataFrame) -> DataFrame:
    return deliveries.filter(F.col("event_type") == "DELIVERY_FAILED").select(
        F.lit("LAST_MILE").alias("module"), F.lit("DELIVERY_FAILED").alias("alert_type"),
        F.lit("WARNING").alias("severity"), F.lit("ORDER").alias("entity_type"),
        F.col("order_id").alias("entity_id"), "agent_id", "failure_reason",
        F.col("event_timestamp").alias("alert_timestamp"))


def shipment_exception_records(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin("DELIVERY_FAILED", *C.EXCEPTION_EVENTS)).select(
        F.lit("SHIPMENT").alias("module"), F.lit("EXCEPTION").alias("alert_type"),
        F.lit("HIGH").alias("severity"), F.lit("SHIPMENT").alias("entity_type"),
        F.col("shipment_id").alias("entity_id"),
        F.col("event_timestamp").alias("alert_timestamp"))


ALERT_KEY = ["module", "alert_type", "entity_id", "alert_timestamp"]


def worst_alerts(alerts: DataFrame) -> DataFrame:
    """One row per (module, type, entity, time), the worst; the answer doesn't depend on the rows' order."""
    worst = F.max_by(F.struct("severity", "entity_type"), F.struct(
        labels.severity_score(F.col("severity")), "severity", "entity_type"))
    return alerts.groupBy(*ALERT_KEY).agg(worst.alias("w")).select(*ALERT_KEY, "w.*")


def with_alert_ids(alerts: DataFrame) -> DataFrame:
    """The unified columns: a stable id and the channels the severity is routed to."""
    at = F.col("alert_timestamp").cast("timestamp")
    return alerts.select(
        F.md5(F.concat_ws("|", "module", "alert_type", "entity_id",
                          F.unix_micros(at).cast("string"))).alias("alert_id"),
        *ALERT_COLUMNS, channels_of(F.col("severity")).alias("channels"))


def alert_records(*alerts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [a.select(*ALERT_COLUMNS) for a in alerts])


def unify_alerts(*alerts: DataFrame) -> DataFrame:
    """One alert table: same columns, of repeats of (module, type, entity, time) the worst. Streams are
    unified by ``streaming.detect.stream_alerts``, whose table can correct a row it has already given."""
    return with_alert_ids(worst_alerts(alert_records(*alerts)))


def channels_of(severity: Column) -> Column:
    chain = None
    for name, channels in C.ALERT_CHANNELS.items():
        value = F.array(*[F.lit(c) for c in channels]).cast("array<string>")
        chain = F.when(severity == name, value) if chain is None \
            else chain.when(severity == name, value)
    return chain.otherwise(F.array().cast("array<string>"))


def route_alerts(alerts: DataFrame) -> DataFrame:
    """One row per alert and channel."""
    return alerts.withColumn("channel", F.explode("channels")).drop("channels")


FENCE_CELL_DEGREES = 0.01   # cells of level 0; each level doubles them
FENCE_LEVELS = 17           # the largest cells span more than the globe
LIST = 256                  # fences of one cell that a point meets in one row
BLOCK = 4096                # points of one vehicle that are ordered by fence in one task


def fence_cells(fences: DataFrame) -> DataFrame:
    """Fences as rows of the grid cells they touch, at the level whose cells are as wide as the fence.

    A fence then touches at most two cells each way, whatever its radius, and no cell has a list of fences.
    """
    north = F.col("radius_km") / 110.0
    east = F.col("radius_km") / (110.0 * F.cos(F.radians(
        F.least(F.abs(F.col("center_lat")) + north, F.lit(85.0)))))
    wide = F.greatest(2 * F.greatest(north, east) / FENCE_CELL_DEGREES, F.lit(1.0))
    level = F.least(F.ceil(F.log2(wide)), F.lit(FENCE_LEVELS - 1)).cast("int")
    rows = fences.withColumns({"level": level, "_north": north, "_east": east})
    for axis, center, reach in (("cell_y", "center_lat", "_north"), ("cell_x", "center_lng", "_east")):
        ends = [_cell(F.col(center) + sign * F.col(reach)) for sign in (-1, 1)]
        rows = rows.withColumn(axis, F.explode(F.sequence(*ends)))
    return rows.select("level", "cell_y", "cell_x", "geofence_id", "geofence_type", "center_lat", "center_lng",
                       "radius_km")


def _cell(degrees: Column) -> Column:
    """The cell, at the row's ``level``, of a latitude or longitude."""
    return F.floor(degrees / (F.lit(FENCE_CELL_DEGREES) * F.pow(F.lit(2.0), F.col("level")))).cast("long")


def fence_lists(fences: DataFrame, shown: Column) -> DataFrame:
    """The fences of each cell in lists of at most ``LIST`` members: ``shown`` and the circle."""
    cell = ("level", "cell_y", "cell_x")
    placed = fence_cells(fences).withColumn("_list", F.floor(
        (F.row_number().over(Window.partitionBy(*cell).orderBy("geofence_id")) - 1) / LIST))
    member = F.struct(shown.alias("shown"), "center_lat", "center_lng", "radius_km")
    return placed.groupBy(*cell, "_list").agg(F.collect_list(member).alias("_listed")).drop("_list")


def fences_around(points: DataFrame, fences: DataFrame, shown: Column, lat: str = "latitude",
                  lng: str = "longitude") -> DataFrame:
    """Points with lists ``fences`` of those that contain them: an equi-join on the point's cell at each level in use.

    A point has a row for each of the few lists that it meets, so what is moved is a point, not a point and fence.
    """
    lists = fence_lists(fences, shown)
    levels = fence_cells(fences).agg(F.collect_set("level")).scalar()  # at most FENCE_LEVELS
    asked = points.withColumn("_levels", levels).withColumn("level", F.explode("_levels")).drop("_levels").withColumns({
        "cell_y": _cell(F.col(lat)), "cell_x": _cell(F.col(lng))})

    def near(fence: Column) -> Column:
        north = F.abs(F.col(lat) - fence["center_lat"]) * 110.0 <= fence["radius_km"]  # cheap, and never wrong
        return north & (geo.haversine_km(F.col(lat), F.col(lng), fence["center_lat"], fence["center_lng"]) <= fence["radius_km"])

    met = asked.join(lists, ["level", "cell_y", "cell_x"]).filter(F.exists("_listed", near))
    return met.withColumn("fences", F.transform(F.filter("_listed", near), lambda fence: fence["shown"])).drop(
        "level", "cell_y", "cell_x", "_listed")


_PLACE = ("event_id", "event_timestamp", "latitude", "longitude")
_FENCE = ("geofence_id", "geofence_type")


def geofence_events(positions: DataFrame, fences: DataFrame,
                    line: Timeline = Timeline(keys=("vehicle_id",)), block: int = BLOCK) -> DataFrame:
    """ENTRY and EXIT of every vehicle at every circular fence, exits with the dwell time.

    Points are numbered per vehicle; those in a fence with consecutive numbers are one visit, which begins with
    an ENTRY and ends with an EXIT at the vehicle's next point. Only points within fences go past the join. They
    move with their lists of fences to blocks of ``block`` numbers, which are spelled out and ordered by fence where
    they are; only the ends of visits that touch the edge of a block move once more.
    """
    points = positions.filter("latitude is not null and longitude is not null").select("vehicle_id", *_PLACE)
    numbered = with_neighbours(points.withColumn("_there", F.lit(True)), line, sequence="_number",
                               following={f"_next_{c}": c for c in (*_PLACE, "_there")})
    number, at = F.col("_number"), F.struct("event_timestamp")
    inside = (fences_around(numbered, fences, F.struct(*_FENCE))
              .withColumn("_block", F.floor((number - 1) / block)).repartition("vehicle_id", "_block")
              .select("vehicle_id", "_block", "_number", *_PLACE, *[f"_next_{c}" for c in (*_PLACE, "_there")],
                      F.inline("fences")))
    series = Window.partitionBy("vehicle_id", "_block", *_FENCE).orderBy("_number")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before, after = F.lag("_number").over(series), F.lead("_number").over(series)
    marked = inside.withColumns({
        "_opens": F.coalesce(before != number - 1, F.lit(True)), "_closes": F.coalesce(after != number + 1, F.lit(True)),
        "_head": before.isNull() & (number > 1) & ((number - 1) % block == 0),
        "_tail": after.isNull() & (number % block == 0)})
    marked = marked.withColumn("_begun", F.last(F.when(F.col("_opens"), F.struct(
        at.alias("at"), F.col("_head").alias("head"))), ignorenulls=True).over(so_far))
    head, tail, begun = F.col("_head"), F.col("_tail"), F.col("_begun")
    within = _visit_ends(marked, F.col("_opens") & ~head, F.col("_closes") & ~tail & ~begun["head"], begun["at"])

    # visits across blocks: where a block's last point is followed by the next one's first, neither is an end
    edges = marked.filter(head | (F.col("_closes") & (tail | begun["head"])))
    across = Window.partitionBy("vehicle_id", *_FENCE).orderBy("_number")
    joined = edges.withColumns({
        "_follows": head & F.coalesce(F.lag(F.when(tail, number)).over(across) == number - 1, F.lit(False)),
        "_goes_on": tail & F.coalesce(F.lead(F.when(head, number)).over(across) == number + 1, F.lit(False))})
    first = F.when(head & ~F.col("_follows"), at).when(~begun["head"], begun["at"])
    joined = joined.withColumn("_since", F.last(first, ignorenulls=True).over(
        across.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return within.unionByName(_visit_ends(joined, head & ~F.col("_follows"), F.col("_closes") & (
        tail | begun["head"]) & ~F.col("_goes_on"), F.col("_since")))


def _visit_ends(rows: DataFrame, enters: Column, leaves: Column, since: Column) -> DataFrame:
    """An ENTRY at the row's place where it ``enters``, an EXIT at the next place, if there is one, where it ``leaves``."""
    def event(kind: str, place: str, dwell: Column) -> Column:
        return F.struct(F.lit(kind).alias("event_type"), *[F.col(f"{place}{c}").alias(c) for c in _PLACE],
                        dwell.alias("dwell_time_seconds"))

    stay = elapsed(since["event_timestamp"], F.col("_next_event_timestamp"), "seconds")
    both = F.array(F.when(enters, event("ENTRY", "", F.lit(None).cast("double"))),
                   F.when(leaves & F.col("_next__there"), event("EXIT", "_next_", stay.cast("double"))))
    return rows.select("vehicle_id", *_FENCE, F.explode(F.array_compact(both)).alias("e")).select(
        "e.event_id", "vehicle_id", *_FENCE, "e.event_type", "e.event_timestamp", "e.latitude", "e.longitude",
        "e.dwell_time_seconds")


def crossings(linked: DataFrame, fences: DataFrame) -> DataFrame:
    """Points linked with the place before (``prev_lat``, ``prev_lng``) at which fences were ``entered`` or ``left``."""
    row = F.struct("vehicle_id", *_PLACE, "prev_lat", "prev_lng")
    ends = F.array(*[F.struct(F.lit(now).alias("now"), F.col(lat).alias("_lat"), F.col(lng).alias("_lng"))
                     for now, lat, lng in ((1, "latitude", "longitude"), (0, "prev_lat", "prev_lng"))])
    probes = linked.select(row.alias("p"), F.explode(ends).alias("e")).select("p", "e.*").filter(
        "_lat is not null and _lng is not null")
    # lists of texts are compared by hash, lists of structs member by member
    around = fences_around(probes, fences, F.to_json(F.struct(*_FENCE)), "_lat", "_lng")
    side = lambda now: F.flatten(F.collect_list(F.when(F.col("now") == now, F.col("fences"))))
    sides = around.groupBy("p").agg(side(1).alias("here"), side(0).alias("there"))
    named = fences.select(*_FENCE).schema
    listed = lambda a, b: F.transform(F.array_except(a, b), lambda fence: F.from_json(fence, named))
    return sides.filter("here <> there").select(
        "p.vehicle_id", *[f"p.{c}" for c in _PLACE], listed("here", "there").alias("entered"),
        listed("there", "here").alias("left"))


def with_dwell(moves: DataFrame, line: Timeline = Timeline(keys=("vehicle_id",))) -> DataFrame:
    """``crossings`` as ENTRY and EXIT rows, with the seconds between an EXIT and the ENTRY before it.

    Points move once with their lists, which are spelled out and ordered by fence within a range of the vehicle's
    points. Of a vehicle with several ranges, the last event at a fence in each also meets the EXIT that waits for it.
    """
    def event(kind: str):
        return lambda fence: F.struct(*[fence[c].alias(c) for c in _FENCE], F.lit(kind).alias("event_type"))

    rows = with_ranges(moves, line, "_range", "_cut").select(
        "event_id", "vehicle_id", "_range", "_cut", F.inline(F.concat(
            F.transform("entered", event("ENTRY")), F.transform("left", event("EXIT")))), *_PLACE[1:])
    order, at, since = ("event_timestamp", "event_id"), F.struct("event_timestamp"), F.col("_since")
    series = Window.partitionBy("vehicle_id", "_range", "geofence_id").orderBy(*order)
    paired = rows.withColumns({"_since": F.lag(at).over(series), "_last": F.lead(F.lit(1)).over(series).isNull()})
    waits = F.col("_cut") & (F.col("event_type") == "EXIT") & since.isNull()
    whole = Window.partitionBy("vehicle_id", "geofence_id").orderBy(*order)
    met = (paired.filter(F.col("_cut") & (F.col("_last") | since.isNull()))
           .withColumns({"_waits": waits, "_since": F.lag(at).over(whole)}).filter("_waits").drop("_waits"))
    return paired.filter(~waits).unionByName(met).select(
        "event_id", "vehicle_id", *_FENCE, "event_type", *_PLACE[1:],
        F.when(F.col("event_type") == "EXIT", elapsed(
            since["event_timestamp"], F.col("event_timestamp"), "seconds")).alias("dwell_time_seconds"))
