"""Column functions and argument guards."""

import pytest
from pyspark.sql import functions as F

from routeline.functions import clock, geo, labels, values


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def lits(*xs):
    return [F.lit(float(x)) if x is not None else F.lit(None).cast("double") for x in xs]


DELHI, MUMBAI = (28.6139, 77.2090), (19.0760, 72.8777)


@pytest.mark.parametrize("form", ["atan2", "asin"])
def test_haversine(spark, form):
    same, far, none, anti = one(
        spark, geo.haversine_km(*lits(*DELHI, *DELHI), form=form),
        geo.haversine_km(*lits(*DELHI, *MUMBAI), form=form),
        geo.haversine_km(*lits(*DELHI, None, 1), form=form),
        geo.haversine_km(*lits(0, 0, 0, 180), form=form))
    assert same == 0.0 and 1100 <= far <= 1450 and none is None
    assert anti == pytest.approx(3.141592653589793 * 6371)


def test_bearing(spark):
    north, east, back = one(spark, geo.bearing_deg(*lits(0, 0, 1, 0)),
                            geo.bearing_deg(*lits(0, 0, 0, 1)),
                            geo.bearing_deg(*lits(0, 0, 0, -1)))
    assert north == pytest.approx(0, abs=1e-9)
    assert (east, back) == (pytest.approx(90), pytest.approx(270))


def test_move_point(spark):
    lat, lng = geo.move_point(*lits(12.9716, 77.5946, 45, 10))
    moved = one(spark, geo.haversine_km(F.lit(12.9716), F.lit(77.5946), lat, lng))[0]
    assert 9.8 <= moved <= 10.2


def test_overlapping_hour_bands(spark):
    hours = [8, 9, 12, 15, 17, 18, 20, 21, 22]
    df = spark.createDataFrame([(h,) for h in hours], "h int").select(
        "h", labels.delivery_slot(F.col("h")), labels.delivery_time_slot(F.col("h")),
        labels.is_peak_hour(F.col("h")), labels.time_band(F.col("h")))
    got = {r[0]: tuple(r)[1:] for r in df.collect()}
    assert got == {
        8: ("OFF_HOURS", "OFF_HOURS", True, "EARLY_MORNING"),
        9: ("MORNING", "MORNING", True, "MORNING"),
        12: ("MORNING", "MORNING", False, "AFTERNOON"),
        15: ("AFTERNOON", "AFTERNOON", False, "LATE_AFTERNOON"),
        17: ("AFTERNOON", "EVENING", True, "LATE_AFTERNOON"),
        18: ("EVENING", "EVENING", True, "EVENING"),
        20: ("EVENING", "NIGHT", True, "EVENING"),
        21: ("EVENING", "NIGHT", False, "NIGHT"),
        22: ("OFF_HOURS", "OFF_HOURS", False, "NIGHT"),
    }


def test_labels(spark):
    got = one(
        spark, labels.trip_type(F.lit(3.0), "haul"), labels.trip_type(F.lit(3.0), "intercity"),
        labels.speeding_severity(F.lit(80.0)), labels.speeding_severity(F.lit(120.5)),
        labels.journey_stage(F.lit("LOST")), labels.journey_stage(F.lit("LOST"), False),
        labels.event_category(F.lit("DELIVERY_FAILED")), labels.failure_category(F.lit("OTHER")),
        labels.peak_of([(F.lit(1), "A"), (F.lit(3), "B"), (F.lit(3), "C")]))
    assert tuple(got) == ("LOCAL", "INTERCITY_SHORT", None, "CRITICAL", "EXCEPTION", "OTHER",
                          "DELIVERY", None, "B")


def test_sla(spark):
    day = lambda d: F.lit(f"2024-03-{d:02d}").cast("date")
    got = one(spark, labels.sla_status(day(5), day(5), F.lit(True)),
              labels.sla_status(day(5), day(6), F.lit(True)),
              labels.sla_status(day(5), day(4), F.lit(False)),
              labels.sla_variance_days(day(5), day(3)))
    assert tuple(got) == ("MET", "BREACHED", "PENDING", -2)


def test_keys_and_numbers(spark):
    got = one(spark, values.surrogate_key(F.lit("a"), F.lit(None).cast("string")),
              values.padded(F.lit(7), 3), values.padded(F.lit(1234), 3),
              values.safe_div(F.lit(1.0), F.lit(0.0)), values.safe_div(F.lit(1), F.lit(4)),
              values.rounded(F.lit(55.849999999999994), 1),
              geo.geo_cell(F.lit(12.345), F.lit(77.0)))
    import hashlib
    assert tuple(got) == (hashlib.md5(b"a||__dbt_null__").hexdigest(), "007", "1234", None, 0.25,
                          55.9, "h3_9_12.35_77.0")


def test_compact_number(spark):
    df = spark.createDataFrame([(x,) for x in (None, 12.0, 12.34, 1500.0, 3_400_000.0, -2500.0)],
                               "v double")
    assert [r[0] for r in df.select(values.compact_number(F.col("v"))).collect()] == [
        "N/A", "12", "12.3", "1.5K", "3.4M", "-2,500"]


def test_clock(spark):
    a = F.lit("2024-03-31 23:30:00").cast("timestamp")
    b = F.lit("2024-04-01 00:00:01.5").cast("timestamp")
    got = one(spark, clock.elapsed(a, b, "minutes"), clock.day_of_week(a),
              *clock.fiscal(a.cast("date")).values(), *clock.fiscal(b.cast("date")).values())
    assert tuple(got) == (pytest.approx(30.025), 0, 2023, 12, 2024, 1)


@pytest.mark.parametrize("guard, good, bad", [
    (values.require_positive_int, [1, 9], [0, -1, 1.5, True, "1", None]),
    (values.require_non_negative_int, [0, 3], [-1, 0.5, False]),
    (values.require_positive_number, [0.1, 2], [0, -1, True, "x"]),
    (values.require_non_negative_number, [0, 1.5], [-0.1, True]),
    (values.require_ratio, [0, 0.5, 1], [-0.1, 1.01, True, None]),
])
def test_guards(guard, good, bad):
    for value in good:
        assert guard(value, "x") == value
    for value in bad:
        with pytest.raises(ValueError, match="x must be"):
            guard(value, "x")
