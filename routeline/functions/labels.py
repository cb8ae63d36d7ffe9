"""Classification rules: each maps a column to a label, first match wins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from routeline import contracts as C


def first_match(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """CASE expression over (condition, label) pairs."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, F.lit(label)) if chain is None \
            else chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def bands(value: Column, ranges: Iterable[tuple[float, float, str]], default: str) -> Column:
    """Label of the first inclusive [low, high] range that holds the value."""
    return first_match(((value.between(lo, hi), name) for lo, hi, name in ranges), default)


def above(value: Column, steps: Iterable[tuple[float, str]], default: str | None) -> Column:
    """Label of the first limit the value exceeds (limits listed from high to low)."""
    return first_match(((value > limit, name) for limit, name in steps), default)


def at_least(value: Column, steps: Iterable[tuple[float, str]], default: str | None) -> Column:
    return first_match(((value >= limit, name) for limit, name in steps), default)


def below(value: Column, steps: Iterable[tuple[float, str]], default: str) -> Column:
    return first_match(((value < limit, name) for limit, name in steps), default)


# ---- Fixed values: hour ranges, limits and label sets -------------------------------------------
TIME_BANDS = (
    (0, 5, "NIGHT"), (6, 8, "EARLY_MORNING"), (9, 11, "MORNING"), (12, 14, "AFTERNOON"),
    (15, 17, "LATE_AFTERNOON"), (18, 20, "EVENING"),
)
PEAK_HOURS = ((8, 10), (17, 20))
DELIVERY_SLOTS = ((9, 12, "MORNING"), (12, 17, "AFTERNOON"), (17, 21, "EVENING"))
STAGING_SLOTS = (
    (9, 12, "MORNING"), (12, 15, "AFTERNOON"), (15, 18, "EVENING"), (18, 21, "NIGHT"),
)
SPEEDING_STEPS = ((120, "CRITICAL"), (100, "HIGH"), (90, "MEDIUM"), (80, "LOW"))
TRIP_TYPES = {
    "intercity": (((1, "LOCAL"), (50, "INTERCITY_SHORT"), (200, "INTERCITY_MEDIUM")),
                  "INTERCITY_LONG"),
    "haul": (((5, "LOCAL"), (50, "SHORT_HAUL"), (200, "MEDIUM_HAUL")), "LONG_HAUL"),
}
FAILURE_CATEGORIES = {
    "CUSTOMER_ISSUE": ("CUSTOMER_NOT_AVAILABLE", "ACCESS_RESTRICTED"),
    "ADDRESS_ISSUE": ("WRONG_ADDRESS",),
    "REFUSAL": ("CUSTOMER_REFUSED", "PAYMENT_ISSUE"),
    "PACKAGE_ISSUE": ("DAMAGED_PACKAGE",),
}
SEVERITY_SCORES = {"CRITICAL": 4, "HIGH": 3, "WARNING": 2, "INFO": 1}


def time_band(hour: Column) -> Column:
    return bands(hour, TIME_BANDS, "NIGHT")


def is_peak_hour(hour: Column) -> Column:
    (a, b), (c, d) = PEAK_HOURS
    return hour.between(a, b) | hour.between(c, d)


def delivery_slot(hour: Column) -> Column:
    return bands(hour, DELIVERY_SLOTS, "OFF_HOURS")


def delivery_time_slot(hour: Column) -> Column:
    """Slot used by the delivery staging model; shared edge hours belong to the earlier slot."""
    return bands(hour, STAGING_SLOTS, "OFF_HOURS")


def speeding_severity(speed: Column) -> Column:
    return above(speed, SPEEDING_STEPS, None)


def trip_type(km: Column, scheme: str) -> Column:
    steps, longest = TRIP_TYPES[scheme]
    return below(km, steps, longest)


def journey_stage(event_type: Column, with_exception: bool = True) -> Column:
    rules = [
        (event_type.isin(*C.FIRST_MILE_EVENTS), "FIRST_MILE"),
        (event_type.isin(*C.MID_MILE_EVENTS), "MID_MILE"),
        (event_type.isin(*C.LAST_MILE_EVENTS), "LAST_MILE"),
    ]
    if with_exception:
        rules.append((event_type.isin(*C.EXCEPTION_EVENTS), "EXCEPTION"))
    return first_match(rules, "OTHER")


def event_category(event_type: Column) -> Column:
    return first_match(
        [
            (event_type.like("HUB_%"), "HUB_OPERATION"),
            (event_type.like("DELIVERY%") | (event_type == "DELIVERED"), "DELIVERY"),
            (event_type.isin(*C.FIRST_MILE_EVENTS), "PICKUP"),
            (event_type == "IN_TRANSIT", "TRANSIT"),
        ],
        "OTHER",
    )


def is_terminal(event_type: Column) -> Column:
    return F.coalesce(event_type.isin("DELIVERED", "DELIVERY_FAILED", *C.EXCEPTION_EVENTS),
                      F.lit(False))


def failure_category(reason: Column) -> Column:
    return first_match((reason.isin(*members), name)
                       for name, members in FAILURE_CATEGORIES.items())


def severity_score(severity: Column) -> Column:
    return first_match(((severity == name, score) for name, score in SEVERITY_SCORES.items()), 0)


def peak_of(counts: Iterable[tuple[Column, str]]) -> Column:
    """Label of the largest count; ties go to the label listed first."""
    listed = list(counts)
    top = F.greatest(*[count for count, _ in listed])
    return first_match(((count == top, name) for count, name in listed[:-1]), listed[-1][1])


def sla_status(promised: Column, actual: Column, delivered: Column) -> Column:
    pending = (~delivered) | actual.isNull()
    return first_match([(pending, "PENDING"), (actual <= promised, "MET")], "BREACHED")


def sla_variance_days(promised: Column, actual: Column) -> Column:
    """Calendar days late (negative = early)."""
    return F.datediff(F.to_date(actual), F.to_date(promised))
