"""Hub stays list their scans in time order."""

import datetime as dt

from routeline.operators.shipments import hub_dwell


def test_repeated_types_stay_in_time_order(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [("S", "H", "n", "c", "HUB_ARRIVED", at(5), "e3"), ("S", "H", "n", "c", "HUB_ARRIVED", at(1), "e1"),
            ("S", "H", "n", "c", "HUB_INSCAN", at(2), "e2")]
    events = spark.createDataFrame(
        rows, "shipment_id string, hub_id string, hub_name string, hub_city string, event_type string, "
              "event_timestamp timestamp_ntz, event_id string")
    row = hub_dwell(events).first()
    assert row["hub_events"] == ["HUB_ARRIVED", "HUB_INSCAN", "HUB_ARRIVED"] and row["hub_event_count"] == 3
