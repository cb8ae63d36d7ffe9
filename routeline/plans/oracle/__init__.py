"""Independent DuckDB SQL for the query catalogue."""

from routeline.plans.oracle import delivery, fleet, lake, quality, shipments, streams

SQL: dict[str, str] = {
    **fleet.SQL, **shipments.SQL, **delivery.SQL, **quality.SQL, **streams.SQL,
    **lake.SQL,
}
