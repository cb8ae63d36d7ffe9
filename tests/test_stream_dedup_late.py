"""De-duplicated ingest loses no first delivery."""

from test_pipeline_streams import ingest_once, lines, position

from routeline.sources.tables import read_bronze


def test_new_events_behind_the_watermark_are_kept_once(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines(folder, "1.json", [position(1, 0), position(1, 0), position(2, 3000)])
    ingest_once(spark, folder, out, dedup_delay="1 hour")
    # late, twice late, a late repeat of a stored event, two rows without an id
    lines(folder, "2.json", [position(9, 10), position(9, 10), position(1, 0), "{broken", "{too"])
    ingest_once(spark, folder, out, dedup_delay="1 hour")
    lines(folder, "3.json", [position(9, 10), position(3, 3001), position(8, 1500)])
    ingest_once(spark, folder, out, dedup_delay="1 hour")
    got = [r["event_id"] for r in read_bronze(spark, out, "vehicle_positions").collect()]
    assert sorted(map(str, got)) == ["None", "None", "e1", "e2", "e3", "e8", "e9"]
    day = read_bronze(spark, out, "vehicle_positions", "2024-01-01")
    assert sorted(r["event_id"] for r in day.collect()) == ["e1", "e9"]
