"""Partitioned ingest writes rows as they come, whatever the number of folders."""

import pytest
from pyspark.sql import functions as F

from routeline.streaming import ingest


@pytest.mark.parametrize("files", [2, 32])
def test_more_and_fewer_folders_than_open_files(spark, tmp_path, files):
    rows = spark.range(500).select(
        F.col("id"), F.when(F.col("id") % 6 < 5, F.concat(F.lit("k"), (F.col("id") % 6).cast("string"))).alias("kind"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    with ingest.open_writers(spark, files):
        assert spark.conf.get(ingest.WRITERS) == str(files)
        ingest.write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ck", partition_cols=("kind",),
                            available_now=True).awaitTermination()
    assert spark.conf.get(ingest.WRITERS) == "0"
    got = spark.read.parquet(f"{tmp_path}/out").select("id", "kind")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)


def test_a_users_value_stays(spark):
    spark.conf.set(ingest.WRITERS, "3")
    try:
        with ingest.open_writers(spark):
            assert spark.conf.get(ingest.WRITERS) == "3"
        assert spark.conf.get(ingest.WRITERS) == "3"
    finally:
        spark.conf.unset(ingest.WRITERS)


def test_topics_are_written_with_open_writers(spark, tmp_path, monkeypatch):
    """The setting holds while the topics' streams run and is gone after."""
    seen, plain = [], ingest.ingest
    monkeypatch.setattr(ingest, "ingest", lambda s, *a, **k: seen.append(s.conf.get(ingest.WRITERS)) or plain(s, *a, **k))
    spark.createDataFrame([('{"event_id": "a1"}',)], "value string").write.text(f"{tmp_path}/in/alerts")
    ingest.run_streams(spark, str(tmp_path), f"{tmp_path}/ck", ("alerts",), folder=f"{tmp_path}/in", fmt="text",
                       available_now=True)
    assert seen == [str(ingest.OPEN_FILES)] and spark.conf.get(ingest.WRITERS) == "0"
    assert spark.read.parquet(f"{tmp_path}/bronze/alerts").count() == 1
